"""A corpus from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written and read again as the next
one's ``docs``. All but the last return the columns of ``documents``. A null text is rejected by the first stage. Rows without
a doc_id do not come through the near-duplicate stage, because a group is represented by an id. Empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language_id, packing, quality_rules, simhash_dedup, substring_dedup
from tidemark.session import materialize


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents without a recognised language: no text, or no letter in it.

    If no row that may be learned from has a label, no language is known, and texts with a letter stay.
    """
    model = language_id.fit(language_id.learning_rows(docs))
    if not model.families:
        return docs.where(F.col("text").rlike(language_id.LETTER_CLASS))
    found = language_id.predict(docs, model)
    return found.where(F.col("lang_pred") != language_id.UNKNOWN).select(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents that fail a rule of policy v1."""
    entries = quality_rules.ledger(docs.withColumn("__row", F.struct(*docs.columns)))
    return entries.where(quality_rules.verdict("v1")).select("__row.*")


def near_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts whose fingerprints (3-word shingles) differ in 2 bits or fewer, and what they link, the smallest id stays."""
    return simhash_dedup.representatives(docs)


def without_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages that an earlier document has; documents of which nothing is left go.

    A text that loses nothing stays as it is; others become their remaining words, joined by a space.
    """
    left = substring_dedup.remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return left.where("n_words > n_removed OR n_removed = 0").withColumn("text", text).withColumn(
        "n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)
    ).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens, a row per piece."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", known_language),
    ("quality_rules", good_quality),
    ("simhash_dedup", near_distinct),
    ("substring_dedup", without_passages),
    ("best_fit_packing", packed),
]

#: Tokenizers, fitted machines and XXH64 have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
