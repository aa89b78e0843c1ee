"""Quality rules as a bitmask ledger, with DataFrame functions only.

``ledger`` measures each text once and stores the measurements and one failure bit per rule. A policy is a
version name and a mask of the rules it applies; verdicts and ablations are bit operations on the ledger, so a
new policy never reads a text again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, table, words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

#: Rules in bit order: name and the condition under which a text fails.
RULES = (
    ("too_few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 25 * n_words"),
)
BASE = 0b000011
#: Policy versions: the rules each applies.
POLICIES = {"base": BASE, "v1": 0b111111}


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus the measurements of each whole text; a null text has no words, lines or symbols.

    ``n_lines`` counts the lines with a word, ``n_dup_lines`` those equal to an earlier line.
    ``n_repeat_words`` counts the words in 3-word windows that occur twice or more: window hashes carry their
    position in the low bits and are sorted, so that equal windows are neighbours.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(value, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    staged = docs.drop(*MEASURES).select("*", words(F.col(text)).alias("__words"), lines.alias("__lines"))
    # Low bits for the position: as many as the number of words needs.
    staged = staged.withColumn("__low", F.length(F.bin(F.size("__words").cast("bigint"))))
    windows = """
        transform(slice(__words, 1, greatest(size(__words) - 2, 0)), (x, i) ->
          shiftleft(xxhash64(x, get(__words, i + 1), get(__words, i + 2)), __low) | cast(i AS bigint))
    """
    staged = staged.withColumn("__keys", F.sort_array(F.expr(windows)))
    # Positions of windows whose sorted neighbour on either side is the same window. Hashes that agree by
    # chance are told apart by their words.
    place = "cast({} & (shiftleft(1L, __low) - 1) AS int)"

    def equals(step):
        near = f"get(__keys, i {step} 1)"
        return (
            f"coalesce(shiftrightunsigned(k, __low) = shiftrightunsigned({near}, __low)"
            f" AND slice(__words, {place.format('k')} + 1, 3) = slice(__words, {place.format(near)} + 1, 3), false)"
        )
    staged = staged.withColumn("__at", F.sort_array(F.expr(
        f"filter(transform(__keys, (k, i) -> if({equals('-')} OR {equals('+')}, {place.format('k')}, -1)), p -> p >= 0)"
    )))

    # Windows cover three words each; an overlap with the next window counts once.
    covered = """
        aggregate(__at, named_struct('end', 0, 'n', 0L), (s, p) ->
          named_struct('end', p + 3, 'n', s.n + (p + 3 - greatest(p, s.end))), s -> s.n)
    """
    measures = F.struct(
        F.size("__words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("__words", "")).cast("bigint").alias("word_chars"),
        F.char_length(F.regexp_replace(value, "[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        F.size("__lines").cast("bigint").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint").alias("n_dup_lines"),
        F.expr(covered).cast("bigint").alias("n_repeat_words"),
    )
    # A generator keeps filters on the measurements above them, where each is computed once.
    kept = [c for c in docs.columns if c not in MEASURES]
    return staged.select(*kept, F.inline(F.array(measures)))


def ledger(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """``docs`` plus the measurements and ``failed``, a bit per rule (bit 0 first)."""
    measured = measure(docs.drop("failed"), text)
    bits = [F.when(F.expr(condition), F.lit(1 << k)).otherwise(0) for k, (_, condition) in enumerate(rules)]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return measured.withColumn("failed", failed.cast("bigint"))


def verdict(version: str, policies=POLICIES) -> Column:
    """True where no rule of the policy failed."""
    return F.col("failed").bitwiseAND(F.lit(policies[version])) == 0


def ablations(entries: DataFrame, version: str, rules=RULES, policies=POLICIES) -> DataFrame:
    """One row per rule of a policy: how many texts fail it, and how many would be kept without it alone.

    A policy has at most 64 rules, so the result is that small; counts combine before the shuffle.
    """
    mask = policies[version]
    used = [(k, name) for k, (name, _) in enumerate(rules) if mask >> k & 1]
    counts = entries.agg(
        F.count_if(verdict(version, policies)).alias("kept"),
        *[F.count_if(F.col("failed").bitwiseAND(F.lit(1 << k)) != 0).alias(f"fails_{k}") for k, _ in used],
        *[F.count_if(F.col("failed").bitwiseAND(F.lit(mask)) == 1 << k).alias(f"only_{k}") for k, _ in used],
    )
    row = [F.struct(F.lit(name).alias("rule"), F.col(f"fails_{k}").alias("fails"), "kept",
                    (F.col("kept") + F.col(f"only_{k}")).alias("kept_without")) for k, name in used]
    return counts.select(F.inline(F.array(*row)))


def op9_quality_rules(spark, sf_dir):
    """Measurements and verdicts of all documents under policy v1."""
    entries = ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("failed").bitwiseAND(F.lit(BASE)) != 0).alias("base_failed"), verdict("v1").alias("kept"),
    )


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM d
), windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)
), repeated AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + o) AS n FROM repeated, (VALUES (0), (1), (2)) AS t(o) GROUP BY doc_id
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
       OR word_chars < 2 * n_words OR word_chars > 25 * n_words) AS kept
FROM m
"""
