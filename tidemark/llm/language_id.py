"""Language identification by hierarchical discrimination.

The family of a text is predicted first; inside a family, linear support vector machines for every pair of its languages
vote. Features are shares of hashed byte bigrams and trigrams of the letters of the whole text, so a score is a mean of
table entries over the text. The machines are fitted by Spark on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import crc_class, small_batches, table

#: Hash range of each gram size; shares are scaled before fitting so that margins are of order one.
RANGE_BITS = 13
WIDTH = 2 << RANGE_BITS
SCALE = 100.0
UNKNOWN = "und"
#: Language families (fixed values); a language that is not listed is a family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic", "sk": "slavic", "bg": "slavic",
}
#: Expected labelled rows per language in the fitting sample, and the most languages.
SAMPLE_ROWS = 600
MOST_LANGUAGES = 64
#: What counts as a letter in Spark: Unicode letters, no digits or numerals; ``str.isalpha`` knows the same.
LETTER_CLASS = r"\p{L}"
#: Hash values among which a share is sampled.
HASHES = 1 << 52
_PLAIN = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)).lower()
#: Bytes of a text whose grams are counted at once, and bytes of the batches that Python gets.
CHUNK = 1 << 17
BATCH = "2m"


def _grams(text: bytes) -> Iterator[np.ndarray]:
    """Feature numbers of all grams of a text, in chunks."""
    plain = np.frombuffer(b" " + text.translate(_PLAIN) + b" ", np.uint8)
    for at in range(0, max(1, len(plain) - 2), CHUNK):
        x = plain[at : at + CHUNK + 2].astype(np.uint32)
        two = x[:-1] << np.uint32(8) | x[1:]
        two, three = two[: len(x) - 2], two[:-1] << np.uint32(8) | x[2:]
        shift = np.uint32(32 - RANGE_BITS)
        yield np.concatenate((
            two * np.uint32(2654435761) >> shift,
            (three * np.uint32(2246822519) >> shift) + np.uint32(1 << RANGE_BITS),
        ))


def features(text):
    counts = np.zeros(WIDTH)
    for part in _grams(text.encode("utf-8", "replace")):
        counts += np.bincount(part, minlength=WIDTH)
    at = np.flatnonzero(counts)
    return SparseVector(WIDTH, at, counts[at] * (SCALE / max(counts.sum(), 1)))


class Model:
    """Weights of all machines as one table; a bounded number of columns of ``WIDTH`` numbers."""

    def __init__(self, families: dict[str, list[str]], machines: list[tuple[str, str, str]], weights, bias):
        self.families, self.machines = families, machines
        self.weights, self.bias = weights, bias

    def margins(self, text: bytes) -> np.ndarray:
        total, n = np.zeros(self.weights.shape[1]), 0
        for part in _grams(text):
            total += np.bincount(part, minlength=WIDTH) @ self.weights
            n += len(part)
        return total * (SCALE / max(n, 1)) + self.bias

    @staticmethod
    def _vote(names: list[str], margins: dict[tuple[str, str], float]) -> tuple[str, float]:
        """Most pairwise wins, then the largest sum of margins; with the weakest margin of the winner."""
        if len(names) == 1:
            return names[0], np.inf
        wins = {a: [0, 0.0, np.inf] for a in names}
        for (a, b), m in margins.items():
            for name, own in ((a, m), (b, -m)):
                wins[name][0] += own > 0
                wins[name][1] += own
                wins[name][2] = min(wins[name][2], own)
        best = max(names, key=lambda a: (wins[a][0], wins[a][1]))
        return best, wins[best][2]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.families or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        found = self.margins(text.encode("utf-8", "replace"))
        level = lambda kind: {(a, b): found[i] for i, (k, a, b) in enumerate(self.machines) if k == kind}
        family, sure = self._vote(sorted(self.families), level(""))
        language, surer = self._vote(self.families[family], level(family))
        weakest = np.clip(min(sure, surer), -30, 30)
        return language, float(1 / (1 + np.exp(-weakest)))


def fit(labelled: DataFrame, text: str = "text", label: str = "lang", sample_rows: int = SAMPLE_ROWS, families=None) -> Model:
    """Fit all machines on at most about ``sample_rows`` labelled texts of each language, chosen by a hash of the text.

    A text that is repeated under one label counts and enters once.
    Rows with a null label or a text without a letter are left out; more than ``MOST_LANGUAGES`` labels raise. Without a labelled row the model knows no language.
    """
    families = FAMILIES if families is None else families
    usable = labelled.where(F.col(label).isNotNull() & F.col(text).rlike(LETTER_CLASS)).select(
        text, label, F.xxhash64(text).alias("__hash")
    )
    # One row a language. Distinct texts are counted, because only they are sampled.
    counts = {r[0]: r[1] for r in usable.select(label, "__hash").distinct().groupBy(label).count().collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"{len(counts)} languages; {MOST_LANGUAGES} at most")
    groups: dict[str, list[str]] = {}
    for name in sorted(counts):
        groups.setdefault(families.get(name, name), []).append(name)
    machines = [("", a, b) for a, b in combinations(sorted(groups), 2)]
    machines += [(f, a, b) for f in sorted(groups) for a, b in combinations(groups[f], 2)]
    if not machines:
        return Model(groups, [], np.zeros((WIDTH, 0)), np.zeros(0))
    share = F.lit(1.0)
    for name, n in counts.items():
        share = F.when(F.col(label) == name, F.lit(min(1.0, sample_rows / n))).otherwise(share)
    # Copies of a text share its hash; one of them is enough, so that a hot text cannot outgrow the sample.
    chosen = usable.where(F.pmod("__hash", F.lit(HASHES)) < share * float(HASHES)).dropDuplicates([label, "__hash"])
    vector = F.udf(features, VectorUDT())
    rows = materialize(chosen.select(F.col(label).alias("lang"), vector(text).alias("features")), "languages").coalesce(4).cache()
    weights, bias = np.zeros((WIDTH, len(machines))), np.zeros(len(machines))
    try:
        for i, (kind, a, b) in enumerate(machines):
            side = {name: x for x, name in ((1.0, a), (0.0, b))}
            if not kind:
                side = {name: x for x, f in ((1.0, a), (0.0, b)) for name in groups[f]}
            target = F.lit(None).cast("double")
            for name, x in side.items():
                target = F.when(F.col("lang") == name, F.lit(x)).otherwise(target)
            machine = LinearSVC(maxIter=25, regParam=0.001, standardization=False, aggregationDepth=2)
            fitted = machine.fit(rows.withColumn("label", target).where("label IS NOT NULL").select("label", "features"))
            weights[:, i], bias[i] = fitted.coefficients.toArray(), fitted.intercept
    finally:
        rows.unpersist()
    return Model(groups, machines, weights, bias)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score`` (0 to 1), from the whole text alone.

    A null text and a text without a letter are ``und`` with score 0. Columns of these names are replaced.
    """
    small_batches(docs, BATCH)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    kept = [c for c in docs.columns if c not in ("lang_pred", "score") or c == text]
    return docs.select(*kept, run(text).alias("__p")).select(*kept, "__p.lang_pred", "__p.score")


def learning_rows(docs: DataFrame) -> DataFrame:
    """Rows that may be learned from: those whose id's CRC-32 modulo 3 is not 1."""
    return docs.where(crc_class(F.col("doc_id"), 3) != 1)


def op6_language_id(spark, sf_dir):
    """Languages of all documents, learned from two thirds of them."""
    docs = table(spark, sf_dir, "documents")
    model = fit(learning_rows(docs))
    found = predict(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(crc_class(F.col("doc_id"), 3) == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
