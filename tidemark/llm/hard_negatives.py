"""Hard-negative mining by the threshold algorithm over per-dimension sorted lists.

Rows are spread over blocks by a hash of their id, and each block of anchors meets each block of rows in a group of its
own. There every dimension has its rows sorted by component. An anchor walks the lists of its non-zero components, from
the large end where its component is positive and from the small end where it is negative, scores every row it meets
by the integer inner product, and stops once the threshold, the score of a row made of the components at the current depth,
falls strictly below the k-th score of each window: no unseen row can then enter, not even by a tie.
The first pass finds an anchor's positives in the lists of its own label; their scores bound the windows of the second
pass, which walks the lists of all rows and skips the anchor's label. A block returns k rows per window at most.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scale import top_n_per_group
from ..session import materialize
from .common import table

POSITIVES, NEGATIVES = 5, 3
SCALE = 256
#: Hundredths of the positive's score between which a negative must lie.
LOW, HIGH = 50, 95
BLOCK_ROWS, BLOCK_ANCHORS = 8192, 512
#: First depth of a walk; it doubles from step to step.
DEPTH = 32
#: Squared length up to which any two rows have a score that a long holds.
LONGEST = float(1 << 62)
#: Scores up to this are exact in doubles.
EXACT = 1 << 53


class SortedLists:
    """Rows of a block with the order of each dimension; all numbers are integers held exactly."""

    def __init__(self, vectors: np.ndarray, members: np.ndarray | None = None):
        self.members = np.arange(len(vectors)) if members is None else members
        self.rows = vectors[self.members]
        #: One list a dimension, smallest component first.
        self.order = np.ascontiguousarray(np.argsort(self.rows, axis=0, kind="stable").T.astype(np.int32))
        self.largest = float(np.abs(self.rows).max(initial=0))
        self.doubles = self.rows.astype(np.float64) if self.largest < EXACT else None

    def walk(self, anchor: np.ndarray, enough):
        """Sorted access until ``enough(threshold, rows met, their scores)``; rows and scores of everything met."""
        n, up, down = len(self.rows), np.flatnonzero(anchor < 0), np.flatnonzero(anchor > 0)
        exact = self.doubles is not None and self.largest * float(np.abs(anchor).max(initial=0)) * len(anchor) < EXACT
        table, query = (self.doubles, anchor.astype(np.float64)) if exact else (self.rows, anchor)
        seen = np.zeros(n, dtype=bool)
        score = np.zeros(n, dtype=np.int64)
        if len(up) + len(down) == 0:
            seen[:] = True
        start, depth = (0, DEPTH) if not seen.all() else (n, 0)
        while start < n:
            end = min(n, start + depth)
            met = np.zeros(n, dtype=bool)
            met[self.order[up, start:end]] = True
            met[self.order[down, n - end : n - start]] = True
            new = np.flatnonzero(met & ~seen)
            seen[new] = True
            # Where a step meets many rows, one product over the block is cheaper than picking them out.
            score[new] = table[new] @ query if 4 * len(new) < n else (table @ query)[new]
            ends = np.append(self.order[up, end - 1], self.order[down, n - end])
            used = np.append(up, down)
            if exact:
                threshold = int(query[used] @ table[ends, used])
            else:
                # Python integers: a made-up row may score more than any real one.
                threshold = sum(int(a) * int(x) for a, x in zip(anchor[used], self.rows[ends, used]))
            at = np.flatnonzero(seen)
            if len(at) == n or enough(threshold, at, score[at]):
                break
            start, depth = end, depth * 2
        at = np.flatnonzero(seen)
        return at, score[at]


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, ties by the smaller id."""
    if len(score) > 4 * k:
        cut = np.partition(score, len(score) - k)[len(score) - k]
        near = np.flatnonzero(score >= cut)
    else:
        near = np.arange(len(score))
    return near[np.lexsort((ids[near], -score[near]))[:k]]


def _kth(score: np.ndarray, k: int) -> int | None:
    return int(np.partition(score, len(score) - k)[len(score) - k]) if len(score) >= k else None


def _matrix(vectors: Sequence, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _width(*frames: pd.DataFrame) -> int:
    return max((len(v) for f in frames for v in f["vec"]), default=0)


def _find_positives(k: int):
    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = {"anchor_id": [], "positive_id": [], "positive_score": []}
        if len(anchors) and len(rows):
            width = _width(anchors, rows)
            ids, labels, vectors = rows["id"].to_numpy(), rows["label"].to_numpy(), _matrix(rows["vec"].to_list(), width)
            queries = _matrix(anchors["vec"].to_list(), width)
            for label, part in anchors.reset_index(drop=True).groupby("label"):
                lists = SortedLists(vectors, np.flatnonzero(labels == label))
                own = ids[lists.members]
                for i in part.index:
                    anchor = part["id"][i]

                    def enough(threshold, at, score):
                        kth = _kth(score[own[at] != anchor], k)
                        return kth is not None and threshold < kth

                    at, score = lists.walk(queries[i], enough)
                    other = own[at] != anchor
                    at, score = at[other], score[other]
                    best = _best(score, own[at], k)
                    out["anchor_id"] += [anchor] * len(best)
                    out["positive_id"] += own[at[best]].tolist()
                    out["positive_score"] += score[best].tolist()
        return pd.DataFrame(out)

    return run


def window(positive_score: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest integer score between ``low`` and ``high`` hundredths of a positive's score."""
    return -(-low * positive_score // 100), high * positive_score // 100


def _find_negatives(k: int, low: int, high: int):
    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = {"anchor_id": [], "positive_id": [], "positive_score": [], "negative_id": [], "negative_score": []}
        if len(anchors) and len(rows):
            width = _width(anchors, rows)
            ids, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
            lists = SortedLists(_matrix(rows["vec"].to_list(), width))
            queries = _matrix(anchors["vec"].to_list(), width)
            for i, (anchor, label, positives) in enumerate(zip(anchors["id"], anchors["label"], anchors["positives"])):
                windows = [(p, s, *window(s, low, high)) for p, s in ((x["id"], x["score"]) for x in positives)]

                def enough(threshold, at, score):
                    different = score[labels[at] != label]
                    for _, _, least, most in windows:
                        if least <= most and threshold >= least:
                            kth = _kth(different[(different >= least) & (different <= most)], k)
                            if kth is None or threshold >= kth:
                                return False
                    return True

                at, score = lists.walk(queries[i], enough)
                different = labels[at] != label
                at, score = at[different], score[different]
                for positive, own, least, most in windows:
                    inside = np.flatnonzero((score >= least) & (score <= most))
                    best = inside[_best(score[inside], ids[at[inside]], k)]
                    out["anchor_id"] += [anchor] * len(best)
                    out["positive_id"] += [positive] * len(best)
                    out["positive_score"] += [own] * len(best)
                    out["negative_id"] += ids[at[best]].tolist()
                    out["negative_score"] += score[best].tolist()
        return pd.DataFrame(out)

    return run


def integer_rows(vectors: DataFrame, id_col: str, vector: str, label: str, scale: int = SCALE) -> DataFrame:
    """``id, label, vec``: components ``floor(scale * x)`` of the rows that take part, one row per id."""
    as_double = F.col(vector).cast("array<double>")
    finite = F.forall(as_double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    scaled = F.transform(as_double, lambda x: F.floor(x * F.lit(float(scale))).cast("double"))
    length = F.aggregate("scaled", F.lit(0.0), lambda s, x: s + x * x)
    return (
        vectors.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & finite)
        .select(F.col(id_col).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), scaled.alias("scaled"))
        .where(length < F.lit(LONGEST))
        .groupBy("id").agg(F.min(F.struct("label", F.col("scaled").cast("array<bigint>").alias("vec"))).alias("r"))
        .select("id", "r.label", "r.vec")
    )


def _blocks(n: int, rows: int) -> int:
    return max(1, -(-n // rows))


def _met(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, block_rows: int, block_anchors: int):
    """Both sides keyed by the pair of their blocks; the smaller blocks are, the more often a row travels."""
    # Both sides come from one table; a cogroup needs columns of its own for each.
    rows = rows.select(*[F.col(c).alias(f"r_{c}") for c in rows.columns]).toDF(*rows.columns)
    a, r = _blocks(n_anchors, block_anchors), _blocks(n_rows, block_rows)
    spread = lambda df, own, k, other, m: df.withColumn(
        own, F.pmod(F.xxhash64("id"), F.lit(k)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
    left = spread(anchors, "__ab", a, "__rb", r).groupBy("__ab", "__rb")
    return left.cogroup(spread(rows, "__rb", r, "__ab", a).groupBy("__ab", "__rb"))


def mine(
    vectors: DataFrame, anchors: str, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    block_rows: int = BLOCK_ROWS, block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` is a condition on ``id`` that names the query rows. A row takes no part if its id, label or vector is null,
    if a component is null or not finite, or if its scaled components have a squared length of 2^62 or more (scores would
    not fit a long). Shorter vectors count as padded with zeros; an empty vector scores 0. Of rows that
    share an id one counts: the least label, then the least vector. Higher scores come first, ties by smaller id. Fewer positives or negatives than asked for give all there are; a window without a row gives no
    row. An empty table gives an empty table. Other columns are not read. Block sizes only change the work plan.
    """
    rows = materialize(integer_rows(vectors, id_col, vector, label), "integer-vectors")
    chosen = rows.where(anchors)
    n_rows, n_anchors = rows.count(), chosen.count()
    best_first = lambda score, key: [F.col(score).desc(), F.col(key)]
    found = _met(chosen, rows, n_anchors, n_rows, block_rows, block_anchors).applyInPandas(
        _find_positives(positives), "anchor_id bigint, positive_id bigint, positive_score bigint"
    )
    found = top_n_per_group(found, ["anchor_id"], best_first("positive_score", "positive_id"), positives)
    # At most ``positives`` rows an anchor.
    wanted = materialize(
        found.groupBy("anchor_id").agg(F.collect_list(
            F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives")),
        "positives",
    )
    queries = chosen.join(wanted, chosen["id"] == wanted["anchor_id"]).drop("anchor_id")
    found = _met(queries, rows, n_anchors, n_rows, block_rows, block_anchors).applyInPandas(
        _find_negatives(negatives, low, high),
        "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint",
    )
    best = top_n_per_group(found, ["anchor_id", "positive_id"], best_first("negative_score", "negative_id"), negatives)
    return best.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark, sf_dir):
    """Hard negatives of every fiftieth vector against all vectors, with labels moved where the id is divisible by 7."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.withColumn("label", moved), "id % 50 = 0")


OP13_SQL = """
WITH q AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
    list_dot_product(a.v, r.v)::BIGINT AS score
  FROM q a JOIN q r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank,
  s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
