"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one representative a group.

Every vector has a home cell, the centre with the largest dot product. A vector within the threshold
angle of ``y`` can only be at home in cell ``c`` if ``y`` lies within that angle of the plane that
separates ``c`` from the home cell of ``y``, so ``y`` visits exactly those cells, and no pair is lost.
A pair of different homes is compared in the lower of the two cells only. Cells larger than a block
are compared block against block, each pair of blocks in a group of its own. A block returns link counts
and a spanning forest of its links, never the pairs. Equal vectors are collapsed first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import table
from .components import components

#: Nodes without an id sort after all ids.
NO_ID = 1 << 62
STRIP = 512


def _centres(rows: DataFrame, cells: int, width: int, seed: int) -> np.ndarray:
    """Unit centres; at most ``cells * width`` doubles come to the driver."""
    if cells == 1:
        return np.zeros((1, width))
    padded = F.slice(F.concat(F.col("vec"), F.array_repeat(F.lit(0.0), width)), 1, width)
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    unit = F.transform(padded, lambda x: x / norm)
    train = rows.select(array_to_vector(unit).alias("features"))
    fit = KMeans(k=cells, maxIter=5, distanceMeasure="cosine", initMode="random", seed=seed).fit(train)
    found = np.array(fit.clusterCenters())
    return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-300)


def _unit(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _placer(centres: np.ndarray, threshold: float):
    reach = math.sqrt(max(0.0, 1 - threshold * threshold)) + 1e-9 if threshold > 0 else 1e9
    apart = np.linalg.norm(centres[:, None, :] - centres[None, :, :], axis=2) if len(centres) <= 64 else None

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 4096):
                part = pdf.iloc[at : at + 4096]
                unit = _unit(part["vec"].to_list(), centres.shape[1])
                dots = unit @ centres.T
                home = dots.argmax(axis=1)
                gap = dots[np.arange(len(part)), home][:, None] - dots
                if apart is not None:
                    far = apart[home]
                else:
                    far = np.sqrt(np.maximum(2 - 2 * (centres[home] @ centres.T), 0))
                visits = gap <= reach * far + 1e-9
                visits &= np.arange(len(centres))[None, :] < home[:, None]
                visits[np.arange(len(part)), home] = True
                row, cell = np.nonzero(visits)
                yield pd.DataFrame({
                    "row": part["row"].to_numpy()[row], "node": part["node"].to_numpy()[row],
                    "weight": part["weight"].to_numpy()[row], "vec": part["vec"].to_numpy()[row],
                    "cell": cell, "guest": cell != home[row],
                })

    return place


def _comparer(threshold: float, width: int):
    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        left = pdf["side"].to_numpy() != 1
        right = pdf["side"].to_numpy() != 0
        unit = _unit(pdf["vec"].to_list(), width)
        size = pdf["vec"].map(len).to_numpy()
        weight = pdf["weight"].to_numpy()
        a, b = np.flatnonzero(left), np.flatnonzero(right)
        same_block = bool((pdf["side"] == 2).all())
        count = np.zeros(len(pdf), dtype=np.int64)
        label = np.arange(len(pdf))
        for at in range(0, len(a), STRIP):
            rows = a[at : at + STRIP]
            near = (unit[rows] @ unit[b].T >= threshold) & (size[rows][:, None] == size[b][None, :])
            if same_block:
                near &= rows[:, None] != b[None, :]
            count[rows] += near @ weight[b]
            if not same_block:
                count[b] += weight[rows] @ near
            for i in np.flatnonzero(near.any(axis=1)):
                others = label[b[near[i]]]
                own = label[rows[i]]
                if (others != own).any():
                    merged = np.unique(np.append(others, own))
                    label[np.isin(label, merged)] = merged[0]
        row, node = pdf["row"].to_numpy(), pdf["node"].to_numpy()
        linked = np.flatnonzero(count > 0)
        tied = np.flatnonzero(label != np.arange(len(pdf)))
        tied = tied[node[tied] != node[label[tied]]]
        return pd.DataFrame({
            "row": np.append(row[linked], row[tied]), "n": np.append(count[linked], np.zeros(len(tied), np.int64)),
            "a": np.append(node[linked], node[tied]), "b": np.append(node[linked], node[label[tied]]),
        })

    return compare


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", threshold: float = 0.95,
    cell_rows: int = 4096, max_cells: int = 1024, block_rows: int = 4096, seed: int = 7,
) -> DataFrame:
    """One row per input row: its columns plus ``n_links, component_id, kept``.

    Two vectors link if they have the same length and their cosine in double precision is at least
    ``threshold``. Vectors that are null, empty, zero, or hold a null or non-finite component link with
    nothing and form their own component. Equal vectors link. Rows that share an id are one node;
    a row with a null id counts as a link of others, gets the smallest id it reaches (null if none) and
    is not kept. An empty table gives an empty table. ``cell_rows``, ``max_cells`` and ``block_rows``
    only change the work plan. Clashing output columns of the input are replaced.
    """
    spark = vectors.sparkSession
    out = ("n_links", "component_id", "kept")
    vectors = vectors.drop(*[c for c in out if c != id_col])
    as_double = F.col(vector).cast("array<double>")
    finite = F.forall(as_double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    nonzero = F.exists(as_double, lambda x: x != 0)
    usable = F.coalesce(finite & nonzero, F.lit(False))
    distinct = (
        vectors.where(usable).groupBy(as_double.alias("vec"))
        .agg(F.min(id_col).cast("bigint").alias("first_id"), F.count("*").alias("weight"))
        .withColumn("node", F.coalesce("first_id", F.lit(NO_ID) + F.abs(F.xxhash64("vec") % (1 << 61))))
    )
    rows = materialize(distinct.withColumn("row", F.monotonically_increasing_id()), "vectors")
    n, width = rows.agg(F.count("*"), F.max(F.size("vec"))).first()
    links = spark.createDataFrame([], "row bigint, n bigint, a bigint, b bigint")
    if n:
        cells = max(1, min(max_cells, math.ceil(n / cell_rows)))
        centres = _centres(rows, cells, width, seed)
        placed = materialize(
            rows.select("row", "node", "weight", "vec").mapInPandas(
                _placer(centres, threshold),
                "row bigint, node bigint, weight bigint, vec array<double>, cell int, guest boolean",
            ),
            "cells",
        )
        # One row a cell, at most max_cells of them.
        sizes = placed.groupBy("cell").agg(
            F.ceil(F.count_if(~F.col("guest")) / block_rows).cast("int").alias("homes"),
            F.ceil(F.count_if("guest") / block_rows).cast("int").alias("guests"),
        )
        block = F.pmod(F.xxhash64("row"), F.when(F.col("guest"), F.col("guests")).otherwise(F.col("homes"))).cast("int")
        # A home block meets itself, the later home blocks and every guest block (numbered after them).
        spread = placed.join(F.broadcast(sizes), "cell").withColumn("block", block).withColumn(
            "pairs",
            F.expr("""
                if(guest,
                   if(homes = 0, array(), transform(sequence(0, homes - 1), i -> struct(i AS i, homes + block AS j, 1 AS side))),
                   concat(
                     transform(sequence(0, block), i -> struct(i AS i, block AS j, if(i = block, 2, 1) AS side)),
                     if(block + 1 < homes + guests,
                        transform(sequence(block + 1, homes + guests - 1), j -> struct(block AS i, j AS j, 0 AS side)),
                        array())))
            """),
        )
        tasks = spread.select("cell", F.inline("pairs"), "row", "node", "weight", "vec")
        links = materialize(
            tasks.groupBy("cell", "i", "j").applyInPandas(
                _comparer(threshold, width), "row bigint, n bigint, a bigint, b bigint"
            ),
            "vector-links",
        )
    counts = links.groupBy("row").agg(F.sum("n").alias("others"))
    groups = components(links, "a", "b").select("node", "component")
    known = (
        rows.join(counts, "row", "left").join(groups, "node", "left")
        .select(
            F.col("vec").alias("__vec"),
            (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("__component"),
        )
    )
    component = F.when(F.col("__vec").isNull(), F.col(id_col).cast("bigint")).otherwise(
        F.when(F.col("__component") < NO_ID, F.col("__component"))
    )
    return (
        vectors.withColumn("__key", F.when(usable, as_double))
        .join(known, F.col("__key") == F.col("__vec"), "left")
        .select(
            *vectors.columns,
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            component.alias("component_id"),
            F.coalesce(F.col(id_col) == component, F.lit(False)).alias("kept"),
        )
    )


def op1_embedding_dedup(spark, sf_dir):
    """Near-duplicate groups of all embeddings at cosine 0.95."""
    found = near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.select("vec_id", "n_links", "component_id", "kept")


OP1_SQL = """
WITH RECURSIVE ok AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), unit AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM ok
), pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.95
), reach AS (
  SELECT vec_id AS node, vec_id AS seen FROM embeddings
  UNION
  SELECT r.node, p.b FROM reach r JOIN pairs p ON p.a = r.seen
), least_seen AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least_seen l ON l.node = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id
"""
