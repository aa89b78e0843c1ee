"""Building blocks that keep global operations distributed.

Size-checked lookups, dense row numbers, exact quantiles, running totals over a global order and
top-n per group. None of them sends an unbounded group through one task or the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

LOOKUP_ROWS = 100_000
LOOKUP_BYTES = 8 * 1024 * 1024
LITERAL_ROWS = 64
EXACT_DISTINCT = 1_000_000
BUCKETS = 256


# -- lookups -----------------------------------------------------------------------------------

def small_table(df: DataFrame, max_rows: int = LOOKUP_ROWS, max_bytes: int = LOOKUP_BYTES) -> DataFrame | None:
    """``df`` as an in-memory relation if it fits the bounds, otherwise None."""
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows or table.nbytes > max_bytes:
        return None
    return df.sparkSession.createDataFrame(table, schema=df.schema)


def lookup_join(
    df: DataFrame, lookup: DataFrame, on: str | list[str], how: str = "left", max_rows: int = LOOKUP_ROWS
) -> DataFrame:
    """Join a derived lookup by measured size.

    A handful of key-value pairs becomes a literal map (no join), a small table is broadcast, and
    anything larger is a shuffled join in which AQE splits skewed keys. The columns are those of ``df`` and
    then the values of the lookup, whatever its size; a name on both sides raises.
    """
    keys = [on] if isinstance(on, str) else list(on)
    values = [c for c in lookup.columns if c not in keys]
    clash = sorted(set(values) & set(df.columns))
    if clash:
        raise ValueError(f"columns on both sides of a lookup: {', '.join(clash)}")
    columns = [F.col(f"`{c}`") for c in [*df.columns, *values]]
    small = small_table(lookup, max_rows)
    if small is None:
        return df.join(lookup, on, how).select(*columns)
    if how == "left" and isinstance(on, str) and len(values) == 1:
        pairs = small.where(F.col(f"`{on}`").isNotNull()).limit(LITERAL_ROWS + 1).collect()
        if 0 < len(pairs) <= LITERAL_ROWS and len({r[on] for r in pairs}) == len(pairs):
            mapping = F.create_map(*[F.lit(x) for r in pairs for x in (r[on], r[values[0]])])
            found = mapping[F.col(f"`{on}`")].cast(lookup.schema[values[0]].dataType)
            return df.withColumn(values[0], found)
    return df.join(F.broadcast(small), on, how).select(*columns)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match null keys; the keys of the left side are kept."""
    keys = list(keys)
    if not keys:
        return attach_row(left, right)
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    condition = [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys]
    return left.join(renamed, condition, how).drop(*[f"__right_{k}" for k in keys])


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a global aggregate (always exactly one row) to every row."""
    return df.crossJoin(F.broadcast(one_row))


def with_share(df: DataFrame, value: str, out: str) -> DataFrame:
    """``value`` as percent of its total over all rows of ``df``."""
    total = df.agg(F.sum(value).alias("__total"))
    share = F.try_divide(F.col(value).cast("double"), F.col("__total").cast("double")) * 100
    return attach_row(df, total).withColumn(out, share).drop("__total")


# -- dense numbering ---------------------------------------------------------------------------

def sequential_ids(
    df: DataFrame, id_name: str, order_by: Sequence[str] | None = None, start: int = 1
) -> DataFrame:
    """Dense ids ``start..``: in stored order, or in ``order_by`` order when given.

    Rows are placed once (range partitions when ordered), written, and each partition's size turns
    into an offset. Copies of one row may straddle partitions, so they never pile up in one task.
    """
    position = "__position"
    rows = df
    if order_by:
        width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        tie = [F.xxhash64(*df.columns), F.col("__source")]
        rows = (
            df.withColumn("__source", F.monotonically_increasing_id())
            .repartitionByRange(width, *order_by, *tie)
            .sortWithinPartitions(*order_by, *tie)
            .drop("__source")
        )
    placed = materialize(rows.withColumn(position, F.monotonically_increasing_id()), id_name.lower())
    part = F.shiftright(position, 33)
    # One row per written partition, so both the window and the broadcast stay small.
    offsets = (
        placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__rows"))
        .withColumn(
            "__offset",
            F.coalesce(
                F.sum("__rows").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ),
        )
        .drop("__rows")
    )
    index_in_part = F.col(position).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .select((F.col("__offset") + index_in_part + start).cast("bigint").alias(id_name), *df.columns)
    )


def small_or_sequential_ids(df: DataFrame, id_name: str, order_by: Sequence[str]) -> DataFrame:
    """Dense ids for a dimension: a plain window when it measurably fits in one task."""
    small = small_table(df)
    if small is None:
        return sequential_ids(df, id_name, order_by)
    number = F.row_number().over(Window.orderBy(*order_by)).cast("bigint")
    return small.select(number.alias(id_name), *df.columns)


# -- global order ------------------------------------------------------------------------------

def split_points(df: DataFrame, value: str, buckets: int = BUCKETS) -> list[float]:
    """At most ``buckets - 1`` cut points that spread the rows of ``df`` evenly over the value range."""
    probs = [i / buckets for i in range(1, buckets)]
    points = df.agg(F.percentile_approx(F.col(value).cast("double"), probs, 10_000)).first()[0]
    # Infinite values belong to the outer buckets and are no cut points.
    return sorted({p for p in points or [] if math.isfinite(p)})


def with_bucket(df: DataFrame, value: str, splits: list[float], out: str = "__bucket") -> DataFrame:
    if not splits:
        return df.withColumn(out, F.lit(0))
    edges = [-math.inf, *splits, math.inf]
    staged = Bucketizer(splits=edges, inputCol=value, outputCol=out, handleInvalid="keep").transform(df)
    return staged.withColumn(out, F.col(out).cast("int"))


def with_running_totals(
    df: DataFrame, order_col: str, measures: Sequence[str], keys: Sequence[str] = (), buckets: int = BUCKETS
) -> DataFrame:
    """Add ``before_<m>``: sum of ``m`` over rows ordered before this one, per ``keys``.

    ``order_col`` must be unique per key. The order is cut into value buckets; totals of earlier
    buckets are added to a window that only spans one bucket.
    """
    keys = list(keys)
    bucketed = with_bucket(df, order_col, split_points(df, order_col, buckets))
    totals = bucketed.groupBy(*keys, "__bucket").agg(*[F.sum(m).alias(f"__t_{m}") for m in measures])
    earlier = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "__bucket",
        *[F.coalesce(F.sum(f"__t_{m}").over(earlier), F.lit(0)).alias(f"__o_{m}") for m in measures],
    )
    inside = Window.partitionBy(*keys, "__bucket").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    return (
        null_safe_join(bucketed, offsets, [*keys, "__bucket"])
        .select(
            *df.columns,
            *[
                (F.col(f"__o_{m}") + F.coalesce(F.sum(m).over(inside), F.lit(0))).alias(f"before_{m}")
                for m in measures
            ],
        )
    )


def exact_quantiles(
    df: DataFrame, value: Column | str, probs: Sequence[float], exact_distinct: int = EXACT_DISTINCT
) -> list[float | None]:
    """Exact linearly interpolated quantiles of any number of rows, with one pass over the source.

    Rows are first counted per distinct value. Few values: one ``percentile`` aggregate weighted by
    those counts. Many: sum the counts per value bucket, then sort only the buckets that hold a
    wanted rank.
    """
    expr = F.col(value) if isinstance(value, str) else value
    x = df.select(expr.cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    values = x.groupBy("v").agg(F.count("*").alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        distinct, n = values.agg(F.count("*"), F.sum("n")).first()
        if distinct == 0:
            return [None] * len(probs)
        if distinct <= exact_distinct:
            wanted = F.array(*[F.lit(float(p)) for p in probs])
            return list(values.agg(F.percentile("v", wanted, F.col("n"))).first()[0])
        return _bucketed_quantiles(values, n, probs)
    finally:
        values.unpersist()


def _bucketed_quantiles(values: DataFrame, n: int, probs: Sequence[float]) -> list[float]:
    bucketed = with_bucket(values, "v", split_points(values, "v"))
    sizes = {r["__bucket"]: r["n"] for r in bucketed.groupBy("__bucket").agg(F.sum("n").alias("n")).collect()}
    ranks = sorted({f(p * (n - 1)) for p in probs for f in (math.floor, math.ceil)})
    start, starts = 0, {}
    for bucket in sorted(sizes):
        if any(start <= r < start + sizes[bucket] for r in ranks):
            starts[bucket] = start
        start += sizes[bucket]
    first_rank = F.create_map(*[F.lit(i) for pair in starts.items() for i in pair])
    inside = Window.partitionBy("__bucket").orderBy("v")
    found = (
        bucketed.where(F.col("__bucket").isin(*starts))
        .withColumn("last", F.sum("n").over(inside) + first_rank[F.col("__bucket")] - 1)
        .withColumn("first", F.col("last") - F.col("n") + 1)
        .where(F.exists(F.array(*[F.lit(r) for r in ranks]), lambda r: r.between(F.col("first"), F.col("last"))))
        .select("v", "first", "last").collect()
    )
    at = {r: next(row["v"] for row in found if row["first"] <= r <= row["last"]) for r in ranks}
    out = []
    for p in probs:
        pos = p * (n - 1)
        low, high = math.floor(pos), math.ceil(pos)
        out.append(at[low] if low == high else (high - pos) * at[low] + (pos - low) * at[high])
    return out


def exact_median(df: DataFrame, value: Column | str) -> float | None:
    return exact_quantiles(df, value, [0.5])[0]


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], n: int, rank_name: str = "rank", salts: int = 64
) -> DataFrame:
    """First ``n`` rows per key. A salted round keeps a hot key out of a single task."""
    keys = list(keys)
    salted = Window.partitionBy(*keys, "__salt").orderBy(*order_by)
    final = Window.partitionBy(*keys).orderBy(*order_by)
    return (
        df.withColumn("__salt", F.spark_partition_id() % salts)
        .withColumn("__first", F.row_number().over(salted))
        .where(F.col("__first") <= n)
        .withColumn(rank_name, F.row_number().over(final))
        .where(F.col(rank_name) <= n)
        .drop("__salt", "__first")
    )
