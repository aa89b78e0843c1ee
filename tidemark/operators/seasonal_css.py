"""Seasonal autoregressive moving-average models by conditional sums of squares.

A model with orders ``(p, d, q)`` and ``(P, 1, Q, 4)`` works on the seasonal difference of a series, or its first difference
(d = 1). Its one-step errors are folded along the series from zero, ``e = w - forecast``, for every point of a fixed grid of
coefficients, and the point with the least sum of squares up to a quarter gives the forecast of the next. One fold along a
series yields the sums at all its quarters, so every fold of every series and model comes from one pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MODEL = "SeasonalCSS"
# Orders of the candidates besides the random walk and the two autoregressions in closed form.
ORDERS = (
    ((0, 1, 1), (0, 1, 0, 4)), ((1, 1, 1), (0, 1, 0, 4)), ((0, 0, 1), (0, 1, 0, 4)), ((1, 1, 0), (1, 1, 0, 4)),
    ((0, 1, 1), (0, 1, 1, 4)), ((1, 1, 1), (1, 1, 0, 4)), ((1, 1, 1), (0, 1, 1, 4)), ((2, 1, 0), (0, 1, 0, 4)),
    ((0, 1, 2), (0, 1, 0, 4)),
)
#: Autoregressive, seasonal autoregressive, moving-average and seasonal moving-average coefficients.
COEFFICIENTS = ("a1", "a2", "as4", "m1", "m2", "ms4")
#: Hundredths between neighbouring grid values, by the number of coefficients of a model; the grid stays inside (-1, 1).
STEPS = {1: 5, 2: 10, 3: 20}
LAGS = tuple(f"{kind}{i}" for kind in "we" for i in range(1, 6))
STATE = "sse double, " + ", ".join(f"{c} double" for c in LAGS)


def grid_values(free: int) -> list[float]:
    step = STEPS[free]
    return [i / 100 for i in range(-100 + step, 100, step)]


def grid_points(order: tuple, seasonal: tuple) -> list[tuple[float, ...]]:
    """Coefficients to try, in the order of ``COEFFICIENTS``; explosive pairs of second-order terms are left out."""
    free = [order[0] >= 1, order[0] >= 2, seasonal[0] >= 1, order[2] >= 1, order[2] >= 2, seasonal[2] >= 1]
    values = grid_values(sum(free))
    points = product(*[values if f else [0.0] for f in free])
    return [p for p in points if p[1] + abs(p[0]) < 1 and abs(p[3]) - p[4] < 1]


def grid(spark: SparkSession) -> DataFrame:
    """All points of all models: a few thousand rows, whatever the series."""
    rows = [
        (MODEL, str(order), str(seasonal), order[1], *point)
        for order, seasonal in ORDERS for point in grid_points(order, seasonal)
    ]
    return spark.createDataFrame(
        rows, "Model string, Order string, Seasonal_Order string, __d int, " + ", ".join(f"{c} double" for c in COEFFICIENTS))


def expected(state: Column) -> Column:
    """The next value of the differenced series."""
    w, e = ([state[f"{kind}{i}"] for i in range(1, 6)] for kind in "we")
    a1, a2, as4, m1, m2, ms4 = (F.col(c) for c in COEFFICIENTS)
    return (a1 * w[0] + a2 * w[1] + as4 * w[3] - a1 * as4 * w[4]
            + m1 * e[0] + m2 * e[1] + ms4 * e[3] + m1 * ms4 * e[4])


def moved(state: Column, w: Column, error: Column) -> Column:
    """The state after a value ``w`` that missed its forecast by ``error``."""
    lags = {"w1": w, "e1": error, **{f"{k}{i}": state[f"{k}{i - 1}"] for k in "we" for i in range(2, 6)}}
    return F.struct((state["sse"] + error * error).alias("sse"), *[lags[c].alias(c) for c in LAGS])


def start() -> Column:
    return F.struct(*[F.lit(0.0).alias(c) for c in ("sse", *LAGS)])


def _folded(history: Column) -> Column:
    """``at, sse, next`` after each element (``at``, ``w``) of a history, and the last state."""
    kind = "array<struct<at: int, sse: double, next: double>>"
    begin = F.struct(start().alias("state"), F.array().cast(kind).alias("seen"))

    def step(acc, x):
        after = moved(acc["state"], x["w"], x["w"] - expected(acc["state"]))
        seen = F.struct(x["at"].alias("at"), after["sse"].alias("sse"), expected(after).alias("next"))
        return F.struct(after.alias("state"), F.concat(acc["seen"], F.array(seen)).alias("seen"))

    return F.aggregate(history, begin, step)


def _histories(differenced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per series its seasonal and combined differences in order; a series has one short row per quarter."""
    item = lambda c: F.struct(F.col("Quarter_Idx").cast("int").alias("at"), F.col(c).alias("w"))
    ordered = lambda c: F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), item(c))))
    return differenced.groupBy(*keys).agg(ordered("__sd").alias("__h0"), ordered("__cd").alias("__h1"))


def _fitted(differenced: DataFrame, keys: Sequence[str]) -> DataFrame:
    # The grid is a constant table, so the product grows with the number of series alone. Points of a series are spread.
    spark = differenced.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tried = _histories(differenced, keys).crossJoin(F.broadcast(grid(spark))).repartition(width, *keys, *COEFFICIENTS)
    history = F.when(F.col("__d") == 0, F.col("__h0")).otherwise(F.col("__h1"))
    # A generator evaluates the fold once, however often its fields are read.
    names = ["Model", "Order", "Seasonal_Order", "__d", *COEFFICIENTS]
    return tried.select(*keys, *names, F.inline(F.array(_folded(history))))


def one_step(differenced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Forecast of every quarter that has a difference before it: ``keys, Quarter_Idx, Model, Order, Seasonal_Order, __d, __next``."""
    names = ["Model", "Order", "Seasonal_Order", "__d"]
    states = _fitted(differenced, keys).select(*keys, *names, *COEFFICIENTS, F.explode("seen").alias("s"))
    best = states.groupBy(*keys, (F.col("s.at") + 1).alias("Quarter_Idx"), *names).agg(
        F.min(F.struct("s.sse", *COEFFICIENTS, "s.next")).alias("b"))
    return best.select(*keys, "Quarter_Idx", *names, F.col("b.next").alias("__next"))


def fits(differenced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per series and model the best coefficients over the whole series and the state after its last quarter."""
    names = ["Model", "Order", "Seasonal_Order", "__d"]
    tried = _fitted(differenced, keys).where(F.size("seen") > 0)
    best = tried.groupBy(*keys, *names).agg(
        F.min(F.struct("state.sse", *COEFFICIENTS, "state")).alias("b"))
    return best.select(*keys, *names, *[F.col(f"b.{c}").alias(c) for c in COEFFICIENTS], F.col("b.state").alias("__state"))


def path(periods: int) -> Column:
    """Values of the next quarters from ``__state``, the last seasonal difference ``__sd`` and the last four values
    ``__year`` (newest first)."""
    begin = F.struct(
        F.col("__state").alias("state"), F.col("__sd").cast("double").alias("sd"),
        F.reverse("__year").alias("year"), F.array().cast("array<double>").alias("out"))

    def step(acc, _):
        w = expected(acc["state"])
        sd = F.when(F.col("__d") == 0, w).otherwise(acc["sd"] + w)
        value = acc["year"][0] + sd
        return F.struct(
            moved(acc["state"], w, F.lit(0.0)).alias("state"), sd.alias("sd"),
            F.concat(F.slice(acc["year"], 2, 3), F.array(value)).alias("year"), F.concat(acc["out"], F.array(value)).alias("out"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(periods)), begin, step, lambda acc: acc["out"])
