"""Quarterly series: index, totals, model features, unit-root diagnostics, seasonal profile.

Series come in long form: one row per (keys, quarter) with ``Quarter_Idx``, ``Quarter_Num``,
``Year_Quarter`` and ``Value``. ``keys`` always includes ``Target``; extra keys give many series in
one plan.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from ..functions.quarters import shift_label
from .scale import lookup_join

TARGETS = ("Revenue", "Profit")


def quarter_calendar(fact: DataFrame) -> DataFrame:
    """Observed quarters with a dense index. A year has at most ten one-digit quarter numbers, so it is small."""
    quarters = fact.select("Year_Quarter", "Year", "Quarter_Num").distinct()
    order = Window.orderBy("Year", "Quarter_Num", "Year_Quarter")
    return quarters.withColumn("Quarter_Idx", F.row_number().over(order))


def add_quarter_index(df: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    calendar = quarter_calendar(df) if calendar is None else calendar
    return lookup_join(df, calendar.select("Year_Quarter", "Quarter_Idx"), "Year_Quarter")


def quarterly_series(
    fact: DataFrame, targets: Sequence[str] = TARGETS, keys: Sequence[str] = ()
) -> DataFrame:
    """Summed targets per quarter (and key), one scan; the index is ranked on the grouped rows."""
    keys = list(keys)
    totals = fact.groupBy(*keys, "Year_Quarter", "Year", "Quarter_Num").agg(*[F.sum(t).alias(t) for t in targets])
    calendar = quarter_calendar(totals).select("Year_Quarter", "Quarter_Idx")
    return totals.join(calendar, "Year_Quarter").select(
        *keys, "Year_Quarter", "Quarter_Idx", "Quarter_Num", *targets
    )


def long_series(series: DataFrame, targets: Sequence[str] = TARGETS) -> DataFrame:
    """One row per target instead of one column per target."""
    others = [c for c in series.columns if c not in targets]
    values = F.array(*[
        F.struct(F.lit(t).alias("Target"), F.col(t).cast("double").alias("Value")) for t in targets
    ])
    return series.select(*others, F.inline(values))


def _by(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy("Quarter_Idx")


def _seasonal_columns(idx, quarter) -> dict:
    angle = 2 * math.pi * quarter / 4
    return {
        "trend": idx, "trend_sq": idx * idx, "q_sin": F.sin(angle), "q_cos": F.cos(angle),
        "is_q4": (quarter == 4).cast("int"), "is_q1": (quarter == 1).cast("int"),
    }


def forecast_features(series: DataFrame, keys: Sequence[str] = ("Target",)) -> DataFrame:
    """Lags, trailing mean and deviation of four quarters, growth and season encoding."""
    order = _by(keys)
    trailing = order.rowsBetween(-3, 0)
    df = series.withColumns({f"lag{n}": F.lag("Value", n).over(order) for n in (1, 4, 5)})
    full = F.count("lag1").over(trailing) == 4
    return df.withColumns(
        {
            "roll4_mean": F.when(full, F.avg("lag1").over(trailing)),
            "roll4_std": F.coalesce(F.when(full, F.stddev_samp("lag1").over(trailing)), F.lit(0.0)),
            "yoy_growth": ratio("lag1", "lag5"),
            **_seasonal_columns(F.col("Quarter_Idx"), F.col("Quarter_Num")),
        }
    )


def next_forecast_row(series: DataFrame, keys: Sequence[str] = ("Target",)) -> DataFrame:
    """Features of the quarter after the last one; a missing lag falls back to the mean of the last four."""
    keys = list(keys)
    age = F.max("Quarter_Idx").over(Window.partitionBy(*keys)) - F.col("Quarter_Idx")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("Quarter_Idx").desc()))
    last4 = F.when(F.col("__rank") <= 4, F.col("Value"))
    state = (
        series.withColumn("__age", age).withColumn("__rank", rank).groupBy(*keys).agg(
            F.max_by("Year_Quarter", "Quarter_Idx").alias("__label"),
            (F.max("Quarter_Idx") + 1).alias("Quarter_Idx"),
            F.max_by("Value", "Quarter_Idx").alias("lag1"),
            F.max(F.when(F.col("__age") == 3, F.col("Value"))).alias("__lag4"),
            F.max(F.when(F.col("__age") == 4, F.col("Value"))).alias("__lag5"),
            F.avg(last4).alias("roll4_mean"),
            F.coalesce(F.stddev_samp(last4), F.lit(0.0)).alias("roll4_std"),
        )
    )
    label, quarter = shift_label("__label", F.lit(1))
    return (
        state.withColumns(
            {
                "Year_Quarter": label, "Quarter_Num": quarter,
                "lag4": F.coalesce("__lag4", "roll4_mean"), "lag5": F.coalesce("__lag5", "roll4_mean"),
            }
        )
        .withColumn("yoy_growth", F.coalesce(ratio("lag1", "lag5"), F.lit(1.0)))
        .withColumns(_seasonal_columns(F.col("Quarter_Idx"), F.col("Quarter_Num")))
        .select(
            *keys, "Year_Quarter", "Quarter_Idx", "Quarter_Num", "lag1", "lag4", "lag5", "roll4_mean", "roll4_std",
            "yoy_growth", "trend", "trend_sq", "q_sin", "q_cos", "is_q4", "is_q1",
        )
    )


def series_transforms(series: DataFrame, keys: Sequence[str] = ("Target",)) -> DataFrame:
    """Level, log level, first, seasonal and combined difference as rows."""
    order = _by(keys)
    df = series.withColumns({f"__lag{n}": F.lag("Value", n).over(order) for n in (1, 4, 5)})
    value = F.col("Value")
    variants = {
        "level": value,
        "log_level": F.log1p(value),
        "diff_1": value - F.col("__lag1"),
        "seasonal_diff_4": value - F.col("__lag4"),
        "diff_1_and_seasonal_diff_4": (value - F.col("__lag1")) - (F.col("__lag4") - F.col("__lag5")),
    }
    rows = F.array(*[F.struct(F.lit(n).alias("Transform"), e.alias("Transformed")) for n, e in variants.items()])
    return df.select(*keys, "Year_Quarter", "Quarter_Idx", F.inline(rows))


def stationarity_diagnostics(
    series: DataFrame, keys: Sequence[str] = ("Target",), critical_value: float = -2.86
) -> DataFrame:
    """Dickey-Fuller statistic (constant, no extra lags) per transform.

    Null below eight observations or when the series is constant.
    """
    groups = [*keys, "Transform"]
    rows = series_transforms(series, keys).where(F.col("Transformed").isNotNull())
    rows = rows.withColumn("__x", F.lag("Transformed").over(_by(groups)))
    rows = rows.withColumn("__dy", F.col("Transformed") - F.col("__x"))
    fit = rows.groupBy(*groups).agg(
        F.count("Transformed").alias("N_Obs"),
        (F.min("Transformed") == F.max("Transformed")).alias("__flat"),
        F.regr_slope("__dy", "__x").alias("__slope"), F.regr_sxx("__dy", "__x").alias("__sxx"),
        F.regr_syy("__dy", "__x").alias("__syy"), F.regr_sxy("__dy", "__x").alias("__sxy"),
        F.regr_count("__dy", "__x").alias("__n"),
    )
    residual = F.greatest(F.col("__syy") - F.col("__slope") * F.col("__sxy"), F.lit(0.0))
    error = F.sqrt(ratio(ratio(residual, F.col("__n") - 2), "__sxx"))
    usable = (F.col("N_Obs") >= 8) & ~F.col("__flat")
    statistic = F.when(usable, ratio("__slope", error))
    return fit.select(
        *groups, statistic.alias("DF_Statistic"),
        F.coalesce(statistic < critical_value, F.lit(False)).alias("Stationary"), "N_Obs",
    )


def _swept(sums: dict[tuple[str, str], Column], names: Sequence[str]) -> dict[tuple[str, str], Column]:
    """Cross products of ``x`` and ``y`` with the other regressors taken out, one after the other."""
    left = dict(sums)
    at = lambda a, b: left[(a, b)] if (a, b) in left else left[(b, a)]
    for n, pivot in enumerate(names):
        rest = [*names[n + 1 :], "x", "y"]
        left = {
            (a, b): at(a, b) - F.try_divide(at(a, pivot) * at(b, pivot), at(pivot, pivot))
            for i, a in enumerate(rest) for b in rest[i:]
        }
    return left


def lagged_unit_root(
    series: DataFrame, keys: Sequence[str] = ("Target",), max_lag: int = 2, critical_value: float = -2.86
) -> DataFrame:
    """Dickey-Fuller statistics with 0 to ``max_lag`` lagged differences, one row per transform and lag.

    The regressions are normal equations in grouped sums: centred cross products, from which constant and lagged
    differences are swept out. ``AIC`` is computed on the rows that every lag can use and picks the lag (``Selected``, the
    smaller of equals); the statistic uses all rows its lag can use. Null below eight observations, for a constant
    series, and where a regressor is constant or a fit leaves no degree of freedom.
    """
    groups = [*keys, "Transform"]
    order = _by(groups)
    rows = series_transforms(series, keys).where(F.col("Transformed").isNotNull())
    rows = rows.withColumn("x", F.lag("Transformed").over(order)).withColumn("y", F.col("Transformed") - F.col("x"))
    rows = rows.withColumns({f"d{i}": F.lag("y", i).over(order) for i in range(1, max_lag + 1)})
    sums: dict[str, Column] = {"N_Obs": F.count("Transformed"), "__flat": F.min("Transformed") == F.max("Transformed")}
    for lag in range(max_lag + 1):
        usable = F.col(f"d{lag}" if lag else "x").isNotNull()
        sums[f"n{lag}"] = F.count_if(usable)
        names = [*[f"d{i}" for i in range(1, lag + 1)], "x", "y"]
        for i, a in enumerate(names):
            for b in names[i:]:
                product = F.covar_pop(F.when(usable, F.col(a)), F.when(usable, F.col(b))) * F.count_if(usable)
                sums[f"s{lag}_{a}_{b}"] = product
    fit = rows.groupBy(*groups).agg(*[e.alias(n) for n, e in sums.items()])

    def residual(sample: int, lag: int) -> tuple[Column, Column, Column]:
        """Cross products of x with itself and y, and the sum of squared residuals, of a lag on the rows of a sample."""
        names = [f"d{i}" for i in range(1, lag + 1)]
        every = [*names, "x", "y"]
        left = _swept({(a, b): F.col(f"s{sample}_{a}_{b}") for i, a in enumerate(every) for b in every[i:]}, names)
        xx, xy = left[("x", "x")], left[("x", "y")]
        return xx, xy, F.greatest(left[("y", "y")] - F.try_divide(xy * xy, xx), F.lit(0.0))

    parts = []
    for lag in range(max_lag + 1):
        xx, xy, sse = residual(lag, lag)
        n, common = F.col(f"n{lag}"), F.col(f"n{max_lag}")
        freedom = n - lag - 2
        error = F.sqrt(ratio(F.when(freedom > 0, F.try_divide(sse, freedom.cast("double"))), xx))
        usable = (F.col("N_Obs") >= 8) & ~F.col("__flat")
        shared = residual(max_lag, lag)[2]
        aic = F.when(shared > 0, common * F.log(shared / common) + 2 * (lag + 2))
        parts.append(F.struct(
            F.lit(lag).alias("Lag"), F.when(usable, ratio(F.try_divide(xy, xx), error)).alias("DF_Statistic"),
            F.when(usable, aic).alias("AIC"), n.alias("N_Used")))
    each = fit.select(*groups, "N_Obs", F.inline(F.array(*parts)))
    best = Window.partitionBy(*groups).orderBy(F.col("AIC").asc_nulls_last(), "Lag")
    return each.withColumns({
        "Selected": F.row_number().over(best) == 1,
        "Stationary": F.coalesce(F.col("DF_Statistic") < critical_value, F.lit(False)),
    })


def seasonal_profile(series: DataFrame, keys: Sequence[str] = ("Target",)) -> DataFrame:
    """Mean per quarter number and its ratio to the overall mean."""
    sums = series.groupBy(*keys, "Quarter_Num").agg(F.sum("Value").alias("__sum"), F.count("Value").alias("__n"))
    whole = Window.partitionBy(*keys)
    overall = ratio(F.sum("__sum").over(whole), F.sum("__n").over(whole))
    return sums.select(
        *keys, "Quarter_Num", ratio("__sum", "__n").alias("Quarter_Average"),
        ratio(ratio("__sum", "__n"), overall).alias("Seasonal_Index"),
    )
