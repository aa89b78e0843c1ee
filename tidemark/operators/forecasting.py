"""Seasonal forecasting models, rolling-origin backtest, selection and multi-step forecast.

A fold that predicts quarter v trains on quarters before v. Every model here is a function of
running aggregates, so one pass with expanding windows gives all folds of all series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import ape, ratio, round_half_even, symmetric_ape
from ..functions.quarters import shift_label
from . import seasonal_css

# name, order, seasonal order
MODELS = (
    ("SeasonalNaive", "", ""),
    ("SeasonalGrowth", "", ""),
    ("SeasonalRandomWalk", "(0, 1, 0)", "(0, 1, 0, 4)"),
    ("SeasonalAR1_CLS", "(1, 0, 0)", "(0, 1, 0, 4)"),
    ("SeasonalAR1_CLS", "(1, 1, 0)", "(0, 1, 0, 4)"),
)
#: Every candidate: the closed forms above and the moving-average models.
CANDIDATES = (*MODELS, *[(seasonal_css.MODEL, str(o), str(s)) for o, s in seasonal_css.ORDERS])
MODEL_KEY = ("Model", "Order", "Seasonal_Order")
ERROR_COLUMNS = ("Error", "MAE", "RMSE", "MAPE", "sMAPE", "Bias")


def with_differences(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add lags, YoY growth, seasonal difference ``__sd`` and combined difference ``__cd`` with their lags."""
    order = Window.partitionBy(*keys).orderBy("Quarter_Idx")
    df = series.withColumns({f"__lag{n}": F.lag("Value", n).over(order) for n in (1, 2, 3, 4, 5)})
    df = df.withColumns({"__growth": ratio("Value", "__lag4"), "__sd": F.col("Value") - F.col("__lag4")})
    df = df.withColumn("__sd1", F.lag("__sd").over(order)).withColumn("__cd", F.col("__sd") - F.col("__sd1"))
    return df.withColumn("__cd1", F.lag("__cd").over(order))


def _slope(y: str, x: str, frame) -> Column:
    """Conditional least squares AR(1) coefficient over a frame; 0 without data."""
    both = F.col(y).isNotNull() & F.col(x).isNotNull()
    top = F.sum(F.when(both, F.col(y) * F.col(x))).over(frame)
    bottom = F.sum(F.when(both, F.col(x) * F.col(x))).over(frame)
    return F.coalesce(ratio(top, bottom), F.lit(0.0))


def _growth(frame) -> Column:
    return F.coalesce(F.percentile("__growth", F.lit(0.5)).over(frame), F.lit(1.0))


def one_step_predictions(series: DataFrame, keys: Sequence[str] = ("Target",)) -> DataFrame:
    """One row per quarter and model with the forecast made from earlier quarters only."""
    keys = list(keys)
    df = with_differences(series, keys)
    order = Window.partitionBy(*keys).orderBy("Quarter_Idx")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    same_quarter = (
        Window.partitionBy(*keys, "Quarter_Num").orderBy("Quarter_Idx").rowsBetween(Window.unboundedPreceding, -1)
    )
    df = df.withColumns(
        {
            "__naive": F.coalesce(F.avg("Value").over(same_quarter), F.avg("Value").over(before)),
            "__g": _growth(before),
            "__recent": F.avg("Value").over(order.rowsBetween(-4, -1)),
            "__phi_sd": _slope("__sd", "__sd1", before),
            "__phi_cd": _slope("__cd", "__cd1", before),
        }
    )
    walk = F.col("__lag1") + F.col("__lag4") - F.col("__lag5")
    predictions = (
        F.col("__naive"),
        F.coalesce(F.col("__lag4") * F.col("__g"), F.col("__recent")),
        walk,
        F.col("__lag4") + F.col("__phi_sd") * F.col("__sd1"),
        walk + F.col("__phi_cd") * F.col("__cd1"),
    )
    rows = F.array(*[
        F.struct(
            F.lit(m).alias("Model"), F.lit(o).alias("Order"), F.lit(s).alias("Seasonal_Order"),
            F.when(p.isNotNull(), F.greatest(p, F.lit(0.0))).alias("Forecast"),
        )
        for (m, o, s), p in zip(MODELS, predictions)
    ])
    known = ["Year_Quarter", "Quarter_Idx", "Quarter_Num", "Value"]
    closed = df.select(*keys, *known, F.inline(rows))
    # Quarters without a difference before them keep a row without a forecast.
    named = F.array(*[
        F.struct(F.lit(seasonal_css.MODEL).alias("Model"), F.lit(str(o)).alias("Order"), F.lit(str(s)).alias("Seasonal_Order"))
        for o, s in seasonal_css.ORDERS
    ])
    wanted = df.withColumn("__walk", walk).select(*keys, *known, "__lag4", "__walk", F.inline(named))
    found = seasonal_css.one_step(df, keys).withColumnsRenamed({k: f"__k_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    for c in ("Quarter_Idx", *MODEL_KEY):
        same = same & (wanted[c] == found[c])
    base = F.when(F.col("__d") == 0, F.col("__lag4")).otherwise(F.col("__walk"))
    value = base + F.col("__next")
    folded = wanted.join(found, same, "left").select(
        *keys, *known[:1], wanted["Quarter_Idx"], *known[2:], *[wanted[c] for c in MODEL_KEY],
        F.when(value.isNotNull(), F.greatest(value, F.lit(0.0))).alias("Forecast"))
    return closed.unionByName(folded)


def error_columns(actual: str, predicted: str) -> dict[str, Column]:
    error = F.col(predicted) - F.col(actual)
    absolute = round_half_even(F.abs(error), 2)
    return {
        "Error": round_half_even(error, 2), "MAE": absolute, "RMSE": absolute,
        "MAPE": round_half_even(ape(actual, predicted), 4),
        "sMAPE": round_half_even(symmetric_ape(actual, predicted), 4),
        "Bias": round_half_even(error, 2),
    }


def backtest(series: DataFrame, keys: Sequence[str] = ("Target",), min_train_idx: int = 12) -> DataFrame:
    """Rolling-origin errors of every model for quarters after ``min_train_idx``.

    A model without enough history gives a row with null metrics and a message.
    """
    rows = one_step_predictions(series, keys).where(F.col("Quarter_Idx") > min_train_idx)
    known = F.col("Forecast").isNotNull()
    message = F.when(~known, F.lit("not enough history"))
    return rows.select(
        *keys, *MODEL_KEY, F.col("Year_Quarter").alias("Validation_Quarter"),
        round_half_even("Value", 2).alias("Actual"), round_half_even("Forecast", 2).alias("Predicted"),
        *[e.alias(n) for n, e in error_columns("Value", "Forecast").items()],
        F.lit(None).cast("double").alias("AIC"), F.lit(None).cast("double").alias("BIC"),
        known.alias("Converged"), message.alias("error_message"),
    )


def backtest_summary(rows: DataFrame, keys: Sequence[str] = ("Target",)) -> DataFrame:
    """Mean errors per model; RMSE is the root of the mean squared error over folds."""
    return rows.dropna(subset=["MAPE"]).groupBy(*keys, *MODEL_KEY).agg(
        F.avg("MAE").alias("Backtest_MAE"),
        F.sqrt(F.avg(F.col("Error") * F.col("Error"))).alias("Backtest_RMSE"),
        F.avg("MAPE").alias("Backtest_MAPE"), F.avg("sMAPE").alias("Backtest_sMAPE"),
        F.avg("Bias").alias("Backtest_Bias"), F.median("MAPE").alias("Median_MAPE"),
        F.avg("AIC").alias("AIC"), F.avg("BIC").alias("BIC"),
        F.count("MAPE").alias("N_Backtests"), F.avg(F.col("Converged").cast("int")).alias("Converged_Rate"),
    )


def selected_models(summary: DataFrame, keys: Sequence[str] = ("Target",)) -> DataFrame:
    """Best model per series: lowest MAPE, then MAE, then AIC, then name."""
    best = Window.partitionBy(*keys).orderBy(
        F.col("Backtest_MAPE").asc_nulls_last(), F.col("Backtest_MAE").asc_nulls_last(),
        F.col("AIC").asc_nulls_last(), *MODEL_KEY,
    )
    return summary.withColumn("__rank", F.row_number().over(best)).where("__rank = 1").drop("__rank")


def selected_backtest(rows: DataFrame, selected: DataFrame, keys: Sequence[str] = ("Target",)) -> DataFrame:
    on = [*keys, *MODEL_KEY]
    return rows.join(selected.select(*on), on).orderBy(*keys, "Validation_Quarter")


# -- multi-step forecast -----------------------------------------------------------------------

def _power_sum(base: str, count: Column) -> Column:
    """base + base^2 + ... + base^count."""
    return F.aggregate(F.sequence(F.lit(1), count), F.lit(0.0), lambda acc, i: acc + F.pow(F.col(base), i))


def growth_path(base: Column, growth: Column, years: Column) -> Column:
    """``base`` grown ``years`` times, each step floored at zero."""
    first = F.greatest(base * growth, F.lit(0.0))
    later = F.when(growth > 0, F.pow(growth, years - 1)).otherwise(0.0)
    return first * F.when(years == 1, 1.0).otherwise(later)


def series_state(series: DataFrame, keys: Sequence[str] = ("Target",)) -> DataFrame:
    """One row per series with everything the closed-form forecasts need."""
    keys = list(keys)
    order = Window.partitionBy(*keys).orderBy("Quarter_Idx")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    df = with_differences(series, keys).withColumns(
        {
            "__g": _growth(upto), "__mean": F.avg("Value").over(upto),
            "__recent": F.avg("Value").over(order.rowsBetween(-3, 0)),
            "__phi_sd": _slope("__sd", "__sd1", upto), "__phi_cd": _slope("__cd", "__cd1", upto),
        }
    )
    newest = Window.partitionBy(*keys).orderBy(F.col("Quarter_Idx").desc())
    return df.withColumn("__rank", F.row_number().over(newest)).where("__rank = 1").select(
        *keys, F.col("Year_Quarter").alias("__label"), F.col("Quarter_Idx").alias("__last"),
        F.array("Value", "__lag1", "__lag2", "__lag3").alias("__year"),
        "__g", "__mean", "__recent", "__sd", "__cd", "__phi_sd", "__phi_cd",
    )


def horizon(state: DataFrame, periods: int) -> DataFrame:
    """The next ``periods`` quarters per series: step, label, index, quarter number."""
    steps = state.withColumn("__step", F.explode(F.sequence(F.lit(1), F.lit(periods))))
    label, quarter = shift_label("__label", F.col("__step"))
    return steps.withColumns(
        {"Quarter": label, "Quarter_Num": quarter, "Quarter_Idx": F.col("__last") + F.col("__step")}
    )


def forecast(
    series: DataFrame, selected: DataFrame, keys: Sequence[str] = ("Target",), periods: int = 7
) -> DataFrame:
    """Forecast of the selected model per series with a band of plus/minus its backtest MAPE."""
    keys = list(keys)
    state = series_state(series, keys)
    fitted = seasonal_css.fits(with_differences(series, keys), keys).join(state, keys).withColumn("__path", seasonal_css.path(periods))
    paths = fitted.select(*keys, *MODEL_KEY, "__path")
    rows = horizon(state, periods)
    seasonal = series.groupBy(*keys, "Quarter_Num").agg(F.avg("Value").alias("__seasonal"))
    rows = rows.join(seasonal, [*keys, "Quarter_Num"], "left").join(
        selected.select(*keys, *MODEL_KEY, "Backtest_MAPE"), keys
    ).join(paths, [*keys, *MODEL_KEY], "left")
    step = F.col("__step")
    years = F.ceil(step / 4).cast("int")
    base = F.element_at("__year", (years * 4 - step + 1).cast("int"))
    quarters_back = F.sequence(F.lit(0), years - 1)
    growth = F.when(base.isNotNull(), growth_path(base, F.col("__g"), years)).otherwise(
        F.when(years == 1, F.col("__recent")).otherwise(growth_path(F.col("__recent"), F.col("__g"), years - 1))
    )
    ar_seasonal = base + F.col("__sd") * F.aggregate(
        quarters_back, F.lit(0.0), lambda acc, j: acc + F.pow(F.col("__phi_sd"), step - 4 * j)
    )
    ar_combined = base + F.aggregate(
        quarters_back, F.lit(0.0),
        lambda acc, j: acc + F.col("__sd") + F.col("__cd") * _power_sum("__phi_cd", step - 4 * j),
    )
    by_model = (
        F.coalesce("__seasonal", "__mean"), growth, base + years * F.col("__sd"), ar_seasonal, ar_combined,
    )
    value = None
    for (model, order, _), expr in zip(MODELS, by_model):
        match = (F.col("Model") == model) & (F.col("Order") == order)
        value = F.when(match, expr) if value is None else value.when(match, expr)
    value = value.when(F.col("Model") == seasonal_css.MODEL, F.element_at("__path", step))
    value = F.greatest(value, F.lit(0.0))
    band = F.col("Backtest_MAPE")
    label = F.when(F.col("Order") == "", F.col("Model")).otherwise(
        F.concat("Model", "Order", F.lit("x"), "Seasonal_Order")
    )
    return rows.select(
        *keys, "Quarter", "Quarter_Idx", "Quarter_Num",
        round_half_even(value, 2).alias("Predicted"),
        round_half_even(F.greatest(value * (1 - band), F.lit(0.0)), 2).alias("CI_Lower"),
        round_half_even(value * (1 + band), 2).alias("CI_Upper"),
        label.alias("Model"), round_half_even(band, 4).alias("Band_Pct"),
    )


def wide_forecast(rows: DataFrame, targets: Sequence[str] = ("Revenue", "Profit")) -> DataFrame:
    """One row per quarter with the columns of each target side by side."""
    out = []
    for target in targets:
        names = {
            "Predicted": f"Predicted_{target}", "CI_Lower": f"{target}_CI_Lower", "CI_Upper": f"{target}_CI_Upper",
            "Model": f"{target}_Model", "Band_Pct": f"{target}_Band_Pct",
        }
        out += [F.max(F.when(F.col("Target") == target, F.col(c))).alias(n) for c, n in names.items()]
    return rows.groupBy("Quarter", "Quarter_Idx").agg(*out).orderBy("Quarter_Idx")
