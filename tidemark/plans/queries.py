"""Registered queries: (session, table folder) -> DataFrame, each over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import CHURN_FEATURES
from ..functions.numeric import col
from ..functions.quarters import first_digit
from ..operators import (
    aggregates, churn, classifiers, forecasting, insights, metrics, quality, sales, scoring, series, star,
    violations,
)
from ..operators.scale import lookup_join
from ..session import materialize, tuned
from ..sources.sample_tables import sales_raw
from . import marts

PARTIAL_YEARS = (2001,)
Query = Callable[[SparkSession, str], DataFrame]

def clean(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return sales.clean_sales(sales_raw(tuned(spark), sf_dir, columns or None), PARTIAL_YEARS)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.enrich_sales(clean(spark, sf_dir))


def rounded(df: DataFrame, digits: int = 4, **special: int) -> DataFrame:
    """Round doubles so that results do not depend on the order of summation."""
    doubles = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(F.col(f"`{c}`"), special.get(c, digits)) for c in doubles})


def snake(df: DataFrame) -> DataFrame:
    """Curated names for raw-named columns."""
    names = {**star.CUSTOMER_COLUMNS, **star.GEOGRAPHY_COLUMNS, **star.FACT_COLUMNS}
    return df.select(*[col(f"`{c}`").alias(names.get(c, c)) for c in df.columns])


# -- cleaning and enrichment -------------------------------------------------------------------

CUSTOMER = ("Loyalty#", "First Name", "Last Name", "Customer Name", "Gender", "Education", "Marital Status",
            "Income", "MonthsAsMember", "LoyaltyStatus", "Customer Lifetime Value")
PLACE = ("Country", "Province or State", "City", "Postal code", "Latitude", "Longitude", "Location Code")
TIME = ("Order Year", "Quarter")
MEASURES = ("Count", "Quantity Sold", "Unit Sale Price", "Unit Cost", "Revenue")


def rows(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Row-wise enriched sales restricted to what the query reads."""
    return sales.enrich_rows(clean(spark, sf_dir, *columns))


def clean_sales(spark, d):
    return snake(clean(spark, d))


def enrich_sales(spark, d):
    return snake(enriched(spark, d))


def sales_metrics(spark, d):
    out = ["Total_Cost", "Profit", "Profit_Margin_Pct", "ATV", "Revenue_Per_Unit", "Gross_Contribution"]
    return snake(rows(spark, d, "Loyalty#", *MEASURES)).select("Customer_ID", "Revenue", *out)


def income_bucket(spark, d):
    df = rows(spark, d, "Income")
    return df.groupBy("Income", "Income_Flag", "Income_Bucket").agg(F.count("*").alias("rows_"))


def tenure_bucket(spark, d):
    df = rows(spark, d, "MonthsAsMember").withColumnRenamed("MonthsAsMember", "Months_As_Member")
    return df.groupBy("Months_As_Member", "Tenure_Bucket").agg(F.count("*").alias("rows_"))


def clv_segment(spark, d):
    df = sales.with_clv_segment(clean(spark, d, "Loyalty#", "Customer Lifetime Value"))
    return snake(df).groupBy("Customer_ID", "CLV", "CLV_Segment").agg(F.count("*").alias("rows_"))


def coupon_rank(spark, d):
    return snake(sales.coupon_popularity(clean(spark, d, "Coupon Response")))


def geo_keys(spark, d):
    return rows(spark, d, *PLACE).groupBy("Region_Key", "Geo_Key").agg(F.count("*").alias("rows_"))


def accepted_quarter_except(spark, d):
    """Quarter labels outside a list that lacks Q4 (set difference of values)."""
    return quality.unaccepted_values(rows(spark, d, *TIME), "Quarter", ["Q1", "Q2", "Q3"])


# -- star schema -------------------------------------------------------------------------------

def dim_date(spark, d):
    return star.build_dim_date(rows(spark, d, *TIME))


def dim_product(spark, d):
    return rounded(star.build_dim_product(rows(spark, d, "Product Line", *MEASURES)))


def dim_geography(spark, d):
    return star.build_dim_geography(rows(spark, d, *PLACE))


def dim_customer(spark, d):
    return star.build_dim_customer(sales.with_clv_segment(rows(spark, d, *CUSTOMER)))


def fact_sales(spark, d):
    return star.build_fact(enriched(spark, d))


def partition_columns(spark, d):
    """Row counts of the curated layout: fact by year, customers by tier, places by country."""
    parts = [
        ("fact_sales", star.with_partition_column(rows(spark, d, *TIME), "Order Year", "partition_value")),
        ("dim_customer", star.with_partition_column(
            rows(spark, d, "Loyalty#", "LoyaltyStatus").distinct(), "LoyaltyStatus", "partition_value")),
        ("dim_geography", star.with_partition_column(
            star.project(rows(spark, d, *PLACE), star.GEOGRAPHY_COLUMNS).select("Geo_Key", "Country").distinct(),
            "Country", "partition_value")),
    ]
    out = None
    for name, df in parts:
        one = df.groupBy("partition_value").agg(F.count("*").alias("row_count")).withColumn("table_name", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


# -- aggregates --------------------------------------------------------------------------------

_AGG_INPUTS = {
    "agg_year_product": ("Order Year", "Product Line"),
    "agg_country_year": ("Country", "Order Year"),
    "agg_edu_product": ("Education", "Product Line"),
    "agg_gender_product": ("Gender", "Product Line"),
    "agg_loyalty": ("LoyaltyStatus", "Income", "MonthsAsMember"),
    "agg_coupon": ("Coupon Response",),
    "agg_kpi": ("Product Line", "Country", "LoyaltyStatus"),
}


def _aggregate(name: str) -> Query:
    def run(spark, d):
        columns = dict.fromkeys((*_AGG_INPUTS[name], "Loyalty#", "Customer Lifetime Value", *MEASURES))
        df = getattr(aggregates, name)(rows(spark, d, *columns))
        if name == "agg_kpi":
            return df.withColumn("Numeric_Value", F.round("Numeric_Value", 2))
        return rounded(df.withColumnsRenamed({"Order Year": "Year", "Product Line": "Product_Line",
                                              "Coupon Response": "Coupon_Response"}))
    run.__name__ = name
    return run


# -- marts and validations ---------------------------------------------------------------------

def _fact(spark, d, *columns):
    """Curated fact columns derived from the given raw columns."""
    return star.fact_columns(rows(spark, d, *dict.fromkeys(columns)))


def _tables(spark, d, text: str) -> dict[str, DataFrame]:
    """Only the tables a text (and the marts under it) reads, with the columns they read."""
    needed, todo = set(), list(marts.names_in(text))
    while todo:
        name = todo.pop()
        needed.add(name)
        todo += marts.names_in(marts.MARTS.get(name, ""))
    out = {}
    if "fact_sales" in needed:
        columns = ["Loyalty#", *TIME, *MEASURES]
        columns += ["LoyaltyStatus"] if "sales_by_loyalty" in needed else []
        fact = _fact(spark, d, *columns, *(["Product Line"] if "dim_product" in needed else []))
        out["fact_sales"] = star.with_partition_column(fact, "Year", "partition_year")
    if "dim_customer" in needed:
        out["dim_customer"] = dim_customer(spark, d)
    if "dim_product" in needed:
        ids = star.product_ids(rows(spark, d, "Product Line"))
        out["dim_product"] = ids
        out["fact_sales"] = lookup_join(out["fact_sales"], ids, "Product_Line")
    if "dim_date" in needed:
        out["dim_date"] = dim_date(spark, d)
    if "dim_geography" in needed:
        out["dim_geography"] = dim_geography(spark, d)
    return out


def _mart(name: str) -> Query:
    return lambda spark, d: marts.mart(spark, name, _tables(spark, d, "{" + name + "}"))


def _validation(name: str) -> Query:
    return lambda spark, d: marts.validation(spark, name, _tables(spark, d, marts.VALIDATIONS[name]))


# -- quality -----------------------------------------------------------------------------------

def dq_report(spark, d):
    """All checks of the gate over a star schema built from rows that are written once."""
    df = materialize(rows(spark, d, *dict.fromkeys((*PLACE, "Loyalty#", *TIME, *MEASURES, "Product Line"))), "gate")
    return quality.quality_report(
        {
            "FACT_Sales": star.build_fact(df, star.product_ids(df), id_order=None),
            "DIM_Customer": df.select(F.col("Loyalty#").alias("Customer_ID")).distinct(),
            "DIM_Product": star.product_ids(df),
            "DIM_Date": star.build_dim_date(df),
            "DIM_Geography": df.select("Geo_Key").distinct(),
        },
        partial_year=2001, recent_year=2001,
    )


#: Number of a stored row.
STORED = "Stored_Row"


def _defective_tables(spark, d) -> dict[str, DataFrame]:
    """The star schema with defects of every kind, chosen by remainders of the customer number.

    The rows are written once, with a number; the defects are expressions over them.
    """
    df = rows(spark, d, *dict.fromkeys((*PLACE, "Loyalty#", *TIME, *MEASURES, "Product Line")))
    df = materialize(df.withColumn(STORED, F.monotonically_increasing_id()), "gate")
    n = F.col("Customer_ID").cast("bigint")
    at = lambda k, r: n % k == r
    products = star.product_ids(df)
    fact = lookup_join(star.fact_columns(df, STORED), products, "Product_Line").withColumns({
        "Fact_ID": n * 10_000 + F.col("Year"),
        "Quarter": F.when(at(73, 5), "Q9").otherwise(F.col("Quarter")),
        "Revenue": F.when(at(71, 6), -F.col("Revenue")).otherwise(F.col("Revenue")),
        "Profit": F.when(at(67, 7), F.lit(-1.5)).otherwise(F.abs("Profit")),
        "Is_Full_Year": F.col("Is_Full_Year") | at(61, 8),
        "Product_ID": F.when(~at(89, 1), F.col("Product_ID")), "Date_Key": F.when(~at(83, 2), F.col("Date_Key")),
        "Customer_ID": F.when(~at(97, 0), F.col("Customer_ID")),
    })
    customers = df.select(F.col("Loyalty#").alias("Customer_ID")).distinct()
    number = F.col("Customer_ID").cast("bigint")
    dates = star.build_dim_date(df)
    return {
        "FACT_Sales": fact,
        "DIM_Customer": customers.where(number % 7 != 3).unionByName(customers.where(number % 11 == 4)),
        "DIM_Product": products.where("Product_ID % 5 <> 0"),
        "DIM_Date": dates.where(~F.col("Date_Key").cast("string").endswith("02")),
        "DIM_Geography": df.select("Geo_Key").distinct().where(F.length("Geo_Key") % 4 != 0),
    }


def dq_report_defects(spark, d):
    """The gate over tables in which every kind of defect occurs."""
    tables = _defective_tables(spark, d)
    entries = materialize(violations.ledger(tables, STORED).select(*violations.REPORTED), "ledger")
    return violations.report(entries, tables, partial_year=2001, recent_year=2002)


def dq_violation_masks(spark, d):
    """Rows of the defective tables per combination of failed checks (repeats aside: which copy is first is not in the data)."""
    repeats = violations.BITS["fact_sales_unique_fact_id"] | violations.WARNINGS
    return violations.mask_counts(violations.ledger(_defective_tables(spark, d), STORED), repeats)


def model_input_report(spark, d):
    columns = ("Loyalty#", *TIME, *MEASURES, "Product Line", "Coupon Response")
    fact = star.project(rows(spark, d, *columns), {
        s: t for s, t in star.FACT_COLUMNS.items() if s in columns or s in ("Profit", "Year_Quarter", "Quarter_Num")
    }).withColumn("Coupon_Num", first_digit("Coupon_Response"))
    return quality.model_input_report(fact, dim_customer(spark, d))


def model_input_defects(spark, d):
    """The model-input report over tables with nulls, negative amounts, orphans and repeated customers, by remainders."""
    columns = ("Loyalty#", *TIME, *MEASURES, "Product Line", "Coupon Response")
    n = F.col("Customer_ID").cast("bigint")
    fact = star.project(rows(spark, d, *columns), {
        s: t for s, t in star.FACT_COLUMNS.items() if s in columns or s in ("Profit", "Year_Quarter", "Quarter_Num")
    }).withColumn("Coupon_Num", first_digit("Coupon_Response")).withColumns({
        "Product_Line": F.when(n % 13 != 1, F.col("Product_Line")), "Coupon_Num": F.when(n % 17 != 2, F.col("Coupon_Num")),
        "Revenue": F.when(n % 71 == 6, -F.col("Revenue")).otherwise(F.col("Revenue")),
        "Profit": F.when(n % 67 == 7, F.lit(-1.5)).otherwise(F.abs("Profit")),
    })
    people = _people(spark, d)
    known = people.where(n % 7 != 3).unionByName(people.where(n % 11 == 4))
    return quality.model_input_report(fact, known.withColumns({
        "Income": F.when(n % 19 != 4, F.col("Income")), "Gender": F.when(n % 23 != 5, F.col("Gender"))}))


# -- series and forecasting --------------------------------------------------------------------

def _quarterly(spark, d) -> DataFrame:
    return rounded(series.quarterly_series(_fact(spark, d, *TIME, *MEASURES)))


def _long(spark, d) -> DataFrame:
    # Written once: a few rows, which folds, fits and forecasts read many times.
    return materialize(series.long_series(_quarterly(spark, d)), "quarterly-series")


def quarter_index(spark, d):
    return series.quarter_calendar(_fact(spark, d, *TIME))


def quarterly_series(spark, d):
    return _quarterly(spark, d)


def product_quarterly_series(spark, d):
    """One series per product line from the same plan."""
    return rounded(series.quarterly_series(_fact(spark, d, *TIME, *MEASURES, "Product Line"), keys=["Product_Line"]))


def forecast_features(spark, d):
    return rounded(series.forecast_features(_long(spark, d)), 2, yoy_growth=8, q_sin=8, q_cos=8)


def next_forecast_row(spark, d):
    return rounded(series.next_forecast_row(_long(spark, d)), 2, yoy_growth=8, q_sin=8, q_cos=8)


def series_transforms(spark, d):
    return rounded(series.series_transforms(_long(spark, d)), 6)


def unit_root_stat(spark, d):
    return rounded(series.stationarity_diagnostics(_long(spark, d)), 6)


def unit_root_lags(spark, d):
    return rounded(series.lagged_unit_root(_long(spark, d)), 5)


def seasonal_profile(spark, d):
    return rounded(series.seasonal_profile(_long(spark, d)), 4, Seasonal_Index=8)


def last_and_trailing_mean(spark, d):
    return rounded(metrics.trailing_mean_and_last(_long(spark, d), ["Target"], "Quarter_Idx", "Value"))


def _backtest(model: str | None = None) -> Query:
    def run(spark, d):
        out = forecasting.backtest(_long(spark, d))
        return out if model is None else out.where(F.col("Model") == model)
    return run


def backtest_summary(spark, d):
    return rounded(forecasting.backtest_summary(forecasting.backtest(_long(spark, d))), 4,
                   Backtest_MAPE=8, Backtest_sMAPE=8, Median_MAPE=8)


def selected_model(spark, d):
    summary = forecasting.backtest_summary(forecasting.backtest(_long(spark, d)))
    return forecasting.selected_models(summary).select("Target", *forecasting.MODEL_KEY)


def selected_backtest(spark, d):
    runs = forecasting.backtest(_long(spark, d))
    return forecasting.selected_backtest(runs, forecasting.selected_models(forecasting.backtest_summary(runs)))


def forecast_horizon(spark, d):
    """Seven quarters of the selected model, both targets side by side."""
    long = _long(spark, d)
    selected = forecasting.selected_models(forecasting.backtest_summary(forecasting.backtest(long)))
    return forecasting.wide_forecast(forecasting.forecast(long, selected))


def forecast_all_models(spark, d):
    """Seven quarters of every model, as if each had been selected."""
    long = _long(spark, d)
    return forecasting.forecast(long, forecasting.backtest_summary(forecasting.backtest(long)))


# -- churn -------------------------------------------------------------------------------------

CHURN_INPUTS = ("Loyalty#", *TIME, *MEASURES, "Product Line", "Coupon Response")
SNAPSHOT = 20


def _churn_fact(spark, d) -> DataFrame:
    fact = _fact(spark, d, *CHURN_INPUTS)
    return fact.withColumn("Coupon_Num", first_digit("Coupon_Response"))


def _people(spark, d) -> DataFrame:
    """Customer dimension, written once because features and medians read it more than once."""
    return materialize(dim_customer(spark, d), "customers")


def churn_snapshot(spark, d):
    return churn.churn_features(_churn_fact(spark, d), _people(spark, d), [SNAPSHOT])


def churn_training_windows(spark, d):
    return churn.training_windows(_churn_fact(spark, d), _people(spark, d))


def churn_scoring_snapshot(spark, d):
    return churn.scoring_snapshot(_churn_fact(spark, d), _people(spark, d))


def _labels(spark, d) -> DataFrame:
    """Label of every customer and training snapshot."""
    fact = _fact(spark, d, *CHURN_INPUTS).withColumn("Coupon_Num", F.lit(1))
    calendar = series.quarter_calendar(fact)
    snapshots = churn.training_snapshots(churn.last_quarter(calendar))
    labels = churn.history_features(fact, snapshots, calendar=calendar)
    return labels.select("Customer_ID", "Snapshot_Idx", churn.LABEL)


def _given_score(factor: int):
    """A score that needs no trained model: a fixed function of the customer key."""
    return ((F.col("Customer_ID").cast("bigint") * factor) % 1000) / F.lit(1000.0)


def _scored_labels(spark, d) -> DataFrame:
    return _labels(spark, d).withColumn("score", _given_score(37))


def churn_label_rate(spark, d):
    return rounded(_labels(spark, d).groupBy("Snapshot_Idx").agg(
        F.count("*").alias("rows_"), F.avg(churn.LABEL).alias("churn_rate")), 10)


def validation_folds(spark, d):
    return metrics.validation_snapshots(_labels(spark, d))


def binary_metrics(spark, d):
    return rounded(metrics.binary_metrics(_scored_labels(spark, d), churn.LABEL, "score", 0.5, ["Snapshot_Idx"]), 10)


def confusion_matrix(spark, d):
    return metrics.confusion_matrix(metrics.binary_metrics(_scored_labels(spark, d), churn.LABEL, "score", 0.5))


def auc(spark, d):
    return rounded(metrics.auc(_scored_labels(spark, d), churn.LABEL, "score", ["Snapshot_Idx"]), 10)


def lift_at_10(spark, d):
    return rounded(metrics.lift_at_k(_scored_labels(spark, d), churn.LABEL, "score", 0.10, ["Snapshot_Idx"]), 10)


def best_threshold(spark, d):
    return rounded(metrics.best_threshold(_scored_labels(spark, d), churn.LABEL, "score"), 10)


def model_ranking(spark, d):
    """Two given scores compared over the last four snapshots."""
    labels = _labels(spark, d)
    recent = metrics.validation_snapshots(labels)
    both = lookup_join(labels, recent, "Snapshot_Idx", "inner").withColumn("parts", F.array(
        F.struct(F.lit("score_37").alias("Model"), _given_score(37).alias("score")),
        F.struct(F.lit("score_91").alias("Model"), _given_score(91).alias("score")),
    )).select("Snapshot_Idx", churn.LABEL, F.inline("parts"))
    by = ["Model", "Snapshot_Idx"]
    ladder = metrics.score_ladder(both, churn.LABEL, "score", by)
    folds = (
        metrics.binary_metrics(both, churn.LABEL, "score", 0.25, by)
        .join(metrics.auc_from_ladder(ladder, by), by).join(metrics.lift_from_ladder(ladder, 0.10, by), by)
        .withColumnRenamed("Snapshot_Idx", "Validation_Snapshot")
    )
    return rounded(metrics.model_ranking(folds), 10)


def standardizer_stats(spark, d):
    features = churn.churn_features(_churn_fact(spark, d), _people(spark, d), [SNAPSHOT])
    return rounded(metrics.standardizer_stats(features, CHURN_FEATURES), 4)


# -- scoring -----------------------------------------------------------------------------------

THRESHOLD = 0.5


def _scored(spark, d) -> DataFrame:
    # Written once: the ranking reads it again for the median.
    features = materialize(churn.scoring_snapshot(_churn_fact(spark, d), _people(spark, d)), "scoring-snapshot")
    return scoring.score_customers(features.withColumn("score", _given_score(37)), THRESHOLD, "score")


def scored_customers(spark, d):
    return rounded(_scored(spark, d), 4, Retention_Priority_Score=8)


def high_risk_list(spark, d):
    return scoring.high_risk(_scored(spark, d)).select("Customer_ID", "Churn_Risk_Segment", "Action_Owner")


def head_5000(spark, d):
    return scoring.head_of_list(_scored(spark, d), 5000).select("Customer_ID", "Predicted_Churn")


def top_n_at_risk(spark, d):
    return rounded(scoring.top_at_risk(_scored(spark, d), 1000), 2)


def fixed_segment(spark, d):
    df = churn.history_features(_churn_fact(spark, d), [SNAPSHOT], scoring_only=True)
    df = df.withColumn(scoring.PROBABILITY, _given_score(37))
    return df.select("Customer_ID", "Recency", scoring.fixed_segment().alias("Churn_Risk_Segment"))


# -- trained models (no SQL twin) --------------------------------------------------------------

def _windows(spark, d) -> DataFrame:
    return materialize(churn.training_windows(_churn_fact(spark, d), _people(spark, d)), "churn-windows")


def _over_folds(*names: str) -> Query:
    """Fold rows of candidates over the last four snapshots."""
    chosen = [c for c in classifiers.CANDIDATES if c.name in names]
    return lambda spark, d: classifiers.compare_models(_windows(spark, d), chosen)[1]


def _trained_result(spark, d) -> classifiers.ChurnResult:
    fact, people = _churn_fact(spark, d), _people(spark, d)
    return classifiers.train_and_score(churn.training_windows(fact, people), churn.scoring_snapshot(fact, people))


def feature_importance(spark, d):
    """Importance of the champion of all five candidates, whichever kind it is."""
    return _trained_result(spark, d).importance


def churn_pipeline(spark, d):
    """Five candidates compared over four folds, the champion's newest model, newest customers ranked."""
    result = _trained_result(spark, d)
    return scoring.score_customers(result.scored, result.threshold)


def churn_root_split(spark, d):
    """Best split of every feature at the root of the boosted candidates, over all rows before the newest snapshot."""
    windows = _windows(spark, d)
    newest = windows.agg(F.max("Snapshot_Idx")).first()[0]
    out = None
    for c in classifiers.CANDIDATES:
        if c.kind == "boosted":
            one = classifiers.root_splits(windows, newest, c).withColumn("Model", F.lit(c.name))
            out = one if out is None else out.unionByName(one)
    return rounded(out, 6)


def churn_logistic_solution(spark, d):
    """Coefficients of the logistic candidates before the newest snapshot, and the gradient that is left there."""
    windows = _windows(spark, d)
    newest = windows.agg(F.max("Snapshot_Idx")).first()[0]
    chosen = [c for c in classifiers.CANDIDATES if c.kind == "logistic"]
    models = classifiers.fit_all(windows, [(newest, c) for c in chosen])
    rows = [
        (c.name, f, float(w), abs(float(g))) for c, m in zip(chosen, models)
        for f, w, g in zip(("intercept", *m.features), (m.intercept, *m.coefficients), m.gradient)
    ]
    return rounded(spark.createDataFrame(rows, "Model string, Feature string, Coefficient double, Gradient double"), 5)


def ridge(spark, d):
    """Next-quarter style regression of revenue on its lag features over product series."""
    # Written once: a few rows, which the deviation, the size check and the fit read again.
    long = materialize(series.long_series(series.quarterly_series(
        _fact(spark, d, *TIME, *MEASURES, "Product Line"), keys=["Product_Line"])), "product-series")
    data = series.forecast_features(long, ["Product_Line", "Target"]).dropna(subset=["lag5", "yoy_growth", "roll4_mean"])
    names = ["lag1", "lag4", "lag5", "roll4_mean", "roll4_std", "yoy_growth", "trend", "trend_sq", "q_sin", "q_cos",
             "is_q4", "is_q1"]
    model = classifiers.ridge(data, names, "Value")
    return spark.createDataFrame(
        [(n, float(c)) for n, c in zip(["intercept", *names], [model.intercept, *model.coefficients])],
        "Feature string, Coefficient double",
    )


# -- insights ----------------------------------------------------------------------------------

def yoy_drivers(spark, d):
    return rounded(insights.yoy_drivers(_fact(spark, d, "Loyalty#", *TIME, *MEASURES)), 4, AOV=6, Prior_AOV=6)


def price_quantity_split(spark, d):
    return rounded(insights.price_quantity_split(_fact(spark, d, *TIME, *MEASURES, "Product Line"), ["Product_Line"]), 6)


def yoy_by_country(spark, d):
    df = rows(spark, d, "Loyalty#", *TIME, *MEASURES, "Country")
    fact = star.project(df, {**{s: t for s, t in star.FACT_COLUMNS.items() if s in df.columns}, "Country": "Country"})
    return rounded(insights.yoy_by(fact, "Country"))


def yoy_by_product(spark, d):
    return rounded(insights.yoy_by(_fact(spark, d, "Loyalty#", *TIME, *MEASURES, "Product Line"), "Product_Line"))


def mix_shift(spark, d):
    return rounded(insights.mix_shift(_fact(spark, d, *TIME, *MEASURES, "Product Line"), "Product_Line"), 4,
                   Revenue_Share_Pct=8, Share_Shift_Points=8)


def revenue_share(spark, d):
    fact = _fact(spark, d, "Loyalty#", *TIME, *MEASURES, "LoyaltyStatus")
    return rounded(insights.revenue_share(fact, "LoyaltyStatus"), 4)


def new_vs_returning(spark, d):
    return rounded(insights.new_vs_returning(_fact(spark, d, "Loyalty#", *TIME, *MEASURES)))


def top_n_concentration(spark, d):
    return rounded(insights.top_n_concentration(_fact(spark, d, *TIME, "Revenue")), 4, Top_Share_Pct=8)


def product_by_quarter(spark, d):
    fact = _fact(spark, d, *TIME, *MEASURES, "Product Line")
    return rounded(insights.dashboard_extract(fact, ["Product_Line", "Year_Quarter"]), 4, Avg_Unit_Price=6, AOV=6)


def loyalty_by_quarter(spark, d):
    fact = _fact(spark, d, *TIME, *MEASURES, "LoyaltyStatus")
    return rounded(insights.dashboard_extract(fact, ["LoyaltyStatus", "Year_Quarter"]), 4)


def sales_by_year(spark, d):
    return rounded(insights.dashboard_extract(_fact(spark, d, *TIME, *MEASURES), ["Year"]), 4, Avg_Unit_Price=6, AOV=6)


def product_quarter_pivot(spark, d):
    fact = _fact(spark, d, *TIME, *MEASURES, "Product Line")
    return rounded(insights.revenue_pivot(fact, "Product_Line", "Quarter", ["Q1", "Q2", "Q3", "Q4"]))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        clean_sales, enrich_sales, sales_metrics, income_bucket, tenure_bucket, clv_segment, coupon_rank, geo_keys,
        accepted_quarter_except, dim_date, dim_product, dim_geography, dim_customer, fact_sales, partition_columns,
        dq_report, dq_report_defects, dq_violation_masks, model_input_report, model_input_defects, quarter_index, quarterly_series, product_quarterly_series, forecast_features,
        next_forecast_row, series_transforms, unit_root_stat, unit_root_lags, seasonal_profile, last_and_trailing_mean,
        backtest_summary, selected_model, selected_backtest, forecast_horizon, forecast_all_models, churn_snapshot,
        churn_training_windows, churn_scoring_snapshot, churn_label_rate, validation_folds, binary_metrics,
        confusion_matrix, auc, lift_at_10, best_threshold, model_ranking, standardizer_stats, scored_customers,
        high_risk_list, head_5000, top_n_at_risk, fixed_segment, feature_importance, churn_pipeline, churn_root_split, churn_logistic_solution, ridge,
        yoy_drivers, price_quantity_split, yoy_by_country, yoy_by_product, mix_shift, revenue_share, new_vs_returning,
        top_n_concentration, product_by_quarter, loyalty_by_quarter, sales_by_year, product_quarter_pivot,
    )
}
QUERIES.update({name: _aggregate(name) for name in _AGG_INPUTS})
QUERIES.update({name: _mart(name) for name in marts.MARTS})
QUERIES.update({name: _validation(name) for name in marts.VALIDATIONS})
QUERIES.update({
    "seasonal_naive_backtest": _backtest("SeasonalNaive"),
    "seasonal_growth_backtest": _backtest("SeasonalGrowth"),
    "seasonal_rw_backtest": _backtest("SeasonalRandomWalk"),
    "seasonal_ar1_backtest": _backtest("SeasonalAR1_CLS"),
    "seasonal_css_backtest": _backtest("SeasonalCSS"),
    "churn_logistic": _over_folds("Logistic_Balanced", "Logistic_StrongL2", "Logistic_Unweighted"),
    "churn_gbt": _over_folds("GBT_Balanced", "GBT_Regularized"),
})
