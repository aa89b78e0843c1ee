"""Cleaning, enrichment and star schema on small hand-made rows."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import fixed
from tidemark.functions.numeric import cut, quantile_label, ratio, round_half_up, sigmoid
from tidemark.functions.quarters import compact_label, first_digit, quarter_end, shift_label
from tidemark.functions.text import geo_key, key_text, region_key, strip
from tidemark.operators import aggregates, sales, star
from tidemark.sources.raw import RAW_SCHEMA


def raw_row(**kw):
    row = {
        "Loyalty#": " 7 ", "First Name": "A", "Last Name": "B", "Customer Name": "A B", "Gender": "Male",
        "Education": "Master", "Marital Status": "Single", "Income": 0.0, "MonthsAsMember": 10,
        "LoyaltyStatus": "Gold", "Customer Lifetime Value": 10.0, "Country": "Canada",
        "Province or State": "New Brunswick", "City": " Big City", "Postal code": "P 1", "Latitude": 1.0,
        "Longitude": 2.0, "Location Code": "Urban", "Order Year": 2019, "Quarter": "Q1",
        "Product Line": "TV", "Coupon Response": "Coupon 3", "Count": 1, "Quantity Sold": 2.0,
        "Unit Sale Price": 50.0, "Unit Cost": 30.0, "Revenue": 100.0, "Column1": True,
    }
    row.update(kw)
    return tuple(row[f.name] for f in RAW_SCHEMA.fields)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_SCHEMA)


def one(spark, expr, **values):
    df = spark.range(1)
    for name, value in values.items():
        df = df.withColumn(name, F.lit(value))
    return df.select(expr.alias("x")).first()["x"]


def test_clean_trims_flags_and_drops(spark):
    df = sales.clean_sales(frame(spark, raw_row(), raw_row(**{"Order Year": 2020, "Income": 5.0, "Loyalty#": None})))
    assert "Column1" not in df.columns
    a, b = df.orderBy("Order Year").collect()
    assert (a["Loyalty#"], a["City"], a["Income_Flag"], a["Is_Full_Year"]) == ("7", "Big City", "No Income Reported", True)
    assert (b["Loyalty#"], b["Income_Flag"], b["Is_Full_Year"]) == (None, "Has Income", False)


def test_key_text_and_strip(spark):
    df = spark.createDataFrame([(123.0,), (1.5,), (None,)], "x double")
    got = [r[0] for r in df.select(key_text("x", df.schema["x"].dataType)).collect()]
    assert got == ["123", "1.5", None]
    assert one(spark, strip("v"), v="\t  x y \n") == "x y"


def test_metrics_with_zero_divisors(spark):
    df = sales.with_metrics(frame(spark, raw_row(Revenue=0.0, **{"Quantity Sold": 0.0, "Count": 0})))
    r = df.first()
    assert (r["Profit"], r["Profit_Margin_Pct"], r["ATV"], r["Revenue_Per_Unit"]) == (0.0, None, None, None)


@pytest.mark.parametrize("income,label", [
    (-5.0, "nan"), (-1.0, "nan"), (0.0, "No Income"), (20000.0, "<20K"), (20000.5, "20K–40K"), (100001.0, "80K+"),
    (200000.0, "nan"), (None, "nan"),
])
def test_income_bins(spark, income, label):
    df = spark.createDataFrame([(income,)], "x double")
    assert df.select(cut("x", fixed.INCOME_EDGES, fixed.INCOME_LABELS)).first()[0] == label


def test_tenure_bins_and_quantile_labels(spark):
    months = spark.createDataFrame([(0,), (36,), (72,), (73,)], "x int")
    got = [r[0] for r in months.select(cut("x", fixed.TENURE_EDGES, fixed.TENURE_LABELS)).collect()]
    assert got == ["nan", "<3 yrs", "5+ yrs", "nan"]
    values = spark.createDataFrame([(1.0,), (5.0,), (6.0,), (None,)], "x double")
    got = [r[0] for r in values.select(quantile_label("x", [5.0, 5.0, 5.0], fixed.CLV_LABELS)).collect()]
    assert got == ["Low CLV", "Low CLV", "Top CLV", "nan"]


def test_text_and_quarter_helpers(spark):
    assert one(spark, first_digit("v"), v="no digit") is None
    assert one(spark, first_digit("v"), v="Coupon 42") == 4
    region = one(spark, region_key("c", "p"), c="canada", p="New Brunswick")
    assert region == "CA_NEWB"
    assert one(spark, geo_key("r", "c", "p"), r="CA_NEWB", c="Big City", p=None) == "CA_NEWB_BigCity_nan"
    assert str(one(spark, quarter_end("y", "q"), y=2020, q=1)) == "2020-03-31"
    label, quarter = shift_label("v", F.lit(4))
    assert (one(spark, label, v="2019-Q4"), one(spark, quarter, v="2019-Q4")) == ("2020-Q4", 4)
    assert one(spark, compact_label("v"), v="2020-Q1") == "2020Q1"
    assert one(spark, round_half_up("v"), v=1.005) == 1.01
    assert one(spark, ratio("v", F.lit(0)), v=1.0) is None
    assert one(spark, sigmoid("v"), v=1000.0) == pytest.approx(1.0)


def test_coupon_rank_ties_truncate(spark):
    rows = [(c,) for c, n in (("a", 5), ("b", 5), ("c", 9), ("d", 1)) for _ in range(n)] + [(None,)]
    df = spark.createDataFrame(rows, "`Coupon Response` string")
    got = {r[0]: r[1] for r in sales.coupon_popularity(df).collect()}
    assert got == {"c": 1, "a": 2, "b": 2, "d": 4}


def test_dimensions_pick_highest_clv_and_keep_null_key(spark):
    clean = sales.clean_sales(frame(
        spark, raw_row(**{"Customer Lifetime Value": 1.0, "LoyaltyStatus": "Bronze"}),
        raw_row(**{"Customer Lifetime Value": 9.0, "LoyaltyStatus": "VIP"}),
        raw_row(**{"Customer Lifetime Value": None}), raw_row(**{"Loyalty#": None}),
    ))
    people = star.build_dim_customer(sales.enrich_sales(clean)).collect()
    assert {(r["Customer_ID"], r["LoyaltyStatus"]) for r in people} == {("7", "VIP"), (None, "Gold")}


def test_fact_ids_and_products(spark):
    clean = sales.clean_sales(frame(spark, *[raw_row(**{"Product Line": p}) for p in ("TV", "PC", "TV", None)]))
    enriched = sales.enrich_sales(clean)
    for order in (star.FACT_ORDER, None):
        fact = star.build_fact(enriched, id_order=order).collect()
        assert sorted(r["Fact_ID"] for r in fact) == [1, 2, 3, 4]
        assert {(r["Product_Line"], r["Product_ID"]) for r in fact} == {("PC", 1), ("TV", 2), (None, None)}


def test_aggregates_skip_null_keys_and_break_ties(spark):
    clean = sales.clean_sales(frame(
        spark, raw_row(**{"Product Line": "B"}), raw_row(**{"Product Line": "A"}), raw_row(**{"Product Line": None}),
    ))
    enriched = sales.enrich_rows(clean)
    assert aggregates.agg_year_product(enriched).count() == 2
    kpi = {r["Metric"]: r["Value"] for r in aggregates.agg_kpi(enriched).collect()}
    assert kpi["Top Product Line (Revenue)"] == "A"
    assert kpi["Total Revenue ($)"] == "300"
    assert aggregates.agg_loyalty(enriched).first()["Avg_Income"] is None


def test_strip_leaves_texts_between_visible_characters_alone(spark):
    texts = ["a", " a", "a\u00a0", "", " ", "!", "~", "\x7f", "\u00e9t\u00e9", "\u3000x y\t", "a b", "\x1ca", "a\u2003", None, "\u00e9 "]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", strip("t").alias("s"))
    assert [(r["t"], r["s"]) for r in df.collect()] == [(t, None if t is None else t.strip()) for t in texts]
    assert "CASE WHEN" in df._jdf.queryExecution().analyzed().toString()
