"""Clean and enrich wide sales rows."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..functions.numeric import col, cut, pct, quantile_label, rank_in, ratio, round_half_even
from ..functions.quarters import date_key, first_digit, year_quarter
from ..functions.text import geo_key, key_text, region_key, strip
from .scale import exact_quantiles, lookup_join

PARTIAL_YEARS = (2020,)


# -- cleaning ----------------------------------------------------------------------------------

def trim_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def trim_strings(df: DataFrame) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: strip(F.col(f"`{c}`")) for c in texts})


def normalize_key(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, key_text(F.col(f"`{name}`"), df.schema[name].dataType))


def flag_income(df: DataFrame) -> DataFrame:
    flag = F.when(F.col("Income") == 0, fixed.NO_INCOME).otherwise(fixed.HAS_INCOME)
    return df.withColumn("Income_Flag", flag)


def flag_full_year(df: DataFrame, partial_years: Collection[int] = PARTIAL_YEARS) -> DataFrame:
    partial = F.coalesce(F.col("Order Year").isin(*partial_years), F.lit(False))
    return df.withColumn("Is_Full_Year", ~partial)


def clean_sales(raw: DataFrame, partial_years: Collection[int] = PARTIAL_YEARS) -> DataFrame:
    """Drop the filler column, trim names and texts, normalise the customer key, flag rows."""
    df = trim_strings(trim_names(raw.drop("Column1")))
    if "Loyalty#" in df.columns:
        df = normalize_key(df, "Loyalty#")
    if "Income" in df.columns:
        df = flag_income(df)
    if "Order Year" in df.columns:
        df = flag_full_year(df, partial_years)
    return df


# -- enrichment --------------------------------------------------------------------------------

def with_metrics(df: DataFrame) -> DataFrame:
    cost = F.col("Unit Cost") * F.col("Quantity Sold")
    profit = F.col("Revenue") - cost
    return df.withColumns(
        {
            "Total_Cost": cost,
            "Profit": profit,
            "Profit_Margin_Pct": round_half_even(pct(profit, "Revenue"), 4),
            "ATV": round_half_even(ratio("Revenue", "Count"), 2),
            "Revenue_Per_Unit": round_half_even(ratio("Revenue", "Quantity Sold"), 2),
            "Gross_Contribution": profit,
        }
    )


def with_quarter_keys(df: DataFrame) -> DataFrame:
    df = df.withColumns(
        {"Year_Quarter": year_quarter("Order Year", "Quarter"), "Quarter_Num": first_digit("Quarter")}
    )
    return df.withColumn("Date_Key", date_key("Order Year", "Quarter_Num"))


def with_ranks(df: DataFrame) -> DataFrame:
    ranks = {
        "Loyalty_Rank": ("LoyaltyStatus", fixed.LOYALTY_TIERS),
        "Education_Rank": ("Education", fixed.EDUCATION_LEVELS),
    }
    return df.withColumns({out: rank_in(c, values) for out, (c, values) in ranks.items() if c in df.columns})


def with_income_bucket(df: DataFrame) -> DataFrame:
    return df.withColumn("Income_Bucket", cut("Income", fixed.INCOME_EDGES, fixed.INCOME_LABELS))


def with_tenure_bucket(df: DataFrame) -> DataFrame:
    return df.withColumn("Tenure_Bucket", cut("MonthsAsMember", fixed.TENURE_EDGES, fixed.TENURE_LABELS))


def clv_edges(df: DataFrame) -> list[float | None]:
    """Quartile edges over transactions, so frequent buyers weigh more."""
    return exact_quantiles(df, "Customer Lifetime Value", [0.25, 0.5, 0.75])


def with_clv_segment(df: DataFrame, edges: Sequence[float | None] | None = None) -> DataFrame:
    """Label CLV quartiles; pass ``edges`` to reuse quartiles that are already known."""
    edges = clv_edges(df) if edges is None else edges
    if None in edges:
        return df.withColumn("CLV_Segment", F.lit(fixed.OUT_OF_RANGE))
    return df.withColumn("CLV_Segment", quantile_label("Customer Lifetime Value", edges, fixed.CLV_LABELS))


def coupon_popularity(df: DataFrame, coupon: str = "Coupon Response") -> DataFrame:
    """Rank per coupon by use, most used first; ties share the truncated average rank."""
    uses = df.where(col(f"`{coupon}`").isNotNull()).groupBy(coupon).agg(F.count("*").alias("uses"))
    # Distinct use counts number at most sqrt(2 * rows), so this window stays small.
    ahead = Window.orderBy(F.col("uses").desc()).rowsBetween(Window.unboundedPreceding, -1)
    levels = uses.groupBy("uses").agg(F.count("*").alias("ties")).withColumn(
        "ahead", F.coalesce(F.sum("ties").over(ahead), F.lit(0))
    )
    rank = F.floor(F.col("ahead") + (F.col("ties") + 1) / 2).cast("int")
    return uses.join(levels, "uses").select(coupon, rank.alias("Coupon_Popularity_Rank"))


def with_coupons(df: DataFrame, popularity: DataFrame | None = None) -> DataFrame:
    ranks = coupon_popularity(df) if popularity is None else popularity
    return lookup_join(df.withColumn("Coupon_Num", first_digit("Coupon Response")), ranks, "Coupon Response")


def with_geography(df: DataFrame) -> DataFrame:
    region = region_key("Country", F.col("Province or State"))
    return df.withColumn("Region_Key", region).withColumn(
        "Geo_Key", geo_key("Region_Key", "City", F.col("Postal code"))
    )


def enrich_rows(clean: DataFrame) -> DataFrame:
    """Row-wise enrichment: every derived column whose inputs are present and need no global value."""
    steps = [
        ({"Revenue", "Unit Cost", "Quantity Sold", "Count"}, with_metrics),
        ({"Order Year", "Quarter"}, with_quarter_keys),
        (set(), with_ranks),
        ({"Income"}, with_income_bucket),
        ({"MonthsAsMember"}, with_tenure_bucket),
        ({"Country", "Province or State", "City", "Postal code"}, with_geography),
    ]
    for inputs, step in steps:
        if inputs <= set(clean.columns):
            clean = step(clean)
    return clean


def enrich_sales(
    clean: DataFrame, edges: Sequence[float | None] | None = None, popularity: DataFrame | None = None
) -> DataFrame:
    """All derived columns. The two global inputs (CLV edges, coupon ranks) are measured if not given."""
    df = with_clv_segment(enrich_rows(clean), clv_edges(clean) if edges is None else edges)
    return with_coupons(df, coupon_popularity(clean) if popularity is None else popularity)
