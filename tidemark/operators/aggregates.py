"""The seven published aggregate tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.numeric import pct, rank_in, ratio, round_half_even
from .scale import attach_row, with_share


def grouped_sales(enriched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums, mean CLV and distinct customers per key; rows with a null key are left out."""
    return enriched.dropna(subset=list(keys)).groupBy(*keys).agg(
        F.sum("Revenue").alias("Total_Revenue"),
        F.sum("Profit").alias("Total_Profit"),
        F.sum("Count").alias("Total_Orders"),
        F.sum("Quantity Sold").alias("Total_Qty"),
        F.avg("Customer Lifetime Value").alias("Avg_CLV"),
        F.countDistinct("Loyalty#").alias("Unique_Customers"),
    )


def _with_margin(df: DataFrame) -> DataFrame:
    return df.withColumn("Profit_Margin_Pct", round_half_even(pct("Total_Profit", "Total_Revenue"), 2))


def agg_year_product(enriched: DataFrame) -> DataFrame:
    return _with_margin(grouped_sales(enriched, ["Order Year", "Product Line"]))


def agg_country_year(enriched: DataFrame) -> DataFrame:
    return _with_margin(grouped_sales(enriched, ["Country", "Order Year"]))


def agg_edu_product(enriched: DataFrame) -> DataFrame:
    rows = grouped_sales(enriched, ["Education", "Product Line"])
    return rows.withColumn("Education_Rank", rank_in("Education", fixed.EDUCATION_LEVELS)).orderBy(
        "Education_Rank", "Product Line"
    )


def agg_gender_product(enriched: DataFrame) -> DataFrame:
    return grouped_sales(enriched, ["Gender", "Product Line"])


def agg_loyalty(enriched: DataFrame) -> DataFrame:
    """Tier profile; mean income ignores customers without income."""
    tiers = enriched.dropna(subset=["LoyaltyStatus"]).groupBy("LoyaltyStatus").agg(
        F.countDistinct("Loyalty#").alias("Customer_Count"),
        F.sum("Revenue").alias("Total_Revenue"),
        F.sum("Profit").alias("Total_Profit"),
        round_half_even(F.avg("Revenue"), 2).alias("Avg_Revenue"),
        round_half_even(F.avg("Customer Lifetime Value"), 2).alias("Avg_CLV"),
        round_half_even(F.avg(F.when(F.col("Income") > 0, F.col("Income"))), 2).alias("Avg_Income"),
        round_half_even(F.avg("MonthsAsMember"), 1).alias("Avg_Months"),
    )
    tiers = tiers.withColumn("Loyalty_Rank", rank_in("LoyaltyStatus", fixed.LOYALTY_TIERS))
    shared = with_share(tiers, "Total_Revenue", "Pct_Revenue")
    return shared.withColumn("Pct_Revenue", round_half_even("Pct_Revenue", 2)).orderBy("Loyalty_Rank")


def agg_coupon(enriched: DataFrame) -> DataFrame:
    coupons = enriched.dropna(subset=["Coupon Response"]).groupBy("Coupon Response").agg(
        F.sum("Count").alias("Usage_Count"),
        F.sum("Revenue").alias("Total_Revenue"),
        F.avg("Revenue").alias("Avg_Revenue"),
        F.sum("Profit").alias("Total_Profit"),
    )
    coupons = _with_margin(coupons).withColumn(
        "Revenue_Per_Use", round_half_even(ratio("Total_Revenue", "Usage_Count"), 2)
    )
    shared = with_share(coupons, "Usage_Count", "Pct_Usage")
    return shared.withColumn("Pct_Usage", round_half_even("Pct_Usage", 2)).orderBy(
        F.col("Usage_Count").desc(), "Coupon Response"
    )


def top_group(totals: DataFrame, key: str, value: str = "revenue") -> DataFrame:
    """One row: the key with the largest summed value, smallest key on a tie."""
    sums = totals.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum(value).alias("__sum"))
    best = sums.agg(F.max("__sum").alias("__best"))
    return attach_row(sums, best).where(F.col("__sum") == F.col("__best")).agg(F.min(key).alias(f"top_{key}"))


def kpi_values(enriched: DataFrame) -> DataFrame:
    """One row with the raw KPI numbers and the three leading groups."""
    known = F.when(F.col("Loyalty#").isNotNull(), F.col("Revenue"))
    totals = enriched.agg(
        F.sum("Revenue").alias("revenue"),
        F.sum("Profit").alias("profit"),
        F.sum("Count").alias("orders"),
        F.countDistinct("Loyalty#").alias("customers"),
        F.avg("Customer Lifetime Value").alias("avg_clv"),
        F.avg("ATV").alias("avg_atv"),
        F.sum(known).alias("known_revenue"),
    ).select(
        "*",
        pct("profit", "revenue").alias("margin_pct"),
        # Mean of per-customer sums equals the sum over customers divided by their number.
        ratio("known_revenue", "customers").alias("revenue_per_customer"),
    )
    cube = enriched.groupBy(
        F.col("Product Line").alias("product"), F.col("Country").alias("country"), F.col("LoyaltyStatus").alias("tier")
    ).agg(F.sum("Revenue").alias("revenue"))
    for key in ("product", "country", "tier"):
        totals = attach_row(totals, top_group(cube, key))
    return totals


def agg_kpi(enriched: DataFrame) -> DataFrame:
    """Eleven metric rows: position, label, formatted text and, where numeric, the number."""
    grouped = lambda c, digits: F.format_number(F.col(c), digits)
    plain = lambda c: F.replace(F.format_number(F.col(c), 2), F.lit(","), F.lit(""))
    number = lambda c: F.col(c).cast("double")
    none = F.lit(None).cast("double")
    rows = [
        ("Total Revenue ($)", grouped("revenue", 0), number("revenue")),
        ("Total Profit ($)", grouped("profit", 0), number("profit")),
        ("Overall Profit Margin (%)", plain("margin_pct"), number("margin_pct")),
        ("Total Transactions", grouped("orders", 0), number("orders")),
        ("Unique Customers", grouped("customers", 0), number("customers")),
        ("Avg CLV ($)", grouped("avg_clv", 2), number("avg_clv")),
        ("Avg Revenue per Transaction ($)", grouped("avg_atv", 2), number("avg_atv")),
        ("Avg Revenue per Customer ($)", grouped("revenue_per_customer", 2), number("revenue_per_customer")),
        ("Top Product Line (Revenue)", F.col("top_product"), none),
        ("Top Country (Revenue)", F.col("top_country"), none),
        ("Top LoyaltyStatus (Revenue)", F.col("top_tier"), none),
    ]
    structs = [
        F.struct(F.lit(i).alias("Position"), F.lit(m).alias("Metric"), v.alias("Value"), n.alias("Numeric_Value"))
        for i, (m, v, n) in enumerate(rows, 1)
    ]
    return kpi_values(enriched).select(F.inline(F.array(*structs))).orderBy("Position")


AGGREGATES = {
    "AGG_KPI": agg_kpi,
    "AGG_Year_Product": agg_year_product,
    "AGG_Country_Year": agg_country_year,
    "AGG_Loyalty": agg_loyalty,
    "AGG_Edu_Product": agg_edu_product,
    "AGG_Gender_Product": agg_gender_product,
    "AGG_Coupon": agg_coupon,
}


def build_aggregates(enriched: DataFrame) -> dict[str, DataFrame]:
    return {name: build(enriched) for name, build in AGGREGATES.items()}
