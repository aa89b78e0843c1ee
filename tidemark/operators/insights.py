"""Business analyses over the sales fact: growth drivers, mix, concentration, new and returning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import pct, ratio
from ..functions.quarters import calendar_index
from .scale import null_safe_join, top_n_per_group, with_share

PERIOD = ("Year_Quarter", "Year", "Quarter_Num")
DRIVERS = ("Revenue", "Orders", "Customers")


def period_totals(fact: DataFrame, dims: Sequence[str] = (), distinct_customers: bool = True) -> DataFrame:
    """Revenue, profit, orders, quantity and distinct customers per quarter and dimension."""
    extra = [F.countDistinct("Customer_ID").alias("Customers")] if distinct_customers else []
    return fact.groupBy(*PERIOD, *dims).agg(
        F.sum("Revenue").alias("Revenue"), F.sum("Profit").alias("Profit"), F.sum("Order_Count").alias("Orders"),
        F.sum("Quantity_Sold").alias("Quantity"), *extra,
    ).withColumn("__q", calendar_index("Year", "Quarter_Num"))


def with_year_ago(totals: DataFrame, dims: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Add ``Prior_<m>`` (same calendar quarter a year before) and ``<m>_YoY_Pct``."""
    prior = totals.select((F.col("__q") + 4).alias("__q"), *dims, *[F.col(m).alias(f"Prior_{m}") for m in measures])
    joined = null_safe_join(totals, prior, ["__q", *dims], "left")
    change = {f"{m}_YoY_Pct": pct(F.col(m) - F.col(f"Prior_{m}"), f"Prior_{m}") for m in measures}
    return joined.withColumns(change)


def yoy_drivers(fact: DataFrame) -> DataFrame:
    """Revenue = orders x average order value, with the change of each against a year before."""
    totals = period_totals(fact).withColumn("AOV", ratio("Revenue", "Orders"))
    measures = (*DRIVERS, "AOV")
    df = with_year_ago(totals, [], measures)
    return df.select(
        "Year_Quarter", *measures, *[f"Prior_{m}" for m in measures], *[f"{m}_YoY_Pct" for m in measures]
    ).orderBy("Year_Quarter")


def price_quantity_split(fact: DataFrame, dims: Sequence[str] = ()) -> DataFrame:
    """Quantity-weighted unit price and quantity per order per quarter, with year-on-year change."""
    totals = period_totals(fact, dims, distinct_customers=False).withColumns(
        {"Weighted_Unit_Price": ratio("Revenue", "Quantity"), "Quantity_Per_Order": ratio("Quantity", "Orders")}
    )
    measures = ("Weighted_Unit_Price", "Quantity_Per_Order")
    df = with_year_ago(totals, list(dims), measures)
    return df.select("Year_Quarter", *dims, *measures, *[f"{m}_YoY_Pct" for m in measures])


def yoy_by(fact: DataFrame, dim: str) -> DataFrame:
    df = with_year_ago(period_totals(fact, [dim]), [dim], DRIVERS)
    return df.select("Year_Quarter", dim, *DRIVERS, *[f"{m}_YoY_Pct" for m in DRIVERS])


def mix_shift(fact: DataFrame, dim: str) -> DataFrame:
    """Revenue share of each group within a quarter and its change in points against a year before."""
    totals = period_totals(fact, [dim], distinct_customers=False)
    whole = F.sum("Revenue").over(Window.partitionBy("__q"))
    totals = totals.withColumn("Revenue_Share_Pct", pct("Revenue", whole))
    df = with_year_ago(totals, [dim], ["Revenue_Share_Pct"])
    return df.select(
        "Year_Quarter", dim, "Revenue", "Revenue_Share_Pct",
        (F.col("Revenue_Share_Pct") - F.col("Prior_Revenue_Share_Pct")).alias("Share_Shift_Points"),
    )


def revenue_share(fact: DataFrame, dim: str) -> DataFrame:
    """Revenue, profit, orders, order value and share of total per group over all periods."""
    groups = fact.groupBy(dim).agg(
        F.sum("Revenue").alias("Revenue"), F.sum("Profit").alias("Profit"), F.sum("Order_Count").alias("Orders"),
        F.countDistinct("Customer_ID").alias("Customers"),
    )
    return with_share(groups, "Revenue", "Revenue_Share_Pct").withColumns(
        {"AOV": ratio("Revenue", "Orders"), "Revenue_Per_Customer": ratio("Revenue", "Customers")}
    )


def new_vs_returning(fact: DataFrame) -> DataFrame:
    """Revenue, orders and customers per quarter, split by whether the quarter is the customer's first.

    The window runs on one row per customer and quarter, so a busy customer stays small.
    """
    visits = fact.where(F.col("Customer_ID").isNotNull()).groupBy("Customer_ID", *PERIOD).agg(
        F.sum("Revenue").alias("Revenue"), F.sum("Order_Count").alias("Orders")
    ).withColumn("__q", calendar_index("Year", "Quarter_Num"))
    first = F.min("__q").over(Window.partitionBy("Customer_ID"))
    kind = F.when(F.col("__q") == first, "New").otherwise("Returning")
    return visits.withColumn("Customer_Type", kind).groupBy("Year_Quarter", "Customer_Type").agg(
        F.sum("Revenue").alias("Revenue"), F.sum("Orders").alias("Orders"), F.count("*").alias("Customers")
    )


def top_n_concentration(fact: DataFrame, n: int = 500) -> DataFrame:
    """Share of each quarter's revenue that its ``n`` largest transactions hold."""
    sums = fact.groupBy("Year_Quarter").agg(F.sum("Revenue").alias("Revenue"), F.count("*").alias("Transactions"))
    largest = top_n_per_group(
        fact.select("Year_Quarter", "Revenue"), ["Year_Quarter"], [F.col("Revenue").desc_nulls_last()], n
    ).groupBy("Year_Quarter").agg(F.sum("Revenue").alias("Top_Revenue"))
    return sums.join(largest, "Year_Quarter").withColumn("Top_Share_Pct", pct("Top_Revenue", "Revenue"))


def dashboard_extract(fact: DataFrame, dims: Sequence[str]) -> DataFrame:
    """The measures the sales, product and customer dashboards show, for any grouping."""
    return fact.groupBy(*dims).agg(
        F.sum("Revenue").alias("Revenue"), F.sum("Profit").alias("Profit"), F.sum("Order_Count").alias("Orders"),
        F.sum("Quantity_Sold").alias("Quantity"), F.avg("Unit_Sale_Price").alias("Avg_Unit_Price"),
    ).withColumns({"Profit_Margin_Pct": pct("Profit", "Revenue"), "AOV": ratio("Revenue", "Orders")})


def revenue_pivot(fact: DataFrame, rows: str, columns: str, values: Sequence[str]) -> DataFrame:
    """Revenue with the given ``columns`` values side by side."""
    return fact.groupBy(rows).pivot(columns, list(values)).agg(F.sum("Revenue"))
