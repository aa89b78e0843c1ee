"""Star schema: four dimensions and the sales fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import pct, round_half_even
from ..functions.quarters import quarter_end
from .scale import lookup_join, sequential_ids, small_or_sequential_ids

CUSTOMER_COLUMNS = {
    "Loyalty#": "Customer_ID", "First Name": "First_Name", "Last Name": "Last_Name",
    "Customer Name": "Full_Name", "Gender": "Gender", "Education": "Education",
    "Education_Rank": "Education_Rank", "Marital Status": "Marital_Status", "Income": "Income",
    "Income_Flag": "Income_Flag", "Income_Bucket": "Income_Bucket",
    "MonthsAsMember": "Months_As_Member", "Tenure_Bucket": "Tenure_Bucket",
    "LoyaltyStatus": "LoyaltyStatus", "Loyalty_Rank": "Loyalty_Rank",
    "Customer Lifetime Value": "CLV", "CLV_Segment": "CLV_Segment",
}
GEOGRAPHY_COLUMNS = {
    "Geo_Key": "Geo_Key", "Region_Key": "Region_Key", "Country": "Country",
    "Province or State": "Province_State", "City": "City", "Postal code": "Postal_Code",
    "Latitude": "Latitude", "Longitude": "Longitude", "Location Code": "Location_Type",
}
FACT_COLUMNS = {
    "Loyalty#": "Customer_ID", "Date_Key": "Date_Key", "Product Line": "Product_Line",
    "Region_Key": "Region_Key", "Geo_Key": "Geo_Key", "Coupon Response": "Coupon_Response",
    "Coupon_Num": "Coupon_Num", "Coupon_Popularity_Rank": "Coupon_Popularity_Rank",
    "Count": "Order_Count", "Quantity Sold": "Quantity_Sold", "Unit Sale Price": "Unit_Sale_Price",
    "Unit Cost": "Unit_Cost", "Revenue": "Revenue", "Total_Cost": "Total_Cost", "Profit": "Profit",
    "Profit_Margin_Pct": "Profit_Margin_Pct", "ATV": "ATV", "Revenue_Per_Unit": "Revenue_Per_Unit",
    "Gross_Contribution": "Gross_Contribution", "LoyaltyStatus": "LoyaltyStatus",
    "Loyalty_Rank": "Loyalty_Rank", "Income_Bucket": "Income_Bucket", "Tenure_Bucket": "Tenure_Bucket",
    "CLV_Segment": "CLV_Segment", "Order Year": "Year", "Quarter": "Quarter",
    "Quarter_Num": "Quarter_Num", "Year_Quarter": "Year_Quarter", "Is_Full_Year": "Is_Full_Year",
}
# These columns determine every other fact column, so equal rows are interchangeable.
FACT_ORDER = (
    "Customer_ID", "Date_Key", "Product_Line", "Geo_Key", "Coupon_Response", "Order_Count",
    "Quantity_Sold", "Unit_Sale_Price", "Unit_Cost", "Revenue", "LoyaltyStatus", "Income_Bucket",
    "Tenure_Bucket", "CLV_Segment",
)


def project(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(f"`{source}`").alias(target) for source, target in names.items()])


def first_per_key(df: DataFrame, key: str, ranking: Sequence[str], largest: bool) -> DataFrame:
    """One whole row per key: the largest or smallest by ``ranking``, then by all other columns.

    Copies collapse in a hash aggregate first, so a hot key shrinks before rows are sorted and
    compared. The number of copies rides along last in the comparison, where it cannot matter, to
    keep the optimizer from dropping that step. Nulls rank lowest.
    """
    rest = [c for c in df.columns if c != key and c not in ranking]
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("__copies"))
    row = F.struct(*ranking, *rest, "__copies")
    pick = F.max(row) if largest else F.min(row)
    return copies.groupBy(key).agg(pick.alias("__row")).select(
        *[F.col(key) if c == key else F.col(f"__row.{c}").alias(c) for c in df.columns]
    )


def build_dim_date(enriched: DataFrame) -> DataFrame:
    keys = enriched.select(
        "Date_Key", F.col("Order Year").alias("Year"), "Quarter", "Quarter_Num", "Year_Quarter", "Is_Full_Year"
    ).distinct()
    return keys.select(
        "Date_Key", quarter_end("Year", "Quarter_Num").alias("Date"),
        "Year", "Quarter", "Quarter_Num", "Year_Quarter", "Is_Full_Year",
    )


def product_stats(enriched: DataFrame) -> DataFrame:
    stats = enriched.where(F.col("Product Line").isNotNull()).groupBy(F.col("Product Line").alias("Product_Line")).agg(
        F.sum("Revenue").alias("Total_Revenue"),
        F.sum("Profit").alias("Total_Profit"),
        round_half_even(F.avg("Unit Sale Price")).alias("Avg_Unit_Price"),
        round_half_even(F.avg("Unit Cost")).alias("Avg_Unit_Cost"),
        F.sum("Count").alias("Total_Orders"),
        F.sum("Quantity Sold").alias("Total_Qty"),
    )
    margin = round_half_even(pct("Total_Profit", "Total_Revenue"), 4)
    return stats.withColumn("Avg_Profit_Margin_Pct", margin)


def build_dim_product(enriched: DataFrame) -> DataFrame:
    return small_or_sequential_ids(product_stats(enriched), "Product_ID", ["Product_Line"])


def product_ids(enriched: DataFrame) -> DataFrame:
    """Product_Line -> Product_ID without the statistics."""
    lines = enriched.select(F.col("Product Line").alias("Product_Line")).where("Product_Line IS NOT NULL").distinct()
    return small_or_sequential_ids(lines, "Product_ID", ["Product_Line"])


def build_dim_geography(enriched: DataFrame) -> DataFrame:
    places = first_per_key(project(enriched, GEOGRAPHY_COLUMNS), "Geo_Key", [], largest=False)
    return small_or_sequential_ids(places, "Geo_ID", ["Geo_Key"])


def build_dim_customer(enriched: DataFrame) -> DataFrame:
    """One row per customer: attributes of the row with the highest CLV."""
    return first_per_key(project(enriched, CUSTOMER_COLUMNS), "Customer_ID", ["CLV"], largest=True)


def build_fact(
    enriched: DataFrame, products: DataFrame | None = None, id_order: Sequence[str] | None = FACT_ORDER
) -> DataFrame:
    """Sales fact with Product_ID and a dense Fact_ID.

    ``id_order=None`` numbers rows in stored order, which saves the range shuffle.
    """
    rows = fact_rows(enriched, products)
    return sequential_ids(rows, "Fact_ID", id_order)


def fact_columns(enriched: DataFrame, *more: str) -> DataFrame:
    """The fact columns whose inputs are present, under their curated names, and ``more`` columns under their own."""
    return project(enriched, {**{s: t for s, t in FACT_COLUMNS.items() if s in enriched.columns}, **{c: c for c in more}})


def fact_rows(enriched: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """The fact before numbering, with Product_ID."""
    rows = fact_columns(enriched)
    ids = product_ids(enriched) if products is None else products.select("Product_Line", "Product_ID")
    return lookup_join(rows, ids, "Product_Line").select(*rows.columns, "Product_ID")


def with_partition_column(df: DataFrame, source: str, partition: str) -> DataFrame:
    return df.withColumn(partition, F.col(source).cast("string"))
