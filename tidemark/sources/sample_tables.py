"""The wide sales table derived from the order-entry tables used for checks and benchmarks.

``sales_raw`` only joins the tables that the requested columns need, so a plan that reads three
columns does not carry five joins. Small tables are broadcast by Spark from their file size.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import EDUCATION_LEVELS, LOYALTY_TIERS

GENDERS = ("Male", "Female")
MARITAL = ("Single", "Married", "Divorced")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _columns() -> dict[str, tuple[Column, str]]:
    """Raw column -> (expression, table it needs besides line items)."""
    key = F.col("c_custkey")
    place = (key % 10).cast("string")
    return {
        "Loyalty#": (F.col("o_custkey").cast("string"), "orders"),
        "First Name": (F.split("c_name", "#")[0], "customer"),
        "Last Name": (F.split("c_name", "#")[1], "customer"),
        "Customer Name": (F.col("c_name"), "customer"),
        "Gender": (_pick(GENDERS, key % 2), "customer"),
        "Education": (_pick(EDUCATION_LEVELS, F.floor(key / 6) % 5), "customer"),
        "Marital Status": (_pick(MARITAL, key % 3), "customer"),
        "Income": (
            F.when(F.col("c_acctbal") < 0, 0.0).otherwise(F.floor(F.col("c_acctbal") * 10).cast("double")),
            "customer",
        ),
        "MonthsAsMember": ((key % 75).cast("int"), "customer"),
        "LoyaltyStatus": (_pick(LOYALTY_TIERS, key % 6), "customer"),
        "Customer Lifetime Value": (F.col("c_acctbal") + 1000, "customer"),
        "Country": (F.col("n_name"), "nation"),
        "Province or State": (F.col("r_name"), "region"),
        "City": (F.concat(F.lit(" C"), place, F.lit(" ")), "customer"),
        "Postal code": (F.concat(F.lit("P"), place), "customer"),
        "Latitude": (F.col("c_nationkey") * 1.5, "customer"),
        "Longitude": (F.col("c_nationkey") * -2.5, "customer"),
        "Location Code": (F.lit("Urban"), "lineitem"),
        "Order Year": (F.year("o_orderdate"), "orders"),
        "Quarter": (F.concat(F.lit("Q"), F.quarter("o_orderdate").cast("string")), "orders"),
        "Product Line": (F.col("p_type"), "part"),
        "Coupon Response": (F.concat(F.lit("Coupon "), F.substring("o_orderpriority", 1, 1)), "orders"),
        "Count": (F.lit(1), "lineitem"),
        "Quantity Sold": (F.col("l_quantity"), "lineitem"),
        "Unit Sale Price": (F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")), "lineitem"),
        "Unit Cost": (F.col("p_retailprice"), "part"),
        "Revenue": (F.col("l_extendedprice") * (1 - F.col("l_discount")), "lineitem"),
        "Column1": (F.lit(True), "lineitem"),
    }


def sales_raw(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    """One row per line item with the raw sales columns, or only the ``columns`` asked for."""
    available = _columns()
    wanted = list(available) if columns is None else list(columns)
    needs = {available[c][1] for c in wanted}
    if "region" in needs:
        needs.add("nation")
    if "nation" in needs:
        needs.add("customer")
    if "customer" in needs:
        needs.add("orders")

    rows = table(spark, sf_dir, "lineitem")
    if "orders" in needs:
        rows = rows.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    if "part" in needs:
        rows = rows.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if "customer" in needs:
        people = table(spark, sf_dir, "customer")
        if "nation" in needs:
            people = people.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        if "region" in needs:
            people = people.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        rows = rows.join(people, F.col("o_custkey") == F.col("c_custkey"))
    return rows.select(*[available[c][0].alias(c) for c in wanted])
