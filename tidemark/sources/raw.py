"""Scan of a raw wide sales table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "Loyalty#": T.StringType(), "First Name": T.StringType(), "Last Name": T.StringType(),
    "Customer Name": T.StringType(), "Gender": T.StringType(), "Education": T.StringType(),
    "Marital Status": T.StringType(), "Income": T.DoubleType(), "MonthsAsMember": T.IntegerType(),
    "LoyaltyStatus": T.StringType(), "Customer Lifetime Value": T.DoubleType(),
    "Country": T.StringType(), "Province or State": T.StringType(), "City": T.StringType(),
    "Postal code": T.StringType(), "Latitude": T.DoubleType(), "Longitude": T.DoubleType(),
    "Location Code": T.StringType(), "Order Year": T.IntegerType(), "Quarter": T.StringType(),
    "Product Line": T.StringType(), "Coupon Response": T.StringType(), "Count": T.IntegerType(),
    "Quantity Sold": T.DoubleType(), "Unit Sale Price": T.DoubleType(), "Unit Cost": T.DoubleType(),
    "Revenue": T.DoubleType(), "Column1": T.BooleanType(),
}
RAW_SCHEMA = T.StructType([T.StructField(n, t) for n, t in _TYPES.items()])


def read_raw_sales(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = RAW_SCHEMA, **options
) -> DataFrame:
    """Read the raw sheet exported as Parquet or CSV; the URI scheme picks local or object storage.

    Columns are found by their trimmed names, in any order, and cast to ``schema``; a value that cannot be cast is
    null. Missing and repeated columns raise.
    """
    if fmt == "csv":
        options = {"header": True, "inferSchema": False, **options}
    found = spark.read.options(**options).format(fmt).load(path)
    trimmed = [c.strip() for c in found.columns]
    missing = [f.name for f in schema if f.name not in trimmed]
    repeated = sorted({f.name for f in schema if trimmed.count(f.name) > 1})
    if missing or repeated:
        raise ValueError(f"raw table {path}: missing columns {missing}, repeated columns {repeated}")
    source = dict(zip(trimmed, found.columns))
    return found.select(*[F.col(f"`{source[f.name]}`").try_cast(f.dataType).alias(f.name) for f in schema])
