"""Catalog tables, partition repair, views and post-load validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..plans.marts import MARTS, VALIDATIONS, names_in
from .curated import LAYOUT, exists, partition_columns, table_path
from .reports import save_bundle

_SQL_TYPES = (
    ((T.ByteType, T.ShortType, T.IntegerType, T.LongType), "bigint"),
    ((T.FloatType, T.DoubleType), "double"),
    ((T.BooleanType,), "boolean"),
    ((T.TimestampType, T.TimestampNTZType), "timestamp"),
    ((T.DateType,), "date"),
)


def sql_type(data_type: T.DataType) -> str:
    """Catalog type of a column; a type without a counterpart in the list (decimals, arrays) keeps Spark's own."""
    return next((name for kinds, name in _SQL_TYPES if isinstance(data_type, kinds)), data_type.simpleString())


def sample_schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema from the Parquet footers; refuses missing and empty datasets."""
    missing = ValueError(f"No Parquet files found under {path}; write the curated tables first")
    if not exists(spark, path):
        raise missing
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
        "recursiveFileLookup", True).load(path).select("path")
    if files.isEmpty():
        raise missing
    df = spark.read.parquet(path)
    if df.isEmpty():
        raise ValueError(f"{path} has Parquet files without rows, which cannot be registered")
    return df.schema


def register_table(spark: SparkSession, database: str, name: str, path: str, partition_by: list[str]) -> None:
    """Create (or replace) an external table over a dataset; partition columns are text."""
    columns = {f.name: sql_type(f.dataType) for f in sample_schema(spark, path).fields if f.name not in partition_by}
    if not columns:
        raise ValueError(f"{name}: only partition columns under {path}")
    listed = ", ".join(f"`{c}` {t}" for c, t in {**columns, **{p: "string" for p in partition_by}}.items())
    layout = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    spark.sql(f"CREATE TABLE {database}.{name} ({listed}) USING parquet {layout} LOCATION '{path}'")


def register_curated(spark: SparkSession, database: str, base: str) -> None:
    for name in LAYOUT:
        register_table(spark, database, name, table_path(base, name), partition_columns(name))


def repair_partitions(spark: SparkSession, database: str) -> None:
    for name in LAYOUT:
        if partition_columns(name):
            spark.sql(f"MSCK REPAIR TABLE {database}.{name}")


def _bound(text: str, database: str) -> str:
    return text.format(**{n: f"{database}.{n}" for n in names_in(text)})


def create_views(spark: SparkSession, database: str) -> list[str]:
    """Drop the marts against their dependencies, then create them in order."""
    for name in reversed(MARTS):
        spark.sql(f"DROP VIEW IF EXISTS {database}.{name}")
    for name, text in MARTS.items():
        spark.sql(f"CREATE VIEW {database}.{name} AS {_bound(text, database)}")
    return list(MARTS)


def validations(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    return {name: spark.sql(_bound(text, database)) for name, text in VALIDATIONS.items()}


def validate(spark: SparkSession, database: str, base: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Run every check in full, write each result as a table below ``base`` and return them; a failing check raises."""
    found = validations(spark, database)
    paths = save_bundle(found, base, fmt)
    return {name: spark.read.schema(df.schema).format(fmt).load(paths[name]) for name, df in found.items()}
