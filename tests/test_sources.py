"""Reading, publishing, catalog and the whole job on the smallest tables."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import classifiers
from tidemark.plans import pipeline
from tidemark.plans.marts import MARTS, VALIDATIONS
from tidemark.sources import catalog, curated, raw, reports
from tidemark.sources.sample_tables import sales_raw

SF = "/root/testdata/sf0.001"


def years(spark, *values):
    return spark.createDataFrame([(i, y) for i, y in enumerate(values)], "id int, Year int")


def test_partition_column_reads_back_as_text(spark, tmp_path):
    curated.save_curated(years(spark, 2019, 2020, 2020), str(tmp_path), "fact_sales")
    back = curated.read_curated(spark, str(tmp_path), "fact_sales")
    assert back.schema["partition_year"].dataType == T.StringType()
    pruned = back.where("partition_year = '2020'")
    assert pruned.count() == 2
    assert "= 2020" in pruned._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]


def test_overwrite_modes_differ_on_stale_partitions(spark, tmp_path):
    def seen(mode):
        path = str(tmp_path / mode)
        curated.save_table(curated.prepare("fact_sales", years(spark, 2019, 2020)), path, ["partition_year"])
        curated.save_table(curated.prepare("fact_sales", years(spark, 2020)), path, ["partition_year"], overwrite=mode)
        return {r["Year"] for r in curated.read_table(spark, path).collect()}

    assert seen("partitions") == {2019, 2020}
    assert seen("dataset") == {2020}
    with pytest.raises(ValueError):
        curated.save_table(years(spark, 1), str(tmp_path / "x"), overwrite="other")


def test_failed_write_keeps_the_old_dataset(spark, tmp_path):
    path = str(tmp_path / "t")
    curated.save_table(years(spark, 2019), path)
    broken = years(spark, 2020).withColumn("x", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        curated.save_table(broken, path)
    assert curated.read_table(spark, path).first()["Year"] == 2019
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["t"]


def test_dataset_can_replace_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    curated.save_table(years(spark, 2019), path)
    curated.save_table(curated.read_table(spark, path).withColumn("Year", F.col("Year") + 1), path)
    assert curated.read_table(spark, path).first()["Year"] == 2020


def test_missing_model_tables(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        curated.load_model_tables(spark, str(tmp_path / "no"), str(tmp_path / "neither"))


def test_csv_has_mark_and_header(spark, tmp_path):
    reports.save_csv(years(spark, 2019), str(tmp_path / "r"), single_file=True)
    (part,) = (tmp_path / "r").glob("part-*.csv")
    assert part.read_bytes().startswith(b"\xef\xbb\xbfid,Year")
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).columns == ["id", "Year"]


def test_raw_scan_csv_and_parquet(spark, tmp_path):
    sales_raw(spark, SF).limit(5).write.parquet(str(tmp_path / "p"))
    rows = spark.read.parquet(str(tmp_path / "p"))
    rows.write.option("header", True).csv(str(tmp_path / "c"))
    parquet = raw.read_raw_sales(spark, str(tmp_path / "p"))
    text = raw.read_raw_sales(spark, str(tmp_path / "c"), "csv")
    assert parquet.schema == text.schema == raw.RAW_SCHEMA
    assert sorted(r["Revenue"] for r in parquet.collect()) == sorted(r["Revenue"] for r in text.collect())


def test_raw_scan_goes_by_trimmed_name(spark, tmp_path):
    rows = sales_raw(spark, SF).limit(5)
    padded = rows.select(*[rows[f"`{c}`"].alias(f" {c} ") for c in reversed(rows.columns)])
    padded.write.parquet(str(tmp_path / "p"))
    padded.write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(str(tmp_path / "c"))
    for found in (raw.read_raw_sales(spark, str(tmp_path / "p")), raw.read_raw_sales(spark, str(tmp_path / "c"), "csv")):
        assert found.schema == raw.RAW_SCHEMA
        assert found.where("`Loyalty#` IS NULL OR Country IS NULL OR Revenue IS NULL").count() == 0
    rows.drop("Revenue").write.parquet(str(tmp_path / "m"))
    with pytest.raises(ValueError, match=r"missing columns \['Revenue'\]"):
        raw.read_raw_sales(spark, str(tmp_path / "m"))


def test_decimal_table_can_be_read(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.sql("SELECT CAST(1.25 AS DECIMAL(12,3)) AS amount, 'a' AS part").write.parquet(path)
    catalog.register_table(spark, "decimals", "d", path, [])
    assert str(spark.table("decimals.d").first()["amount"]) == "1.250"


def test_sql_types():
    kinds = [T.IntegerType(), T.FloatType(), T.BooleanType(), T.TimestampNTZType(), T.DateType(), T.StringType(), T.BinaryType()]
    assert [catalog.sql_type(k) for k in kinds] == ["bigint", "double", "boolean", "timestamp", "date", "string", "binary"]
    assert catalog.sql_type(T.DecimalType(12, 3)) == "decimal(12,3)"


def test_schema_guards(spark, tmp_path):
    with pytest.raises(ValueError, match="No Parquet files found"):
        catalog.sample_schema(spark, str(tmp_path / "absent"))
    (tmp_path / "hollow").mkdir()
    with pytest.raises(ValueError, match="No Parquet files found"):
        catalog.sample_schema(spark, str(tmp_path / "hollow"))
    years(spark, 2019).limit(0).write.parquet(str(tmp_path / "empty"))
    with pytest.raises(ValueError, match="empty"):
        catalog.sample_schema(spark, str(tmp_path / "empty"))


def test_pruned_source_reads_only_what_it_needs(spark):
    plan = sales_raw(spark, SF, ["Revenue", "Order Year"])._jdf.queryExecution().executedPlan().toString()
    read = sorted(line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema" in line)
    assert read == [
        "struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>",
        "struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>",
    ]


def test_pipeline_end_to_end(spark, tmp_path):
    base = str(tmp_path / "run")
    data = sales_raw(spark, SF)
    with pytest.raises(pipeline.QualityGateError, match="negative_profit"):
        pipeline.run_pipeline(spark, data, base, "blocked", (2001,), 2001)
    assert not curated.exists(spark, f"{base}/curated")

    out = pipeline.run_pipeline(
        spark, data, base, "shop", (2001,), 2001, candidates=classifiers.CANDIDATES[:1],
        ignore_checks=["fact_sales_no_negative_profit"],
    )
    assert out["champion"] == "Logistic_Balanced"
    assert set(out["validations"]) == set(VALIDATIONS)
    rows = {r["table_name"]: r["row_count"] for r in out["validations"]["val_row_counts"].collect()}
    long = out["validations"]["val_product_order"]
    assert long.count() == spark.read.parquet(f"{base}/outputs/validations/val_product_order").count()
    assert rows["fact_sales"] == data.count() and rows["dim_product"] == 6
    assert {r["tableName"] for r in spark.sql("SHOW VIEWS IN shop").selectExpr("viewName AS tableName").collect()} >= set(MARTS)
    assert PipelineModel.load(f"{base}/outputs/models/logistic_balanced").stages
    forecast = spark.read.parquet(f"{base}/outputs/reports/forecast_revenue_profit")
    assert forecast.count() == 7
    assert spark.read.parquet(f"{base}/outputs/reports/churn_predictions_snapshot_2001Q3").count() > 0
    ids = spark.table("shop.fact_sales").agg(F.min("Fact_ID"), F.max("Fact_ID"), F.countDistinct("Fact_ID")).first()
    assert tuple(ids) == (1, rows["fact_sales"], rows["fact_sales"])
