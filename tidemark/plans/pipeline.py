"""The whole job in order: ETL, gate, publish, models, catalog, views, validation."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions import fixed
from ..operators import classifiers, quality
from ..sources import catalog, curated, reports
from . import etl, modelling


class QualityGateError(RuntimeError):
    """Raised when an ERROR check fails; carries the report."""

    def __init__(self, report: DataFrame):
        failed = [r["check_name"] for r in report.where("level = 'ERROR' AND status = 'FAIL'").collect()]
        super().__init__(f"Blocking data quality failures: {', '.join(failed)}")
        self.report = report


def run_pipeline(
    spark: SparkSession,
    raw: DataFrame,
    base: str,
    database: str = "retail_analytics",
    partial_years: Collection[int] = (2020,),
    recent_year: int = 2020,
    candidates: Sequence[classifiers.Candidate] = classifiers.CANDIDATES,
    gate_first: bool = True,
    ignore_checks: Collection[str] = (),
) -> dict[str, object]:
    """Run every step; stop at a blocking quality failure.

    ``gate_first`` checks before anything is published; otherwise the curated layer is written
    first. ``ignore_checks`` names ERROR checks that may fail without stopping the run.
    """
    built = etl.build_star(raw, partial_years)
    locations = {} if gate_first else etl.publish(built, f"{base}/curated")
    report = quality.quality_report(built.gate_tables(), max(partial_years), recent_year)
    reports.save_csv(report, f"{base}/outputs/data_quality_report", single_file=True)
    if "Quarter" in built.fact_sales.columns:
        labels = quality.unaccepted_values(built.fact_sales, "Quarter", fixed.QUARTERS)
        reports.save_csv(labels, f"{base}/outputs/unaccepted_quarters")
    if quality.has_blocking_failures(report.where(~report["check_name"].isin(*ignore_checks))):
        raise QualityGateError(report)
    if gate_first:
        locations = etl.publish(built, f"{base}/curated")

    fact, customers = curated.load_model_tables(spark, f"{base}/curated")
    tables = {"data_validation_report": quality.model_input_report(fact, customers), **modelling.forecast_reports(fact)}
    result, churn_tables = modelling.churn_reports(fact, customers, candidates)
    tables.update(churn_tables)
    tables[reports.prediction_name(reports.latest_label(fact))] = tables.pop("churn_predictions")
    reports.save_bundle({**etl.aggregate_tables(built), **tables}, f"{base}/outputs/reports")
    reports.save_model(result.model, f"{base}/outputs/models/{result.champion.lower()}")

    catalog.register_curated(spark, database, f"{base}/curated")
    catalog.repair_partitions(spark, database)
    catalog.create_views(spark, database)
    return {
        "curated": locations, "champion": result.champion, "threshold": result.threshold,
        "validations": catalog.validate(spark, database, f"{base}/outputs/validations"),
    }
