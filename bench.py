"""Time the headline queries over the whole tables and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores, BENCH_QUERIES (optional) a
comma-separated list of query names. Results are written to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import time

from tidemark.plans.queries import QUERIES
from tidemark.session import build_session

HEADLINE = (
    "sales_by_quarter", "sales_by_product", "sales_by_loyalty", "customer_value", "retention_priority",
    "enrich_sales", "fact_sales", "dim_customer", "agg_year_product", "agg_loyalty", "agg_kpi", "dq_report",
    "forecast_horizon", "churn_training_windows", "auc", "scored_customers", "new_vs_returning",
    "top_n_concentration",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.log.level": "ERROR",
    })
    spark.read.parquet(f"{folder}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total wall time of headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
