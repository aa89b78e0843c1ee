"""Registered queries against DuckDB on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as registered
from tidemark.plans.marts import mart
from tidemark.plans.oracle import ORACLE
from tidemark.plans.oracle_base import exact_sum, half_up
from tidemark.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "part", "orders", "lineitem")
# A spread over all operator families; the full set runs in the driver's check.
NAMES = (
    "sales_metrics", "dim_customer", "fact_sales", "agg_loyalty", "agg_kpi", "sales_by_product", "sales_by_loyalty",
    "retention_priority", "dq_report", "forecast_all_models", "unit_root_stat", "churn_snapshot", "auc", "lift_at_10",
    "best_threshold", "mix_shift", "new_vs_returning", "top_n_concentration",
)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(value):
    if hasattr(value, "isoformat"):
        return str(value)[:10]
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def ordered(rows):
    return sorted(rows, key=lambda r: tuple(f"{v:.3f}" if isinstance(v, float) else str(v) for v in r))


def test_every_oracle_has_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())
    # The optional operators account for their own queries.
    without = set(QUERIES) - set(ORACLE)
    assert without == {"churn_logistic", "churn_gbt", "feature_importance", "churn_pipeline", "ridge"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, duck, name):
    df = registered.queries()[name](spark, SF)
    columns = sorted(df.columns)
    ours = ordered([tuple(plain(r[c]) for c in columns) for r in df.collect()])
    relation = duck.sql(registered.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    place = [relation.columns.index(c) for c in columns]
    theirs = ordered([tuple(plain(r[i]) for i in place) for r in relation.fetchall()])
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs):
        for x, y in zip(a, b):
            assert x == y or (isinstance(x, float) and x == pytest.approx(y, rel=1e-9, abs=1e-9))


def test_marts_round_once(spark, duck):
    amounts = {1: [1.00499996], 2: [0.5, 0.505], 3: [0.1] * 10 + [0.005], 4: [-1.005], 5: [None, float("inf")]}
    rows = [(2020, f"Q{q}", q, f"2020-Q{q}", 1, a, a) for q, all_ in amounts.items() for a in all_]
    fact = spark.createDataFrame(rows, "year int, quarter string, quarter_num int, year_quarter string, order_count int, "
                                       "revenue double, profit double")
    got = {r.quarter_num: r.total_revenue for r in mart(spark, "sales_by_quarter", {"fact_sales": fact}).collect()}
    assert got == {1: 1.0, 2: 1.01, 3: 1.01, 4: -1.01, 5: None}
    for q in (1, 2, 3, 4):
        values = ", ".join(f"({a!r}::double)" for a in amounts[q])
        assert duck.sql(f"select {half_up(exact_sum('v'))} from (values {values}) t(v)").fetchall() == [(got[q],)]


def test_ridge_sums_the_fact_once(spark, monkeypatch):
    from tidemark import session
    from tidemark.plans import queries
    rows = [(f"{y}-Q{q}", y, q, p, float(y % 7 * q + i * 3), 1.0 * q * y % 5) for y in range(2001, 2007) for q in range(1, 5)
            for i, p in enumerate("xyz")]
    fact = spark.createDataFrame(rows, "Year_Quarter string, Year int, Quarter_Num int, Product_Line string, Revenue double, Profit double")
    monkeypatch.setattr(queries, "_fact", lambda *_: fact)
    before = session.mark(spark)
    assert queries.ridge(spark, "").count() == 13
    assert session.mark(spark) == before + 1
