"""Distributed building blocks against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import scale


def test_exact_quantiles_both_paths(spark):
    rng = np.random.default_rng(7)
    values = np.concatenate([rng.lognormal(3, 2, 3000), np.full(1500, 5.0)])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "x double")
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.999, 1.0]
    expected = np.quantile(values, probs)
    for limit in (10**6, 0):
        assert scale.exact_quantiles(df, "x", probs, exact_distinct=limit) == pytest.approx(expected, rel=1e-12)
    assert scale.exact_quantiles(df.where("x > 1e30"), "x", [0.5]) == [None]


def test_sequential_ids_dense_and_ordered_with_identical_copies(spark):
    rows = [("a", i % 7, 1.0) for i in range(500)] + [("hot", 0, 0.0)] * 400
    df = spark.createDataFrame(rows, "k string, n int, v double").repartition(5)
    out = scale.sequential_ids(df, "Row_ID", ["k", "n"]).orderBy("Row_ID").collect()
    assert [r["Row_ID"] for r in out] == list(range(1, 901))
    assert [(r["k"], r["n"]) for r in out] == sorted((k, n) for k, n, _ in rows)
    stored = scale.sequential_ids(df, "Row_ID")
    assert sorted(r[0] for r in stored.select("Row_ID").collect()) == list(range(1, 901))


def test_small_and_large_dimension_ids_agree(spark, monkeypatch):
    df = spark.createDataFrame([(f"p{i:03d}",) for i in range(50)], "p string").repartition(4)
    small = {tuple(r) for r in scale.small_or_sequential_ids(df, "ID", ["p"]).collect()}
    monkeypatch.setattr(scale, "small_table", lambda *a, **k: None)
    assert {tuple(r) for r in scale.small_or_sequential_ids(df, "ID", ["p"]).collect()} == small


def test_running_totals(spark):
    rng = np.random.default_rng(3)
    rows = [(k, float(v), int(w)) for k in ("a", "b", None)
            for v, w in zip(rng.permutation(400) / 7, rng.integers(0, 9, 400))]
    df = spark.createDataFrame(rows, "k string, v double, w bigint")
    out = scale.with_running_totals(df, "v", ["w"], ["k"], buckets=16).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r["before_w"] == sum(w for k, v, w in rows if k == r["k"] and v < r["v"])


def test_lookup_join_paths_agree(spark, monkeypatch):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("z", 4)], "k string, n int")
    lookup = spark.createDataFrame([("a", 10), ("b", 20)], "k string, v int")
    expected = {("a", 1, 10), ("b", 2, 20), (None, 3, None), ("z", 4, None)}
    literal = scale.lookup_join(df, lookup, "k").select("k", "n", "v")
    assert "Join" not in literal._jdf.queryExecution().optimizedPlan().toString()
    assert {tuple(r) for r in literal.collect()} == expected
    monkeypatch.setattr(scale, "LITERAL_ROWS", 0)
    assert {tuple(r) for r in scale.lookup_join(df, lookup, "k").select("k", "n", "v").collect()} == expected
    shuffled = scale.lookup_join(df, lookup, "k", max_rows=1).select("k", "n", "v")
    assert {tuple(r) for r in shuffled.collect()} == expected


def test_top_n_per_group_on_hot_key(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 11).otherwise(99).alias("k"), F.col("id").alias("v")
    ).repartition(6)
    out = scale.top_n_per_group(df, ["k"], [F.col("v").desc()], 5, salts=4).collect()
    rows = [(r["k"], r["v"]) for r in df.collect()]
    for key in {k for k, _ in rows}:
        got = [r["v"] for r in sorted((r for r in out if r["k"] == key), key=lambda r: r["rank"])]
        assert got == sorted((v for k, v in rows if k == key), reverse=True)[:5]


@pytest.mark.parametrize("keys", [0, 1, 64, 65, 300])
@pytest.mark.parametrize("bound", [10, 100_000])
def test_lookup_layout_does_not_depend_on_its_size(spark, keys, bound):
    rows = spark.range(50).selectExpr("id AS n", "id AS k", "'v' AS v")
    lookup = spark.range(keys).selectExpr("id AS k", "id * 10 AS x")
    found = scale.lookup_join(rows, lookup, "k", max_rows=bound)
    assert found.columns == ["n", "k", "v", "x"]
    assert sorted((r.k, r.x) for r in found.collect()) == [(i, i * 10 if i < keys else None) for i in range(50)]
    with pytest.raises(ValueError, match="both sides"):
        scale.lookup_join(rows, lookup.withColumnRenamed("x", "v"), "k", max_rows=bound)


@pytest.mark.parametrize("bound", [3, 1_000_000])
def test_quantiles_with_infinities_and_one_repeated_value(spark, bound):
    values = [float(i) for i in range(40)] + [float("inf"), float("inf"), float("-inf"), -0.0, 0.0] + [7.0] * 46
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ordered = sorted(values)
    at = [0.25, 0.5, 0.75]
    want = []
    for p in at:
        pos = p * (len(ordered) - 1)
        low = ordered[int(pos)]
        want.append(low + (pos - int(pos)) * (ordered[min(int(pos) + 1, len(ordered) - 1)] - low))
    assert scale.exact_quantiles(df, "v", at, exact_distinct=bound) == pytest.approx(want)
