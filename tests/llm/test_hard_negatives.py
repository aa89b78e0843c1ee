"""Hard-negative mining against brute force."""

import math

import duckdb
import numpy as np
import pytest

from tidemark.llm import hard_negatives as hn

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, label int, rank string"


def brute(rows, every=50, k=5, m=3):
    good = {}
    for i, v, label, *_ in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in v]
        if sum(x * x for x in q) < 1 << 62:
            good[i] = min(good.get(i, (label, q)), (label, q))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, (label, q) in good.items():
        if a % every:
            continue
        scored = sorted((-dot(q, v), i, other == label) for i, (other, v) in good.items() if i != a)
        for s, p, _ in [x for x in scored if x[2]][:k]:
            inside = [(n, -t) for t, n, same in scored if not same and 50 * -s <= 100 * -t <= 95 * -s][:m]
            out += [(a, p, r, n, -s, t) for r, (n, t) in enumerate(inside, 1)]
    return sorted(out)


def rows_of(rng, n, width, labels=4, clustered=True):
    centres = rng.normal(size=(labels, width))
    out = []
    for i in range(n):
        label = int(rng.integers(labels))
        v = centres[label] * clustered + rng.normal(size=width)
        out.append((i, [float(np.float32(x)) for x in v / np.linalg.norm(v)], label, "x"))
    return out


@pytest.fixture(scope="module")
def planted():
    rng = np.random.default_rng(2)
    rows = rows_of(rng, 400, 6) + [(400 + i, r[1], r[2], "x") for i, r in enumerate(rows_of(rng, 200, 6, clustered=False))]
    rows += [(1000 + i, rows[3][1], (rows[3][2] + i % 2) % 4, "copy") for i in range(300)]
    rows += [(50, None, 1, "x"), (2000, [0.0] * 6, 1, "zero"), (2001, [], 2, "x"), (2050, [float("nan")] * 6, 1, "x"),
             (2051, [1.0, None, 0.0], 1, "x"), (2052, [float("inf")] + [0.0] * 5, 1, "x"), (2053, [1.0], None, "x"),
             (None, [1.0] * 6, 1, "x"), (2100, [0.5, 0.5], 3, "short"), (2150, [3e30] * 6, 1, "huge"),
             (2200, [float(1 << 20)] * 6, 1, "large"), (2201, [float(1 << 20)] * 6, 1, "large"), (2250, [-1.0] * 6, 0, "x")]
    return rows + rows[:30] + [(0, rows[5][1], rows[5][2], "again")]


def mined(df, **sizes):
    out = hn.mine(df, "id % 50 = 0", **sizes)
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 97, "block_anchors": 7}])
def test_mining_matches_brute_force(spark, planted, sizes):
    df = spark.createDataFrame(planted, SCHEMA).repartition(5)
    want = brute(planted)
    assert want and mined(df, **sizes) == want


def test_small_and_empty_tables(spark, planted):
    df = spark.createDataFrame(planted, SCHEMA)
    assert mined(df.limit(0)) == []
    assert mined(df.where("vec_id = 0")) == []
    assert mined(df.where("vec_id IS NULL OR label IS NULL")) == []


def test_a_walk_stops_early_and_misses_nothing():
    rng = np.random.default_rng(7)
    rows = rng.integers(-256, 256, size=(20_000, 3))
    lists, anchor = hn.SortedLists(rows), np.array([200, -150, 0])
    at, score = lists.walk(anchor, lambda t, at, s: len(s) >= 5 and t < np.sort(s)[-5])
    exact = rows @ anchor
    assert len(at) < 5_000 and (exact[at] == score).all()
    assert sorted(score)[-5:] == sorted(exact)[-5:]


def test_window_bounds():
    for s in range(-130, 130):
        low, high = hn.window(s, 50, 95)
        assert [t for t in range(-200, 200) if 50 * s <= 100 * t <= 95 * s] == list(range(low, high + 1))


def test_large_scores_stay_exact():
    rows = np.array([[1 << 30, 1], [1 << 30, 0]])
    at, score = hn.SortedLists(rows).walk(np.array([1 << 30, 1]), lambda *_: False)
    assert list(at) == [0, 1] and list(score) == [(1 << 60) + 1, 1 << 60]


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = con.sql(hn.OP13_SQL)
    got = hn.op13_hard_negatives(spark, SF)
    assert sorted(want.columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
    assert want.fetchall()
