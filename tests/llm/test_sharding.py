"""Sharding by a permutation of row numbers."""

import zlib

import duckdb
import numpy as np
import pytest

from tidemark.llm import sharding

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 17, 64, 1000, 4097])
def test_permutation_and_its_inverse(n):
    p = sharding.Permutation(n)
    places = p.place(np.arange(n))
    assert sorted(places) == list(range(n))
    assert list(p.row(places)) == list(range(n))
    if n >= 1000:
        assert abs(np.corrcoef(np.arange(n), places)[0, 1]) < 0.1
        assert list(sharding.Permutation(n, 5).place(np.arange(n))) != list(places)


def test_large_domain_stays_exact():
    p = sharding.Permutation((1 << 61) + 12345)
    rows = np.random.default_rng(1).integers(0, p.n, 1000)
    assert (p.row(p.place(rows)) == rows).all() and (p.place(rows) < p.n).all()
    with pytest.raises(ValueError):
        sharding.Permutation(1 << 63)


ROWS = [(i, f"text {i % 7}", "x") for i in range(100)] + [(3, "other", "y"), (3, "other", "y"), (None, "z", "n"), (5, None, "m"),
                                                        (6, "", "m"), (7, "ü" * 50_000, "long")]
SCHEMA = "doc_id bigint, text string, shard string"


def brute(rows, shards):
    whole = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows]
    whole.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[1]))
    p = sharding.Permutation(len(whole)).place(np.arange(len(whole))) if whole else []
    return sorted((str(r[0]), r[1], r[2], int(x % shards), int(x // shards)) for r, x in zip(whole, p))


@pytest.mark.parametrize("shards", [1, 8, 200])
def test_assignment_does_not_depend_on_partitions(spark, shards):
    for parts in (1, 7):
        got = sharding.assign(spark.createDataFrame(ROWS, SCHEMA).repartition(parts), shards).collect()
        assert sorted((str(r.doc_id), r.size, r.text_crc32, r.shard, r.slot) for r in got) == brute(ROWS, shards)
        assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    sizes = [sum(r.shard == s for r in got) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_empty_table_and_bad_counts(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert sharding.assign(empty).count() == 0
    with pytest.raises(ValueError):
        sharding.assign(empty, 0)


def test_written_shards_come_back_in_slot_order(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    sharding.write_shards(docs, f"{tmp_path}/s", 4, file_rows=10)
    back = sharding.read_slots(spark, f"{tmp_path}/s", 2, 5, 9).collect()
    assert [r.slot for r in back] == list(range(5, 14))
    want = {(r.shard, r.slot): (r.doc_id, r.text_crc32) for r in sharding.assign(docs, 4).collect()}
    everything = spark.read.parquet(f"{tmp_path}/s").collect()
    assert {(r.shard, r.slot): (r.doc_id, zlib.crc32((r.text or "").encode())) for r in everything} == want


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.sql(sharding.OP11_SQL)
    got = sharding.op11_sharding(spark, SF)
    assert sorted(want.columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
