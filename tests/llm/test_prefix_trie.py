"""The prefix trie against brute force."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest

from tidemark.llm import prefix_trie as trie

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn bigint, role string, text string, pos string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def ordered(rows):
    found = {}
    mark = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest()
    for c, turn, role, text, *_ in rows:
        if c is not None:
            found.setdefault(c, []).append((turn is not None, turn or 0, mark(role or "", text or ""), role or "", text or ""))
    return {c: [x[3:] for x in sorted(turns)] for c, turns in found.items()}


def grafted(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(conversations):
    members = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    saved = {k: (len(m) - 1) * (len(k[-1][1]) if k else 0) for k, m in members.items()}
    children = dict.fromkeys(members, 0)
    for k in members:
        if k:
            children[k[:-1]] += 1
    total, leaves = dict(saved), {k: int(n == 0) for k, n in children.items()}
    for k in sorted(members, key=len, reverse=True):
        if k:
            total[k[:-1]] += total[k]
            leaves[k[:-1]] += leaves[k]
    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(conversations[c]) == len(k))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], total[k],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def planted():
    rng = np.random.default_rng(9)
    say = lambda n=4: f"t{rng.integers(n)}" * int(rng.integers(1, 4))
    rows = []
    for c in [*range(60), 100, *range(105, 180), 399, 1000, 1001, -5, -100, -130]:
        for turn in range(int(rng.integers(1, 9))):
            rows.append((c, turn, ["user", "assistant"][turn % 2], say(), "x"))
    rows += [(2000 + i, t, "user", f"copy {t}", "x") for i in range(90) for t in range(7)]
    rows += [(3000 + i, t, "user", "common", "x") for i in range(40) for t in range(i % 8 + 1)]
    rows += [(4000, t, "log", f"{t % 50}", "x") for t in range(700)] + [(4001, t, "log", f"{t % 50}", "x") for t in range(300)]
    rows += [(7, 3, None, None, "x"), (7, None, "user", "null turn", "x"), (8, 2, "user", "tie", "x"), (8, 2, "b", "tie", "x"),
             (8, 2, "b", "tie", "x"), (None, 1, "user", "nobody", "x"), (5000, 0, "", "", "x"), (5001, 0, None, "", "x"),
             (5002, 0, "ab", "c", "x"), (5003, 0, "a", "bc", "x"), (5004, 0, "u", "é" * 40_000, "x"), (5098, 1, "a", "b", "x")]
    return rows


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


@pytest.mark.parametrize("cut", [{}, {"fan": 3, "band": 40, "shard_nodes": 50}])
def test_trie_matches_brute_force(spark, cut):
    rows = planted()
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    turns = trie.marked_turns(df)
    assert result(trie.prefix_trie(*trie.grafted(turns), **cut)) == brute(grafted(ordered(rows)))
    if not cut:
        assert result(trie.prefix_trie(turns, trie.lengths_of(turns))) == brute(ordered(rows))


def test_empty_table_and_turnless_conversations(spark):
    empty = trie.marked_turns(spark.createDataFrame([], SCHEMA))
    assert result(trie.prefix_trie(*trie.grafted(empty))) == []
    # CRC-32 of "7" modulo 6 decides how much is replaced; without a base nothing is lent.
    few = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 == 5)
    turns = trie.marked_turns(spark.createDataFrame([(few, 0, "user", "gone", "x")], SCHEMA))
    assert result(trie.prefix_trie(*trie.grafted(turns))) == brute({few: []})


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 40_000):
        keys = np.unique(rng.integers(0, 1 << 63, size=(n, 2), dtype=np.uint64), axis=0)
        slots = trie.SlotTable(keys)
        assert sorted(slots.slots(keys)) == list(range(len(keys)))
        if n:
            assert (slots.slots(keys ^ np.uint64(1)) == -1).all()
    with pytest.raises(ValueError):
        trie.SlotTable(np.zeros((2, 2), dtype=np.uint64))


def test_colliding_digests_are_found_and_built_anew(spark, monkeypatch):
    points = trie._points
    # At 0 only the last turn counts, so prefixes with the same last turn collide.
    monkeypatch.setattr(trie, "_points", lambda attempt: (0, 0) if attempt == 0 else points(attempt))
    rows = [(c, t, "user", "same" if t == 2 else f"{c % 3} {t}", "x") for c in range(9) for t in range(3)]
    turns = trie.marked_turns(spark.createDataFrame(rows, SCHEMA))
    lengths = trie.lengths_of(turns)
    assert result(trie.prefix_trie(turns, lengths)) == brute(ordered(rows))
    with pytest.raises(ValueError, match="collide"):
        trie.prefix_trie(turns, lengths, tries=1)


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    want = con.sql(trie.OP12_SQL)
    got = trie.op12_prefix_trie(spark, SF)
    assert sorted(want.columns) == sorted(got.columns)
    assert sorted(map(str, map(tuple, got.select(*want.columns).collect()))) == sorted(map(str, want.fetchall()))
