"""Near-duplicate operators and substring removal against brute force."""

import hashlib
import re
import string

import numpy as np
import pandas as pd
import pytest
import xxhash

from tidemark.llm import components, embedding_dedup, simhash_dedup, substring_dedup

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def groups_of(nodes, pairs):
    found = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(found[a], found[b])
            changed |= found[a] != low or found[b] != low
            found[a] = found[b] = low
    return found


def test_components_of_path_star_and_loop(spark):
    rng = np.random.default_rng(3)
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(500, i) for i in range(501, 540)]
    loose = [tuple(map(int, rng.integers(1000, 1060, 2))) for _ in range(40)]
    edges = path + star + loose + [(7, 7), (9, 8), (8, 9)]
    got = components.components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()
    want = groups_of({n for e in edges for n in e}, edges)
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert sorted((r.node, r.component) for r in got) == sorted((n, want[n]) for n in linked)
    empty = spark.createDataFrame([], "a bigint, b bigint")
    assert components.components(empty, "a", "b").count() == 0


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 8))
    rows = [v for b in base for v in (b, b + rng.normal(size=8) * 0.08, b * 3.0)]
    rows += [rng.normal(size=8) for _ in range(80)] + [rows[0]] * 5
    return [(i, [float(np.float32(x)) for x in v], "text") for i, v in enumerate(rows)]


def brute_vectors(rows, threshold):
    good = {
        i: np.array(v, float) for i, v, *_ in rows
        if v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float) != 0)
    }
    pairs = [
        (a, b) for a in good for b in good if a < b and len(good[a]) == len(good[b])
        and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= threshold
    ]
    found = groups_of([r[0] for r in rows], pairs)
    count = {r[0]: sum(r[0] in p for p in pairs) for r in rows}
    return sorted((i, count[i], found[i], found[i] == i) for i in found)


@pytest.mark.parametrize("cell_rows, block_rows", [(4096, 4096), (25, 10)])
def test_vectors_match_brute_force_in_any_plan(spark, vectors, cell_rows, block_rows):
    odd = [(900, None, ""), (901, [0.0] * 8, ""), (902, [float("nan")] * 8, ""), (903, [None, 1.0], ""),
           (904, [], ""), (905, [1.0, 2.0], ""), (906, [2.0, 4.0], ""), (907, [float("inf")] * 8, "")]
    df = spark.createDataFrame(vectors + odd, "vec_id bigint, embedding array<float>, n_links string")
    got = embedding_dedup.near_duplicates(df, cell_rows=cell_rows, block_rows=block_rows)
    assert got.columns == ["vec_id", "embedding", "n_links", "component_id", "kept"]
    rows = [tuple(r) for r in got.select("vec_id", "n_links", "component_id", "kept").collect()]
    assert sorted(rows) == brute_vectors(vectors + odd, 0.95)
    assert sum(r[1] for r in rows) > 0


def test_vectors_without_id_and_empty_table(spark):
    schema = "vec_id bigint, embedding array<float>"
    rows = [(None, [1.0, 0.0]), (4, [2.0, 0.0]), (None, [0.0, 1.0]), (None, None)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.n_links, r.component_id or -1, r.kept) for r in got) == [
        (0, -1, False), (0, -1, False), (1, 4, False), (1, 4, True)]
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def brute_fingerprint(text):
    found = WORD.findall((text or "").translate(LOWER))
    if not found:
        return 0
    shingles = [" ".join(found)] if len(found) < 3 else [" ".join(found[i : i + 3]) for i in range(len(found) - 2)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("blocks", [4, 6, 10, 14, 20])
def test_covering_code_is_odd_and_complete(blocks):
    lengths = simhash_dedup.block_lengths(blocks)
    assert sum(lengths) == 64 and len(lengths) == blocks and all(x % 2 for x in lengths)
    assert simhash_dedup.covering_radius(blocks) == sum(x // 2 for x in lengths)


@pytest.mark.parametrize("blocks, threshold", [(4, 2), (10, 2), (14, 2), (12, 3)])
def test_anchor_links_lose_nothing(spark, blocks, threshold):
    rng = np.random.default_rng(blocks)
    seeds = rng.integers(0, 1 << 63, 40)
    fps = {int(s) for s in seeds}
    for s in seeds:
        for k in range(1, 6):
            fps.add(int(s) ^ sum(1 << int(b) for b in rng.choice(63, k, replace=False)))
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    got = {(r.fp_a, r.fp_b) for r in simhash_dedup.links(df, threshold, blocks).collect()}
    want = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= threshold}
    assert got == want and want


def test_simhash_groups_match_brute_force(spark):
    rng = np.random.default_rng(11)
    vocabulary = ["".join(rng.choice(list("abcdEFÉß"), 4)) for _ in range(300)]
    texts = []
    for _ in range(25):
        doc = list(rng.choice(vocabulary, 150))
        changed = doc[:-1] + ["changed"]
        texts += [" ".join(doc), "\t".join(doc).upper(), " ".join(changed), "\n".join(doc[:2])]
    texts += ["", None, " \t\n", "one", "One", "one two", "İstanbul ÀB \x85 x"]
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    got = simhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string, fp string"))
    fps = {i: brute_fingerprint(t) for i, t, _ in rows}
    pairs = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    want = groups_of(fps, pairs)
    assert sorted(tuple(r) for r in got.collect()) == sorted((i, f"{fps[i]:016x}", want[i]) for i in fps)
    nobody = spark.createDataFrame([(None, "a b c"), (3, "a b c"), (3, "a b c"), (None, "z")], "doc_id bigint, text string")
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in simhash_dedup.near_duplicates(nobody).collect()) == [
        (-1, -1), (-1, 3), (3, 3), (3, 3)]
    assert simhash_dedup.near_duplicates(nobody.limit(0)).count() == 0


def test_fingerprint_of_a_very_long_text(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(5000))
    monkeypatch.setattr(simhash_dedup, "CHUNK", 1000)
    assert simhash_dedup.fingerprint_of(text.encode()) == brute_fingerprint(text)


def brute_repeats(rows, window):
    found = [(i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in found:
        if i is not None:
            for k in range(len(w) - window + 1):
                key = tuple(w[k : k + window])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, w in found:
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [6_000_000, 3_000])
def test_repeats_match_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", block_bytes)
    rng = np.random.default_rng(2)
    vocabulary = [f"{a}{b}" for a in "abcdefg" for b in ("x", "Y", "é.", "ou")]
    passage = list(rng.choice(vocabulary, 60))
    rows = []
    for i in range(60):
        doc = list(rng.choice(vocabulary, int(rng.integers(0, 120))))
        if i % 3 == 0:
            at, n = int(rng.integers(0, 30)), int(rng.integers(5, 30))
            doc[len(doc) // 2 : len(doc) // 2] = passage[at : at + n]
        rows.append((int(rng.integers(0, 1000)) * 100 + i, " \n".join(doc)))
    rows += [(100_000 + i, t) for i, (_, t) in enumerate(rows[:10])]
    rows += [(-5, "ha " * 40), (200_000, "ha " * 50), (None, rows[0][1]), (200_001, None), (200_002, ""),
             (200_003, " ".join(passage)), (200_003, " ".join(passage)), (200_003, " ".join(passage[5:40]))]
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id bigint, text string, kept string").repartition(5)
    got = substring_dedup.remove_repeats(df)
    assert got.columns == ["doc_id", "text", "n_words", "n_removed", "kept"]
    out = [(r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in got.collect()]
    assert sorted(out, key=str) == brute_repeats(rows, 13)
    assert sum(r[2] for r in out) > 300
    assert substring_dedup.remove_repeats(df.limit(0)).count() == 0


def test_windows_of_one_minimiser_are_told_apart_by_64_bits(monkeypatch):
    rolling = substring_dedup._rolling

    def collide(x, width):
        # Windows agree in the lower 32 bits and differ in the upper ones.
        return rolling(x, width) & np.uint64(0xFFFFFFFF00000000 if width == 13 else 0xFFFFFFFFFFFFFFFF)

    monkeypatch.setattr(substring_dedup, "_rolling", collide)
    starts = [" ".join(f"w{k}x{i}" for i in range(12)) for k in range(20)]
    texts = [f"{start} {end}".encode() for start in starts for end in ("one", "two", "two")]
    blocks = [pd.DataFrame({"id": [i], "mark": [i], "text": [t]}) for i, t in enumerate(texts)]
    blobs = pd.concat(substring_dedup._mapper(4, 13, 4)(iter(blocks)))
    paths = pd.concat([substring_dedup._reducer(4)(part) for _, part in blobs.groupby("bucket")])
    assert sorted(zip(paths["id"], paths["source"], paths["n"])) == [(3 * k + 2, 3 * k + 1, 1) for k in range(20)]


def test_guests_of_anchors_are_never_broadcast(spark):
    distinct = spark.range(3000).selectExpr("xxhash64(id DIV 2) ^ (id % 2) AS fp")
    near = simhash_dedup.links(distinct)
    assert near.count() == 1500
    assert "BroadcastExchange" not in near._jdf.queryExecution().executedPlan().toString()
