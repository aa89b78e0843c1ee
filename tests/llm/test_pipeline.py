"""Stages of the corpus pipeline against brute force."""

import re
import string

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from tidemark.llm.simhash_dedup import fingerprint_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def table_of(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], schema).repartition(4)


def brute_fingerprint(text):
    found = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(found[k : k + 3]) for k in range(max(1, len(found) - 2))] if found else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_near_distinct(rows):
    prints = [brute_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                group = [group[b] if g == group[a] else g for g in group]
    best = {}
    for g, (i, _) in zip(group, rows):
        if i is not None:
            best[g] = min(i, best.get(g, i))
    return sorted(best.values())


def brute_quality(text):
    found = WORD.findall(text or "")
    n = len(found)
    windows = [tuple(found[k : k + 3]) for k in range(n - 2)]
    repeated = {k + o for k, w in enumerate(windows) if windows.count(w) > 1 for o in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    letters = sum(map(len, found))
    return not (
        n < 50 or 100 * len(repeated) > 50 * n or 10 * sum(c in "#*$%&|<>" for c in text or "") > n
        or 2 * (len(lines) - len(set(lines))) > len(lines) or letters < 2 * n or letters > 25 * n
    )


def brute_passages(rows):
    first = {}
    for i, t in rows:
        found = WORD.findall(t or "")
        for k in range(len(found) - 12):
            w = tuple(found[k : k + 13])
            first[w] = min(i, first.get(w, i))
    out = []
    for i, t in rows:
        found = WORD.findall(t or "")
        gone = {k + o for k in range(len(found) - 12) if first[tuple(found[k : k + 13])] < i for o in range(13)}
        kept = [w for k, w in enumerate(found) if k not in gone]
        if kept or not gone:
            out.append((i, " ".join(kept) if gone else t))
    return out


@pytest.fixture(scope="module")
def planted():
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for base in range(20):
        doc = list(rng.choice(vocabulary, 220))
        for copy in range(4):
            other = list(doc)
            for at in rng.choice(220, copy, replace=False):
                other[at] = f"x{rng.integers(1000)}"
            rows.append((int(rng.integers(10**6)) * 100 + len(rows), " ".join(other)))
    passage = [str(x) for x in rng.choice(vocabulary, 60)]
    for k in range(12):
        body = list(rng.choice(vocabulary, 90))
        rows.append((10 + k, " ".join([*body[:40], *passage, *body[40:]])))
    rows += [(1000 + k, rows[0][1]) for k in range(40)]
    return rows


def test_near_distinct_matches_brute_force(spark, planted):
    rows = planted + [(50, "Short One"), (49, "short\none"), (47, ""), (46, None), (None, "nobody has this text at all")]
    rows += [(None, rows[0][1]), rows[3], rows[3], (5, "word " * 60_000)]
    got = corpus_pipeline.near_distinct(spark, table_of(spark, rows), "")
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id for r in got.collect()) == brute_near_distinct(rows)
    assert corpus_pipeline.near_distinct(spark, table_of(spark, rows).limit(0), "").count() == 0


def test_an_id_with_two_texts_stands_in_both_groups(spark):
    one, two = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    rows = [(7, one), (7, two), (7, two), (8, two), (3, one), (9, "c " * 9)]
    got = corpus_pipeline.near_distinct(spark, table_of(spark, rows), "").collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted([(3, one), (7, two), (9, "c " * 9)])


def test_fingerprint_matches_brute_force(planted):
    for _, text in planted[:20]:
        assert fingerprint_of(text.encode()) == brute_fingerprint(text)


def test_good_quality_matches_brute_force(spark, planted):
    line = "one line of text that repeats\n"
    rows = planted + [(1, None), (2, ""), (3, line * 20), (4, "a " * 80), (5, "$ " * 30 + planted[0][1]), (5, "few words")]
    rows += [planted[0], (6, "w" * 3000 + " " + planted[1][1]), (7, " ".join(f"n{i}" for i in range(20_000)))]
    got = corpus_pipeline.good_quality(spark, table_of(spark, rows), "")
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    want = [(i, t) for i, t in rows if (i == 7 or brute_quality(t))]
    assert sorted((r.doc_id, r.text) for r in got.collect()) == sorted(want)


def test_without_passages_matches_brute_force(spark, planted):
    rows = list(dict(planted).items()) + [(1, ""), (2, None), (3, "short text")]
    got = corpus_pipeline.without_passages(spark, table_of(spark, rows), "")
    assert sorted((r.doc_id, r.text or "") for r in got.collect()) == sorted((i, t or "") for i, t in brute_passages(rows))


def test_without_passages_removes_words_once(spark):
    """Run for the filter and again for the columns, the function takes two workers a task."""
    docs = table_of(spark, [(i, f"w{i} " + " ".join(f"v{k}" for k in range(30))) for i in range(4)])
    plan = corpus_pipeline.without_passages(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EvalPython [_removed(") == 1


def test_known_language_without_labels_keeps_texts_with_letters(spark, planted):
    rows = planted[:5] + [(1, "½ ② 12"), (2, ""), (3, None), (4, "é")]
    unlabelled = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    got = corpus_pipeline.known_language(spark, unlabelled, "")
    assert sorted(r.doc_id for r in got.collect()) == sorted([4, *[i for i, _ in planted[:5]]])
    labelled = corpus_pipeline.known_language(spark, table_of(spark, rows), "")
    assert labelled.columns == unlabelled.columns
    assert sorted(r.doc_id for r in labelled.collect()) == sorted([4, *[i for i, _ in planted[:5]]])


def test_stages_on_empty_tables(spark, planted):
    empty = table_of(spark, planted).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0


def test_packed_holds_every_token_once(spark, planted):
    rows = planted[:30] + [(2, ""), (3, None), (4, "long " * 9000)]
    got = corpus_pipeline.packed(spark, table_of(spark, rows), "").toPandas()
    for _, one in got.groupby("sequence_id"):
        one = one.sort_values("offset")
        assert list(one["offset"]) == [0, *one["length"].cumsum()[:-1]] and one["length"].sum() <= 4096
    for _, one in got.groupby("doc_id"):
        one = one.sort_values("piece")
        assert list(one["start"]) == [0, *one["length"].cumsum()[:-1]]


def test_run_equals_the_stages_by_brute_force(spark, planted, tmp_path):
    """Text of plain words in one language: every stage has a brute-force answer."""
    rows = list(dict(planted).items()) + [(1, None), (2, ""), (3, "1234 5678 " * 40), (4, "few words here")]
    table_of(spark, rows, SCHEMA + "").write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    letters = [(i, t) for i, t in rows if t and re.search(r"[a-z]", t)]
    good = [(i, t) for i, t in letters if brute_quality(t)]
    stay = set(brute_near_distinct(good))
    left = brute_passages([(i, t) for i, t in good if i in stay])
    assert sorted(set(got["doc_id"])) == sorted(i for i, _ in left)
