"""Chat formatting, coding, archives, languages, packing, quality rules and scores on small fixtures."""

import base64
import collections
import gzip
import hashlib
import itertools
import math
import re
import sys
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import chat_format, language_id, packing, piece_codec, ppm_scoring, quality_rules, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = ["", None, " ", "  two  spaces ", "▁a▁ b", "tabs\tand\nlines\r\n", "é😀 ﬁ ´   wide \xa0", "</s><s>[INST]", "don't we'll'S",
       "é İ Σας ΟΔΟΣ", "x" * 5000, "a,b.c!d word,word2 (in) ²x 1st!", "<|endoftext|> <unk>", "\x1c\x85 |ǅ ß."]


# -- chat --------------------------------------------------------------------------------------

def test_events_fold_into_final_messages(spark):
    log = [
        (1, 0, 0, "open", "user", None), (1, 0, 1, "delta", None, "he"), (1, 0, 2, "delta", None, "llo"),
        (1, 1, 3, "open", "assistant", "x"), (1, 1, 4, "delta", None, "draft"), (1, 2, 5, "open", "user", "gone"),
        (1, 1, 6, "regenerate", None, "ignored"), (1, 1, 7, "delta", None, "final"), (1, 2, 8, "open", "user", ""),
        (1, 2, 9, "delta", None, "again"), (1, 0, 10, "edit", None, "hi"), (1, 0, 11, "delta", None, "!"),
        (1, 0, 12, "unknown", None, "no"), (None, 0, 1, "delta", None, "lost"), (2, 1500, 1, "open", "user", "far"),
        (2, 0, 2, "regenerate", None, None),
    ]
    got = chat_format.fold(spark.createDataFrame(log, chat_format.EVENTS).repartition(4)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([
        (1, 0, "user", "hi!"), (1, 1, "assistant", "final"), (1, 2, "user", "again"), (None, 0, "", "lost"), (2, 0, "", ""),
    ], key=str)
    assert chat_format.fold(spark.createDataFrame([], chat_format.EVENTS)).count() == 0


def test_chat_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", r"<\/s> [\\INST] <s>", None, "", "a\nb😀", "[INST]" * 3, "x" * 700]
    roles = ["user", "assistant", None, "</s>", "assistant"]
    rows = [(c, t, roles[(c + t) % 5], texts[(c * 3 + t) % 7]) for c in range(6) for t in range(70 + c)]
    rows += [(7, None, "user", "n"), (7, 2, "assistant", "dup"), (7, 2, "assistant", "dup"), (7, 2, "assistant", "a"),
             (None, 0, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    pieces = chat_format.render(chat_format.fold(chat_format.row_events(df, 100)), piece_turns=16)
    got = {r.conv_id: r for r in chat_format.summarise(chat_format.parse(pieces)).collect()}
    null_first = lambda x: (x is not None, x or 0)
    for conv in {r[0] for r in rows}:
        own = sorted(((t, r or "", x or "") for c, t, r, x in rows if c == conv), key=lambda y: (null_first(y[0]), y[1:]))
        said = "".join(f"{r}\n{x}\n" for _, r, x in own)
        loss = "".join(x for _, r, x in own if r == "assistant")
        r = got[conv]
        assert r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    texts = [r.formatted for r in pieces.where("conv = 0").orderBy("piece").collect()]
    assert "".join(texts).startswith("<s>[INST]") and sum(t.count("<s>") for t in texts) == 1
    assert chat_format.summarise(chat_format.parse(chat_format.render(chat_format.fold(
        chat_format.row_events(df.limit(0)))))).count() == 0


# -- coding and packing ------------------------------------------------------------------------

def test_pieces_equal_the_library(spark, monkeypatch):
    monkeypatch.setattr(piece_codec, "BLOCK_BYTES", 3000)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(piece_codec.MODEL))
    rng = np.random.default_rng(1)
    letters = list(" ab  Té.\n▁😀<>9\t")
    texts = ODD + ["".join(rng.choice(letters, 60)) for _ in range(200)] + [" ".join(["long"] * 3000)]
    rows = [(i, t, "clash") for i, t in enumerate(texts)]
    got = piece_codec.encode_and_decode(spark.createDataFrame(rows, "doc_id bigint, text string, ids string"))
    assert got.columns == ["doc_id", "ids", "decoded"]
    for r in got.collect():
        want = library.encode(texts[r.doc_id] or "")
        assert r.ids == want
        assert r.decoded == library.decode(want)
    assert piece_codec.encode_and_decode(got.select("doc_id", F.lit("a").alias("text")).limit(0)).count() == 0


def test_word_ids_equal_the_library(monkeypatch):
    model = public_tokenizers.path(packing.MODEL)
    library = Tokenizer.from_file(model)
    rng = np.random.default_rng(4)
    letters = list(" aB,.é'|sST1²́ΣÀ\n#İ ")
    texts = [t or "" for t in ODD] + ["".join(rng.choice(letters, 50)) for _ in range(400)]
    monkeypatch.setattr(packing, "TABLE_LIMIT", 50)
    got = packing._ids_of(model, texts)
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_words_of_a_block_are_not_handled_one_by_one(monkeypatch):
    # A Python call for every new word was a good part of the CPU time.
    monkeypatch.setattr(packing, "_TABLES", {})
    model = public_tokenizers.path(packing.MODEL)
    library = Tokenizer.from_file(model)
    rng = np.random.default_rng(5)
    stems = ["".join(rng.choice(list("abcdeé"), 7)) for _ in range(2000)]
    text = " ".join(s + e for s in stems for e in ("", ".", "###"))
    packing._ids_of(model, ["start"])
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event == "call"

    sys.setprofile(count)
    try:
        ids = packing._ids_of(model, [text])[0]
    finally:
        sys.setprofile(None)
    assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert calls < 1000


def test_word_ids_stay_right_when_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(packing, "_TABLES", {})
    monkeypatch.setattr(packing, "TABLE_LIMIT", 60)
    monkeypatch.setattr(packing, "LONG", 9, raising=False)
    model = public_tokenizers.path(packing.MODEL)
    library = Tokenizer.from_file(model)
    rng = np.random.default_rng(7)
    letters = list("abcé.#'<|>\xa0 1\u0301")
    often = ["the", "of.", "a<|endoftext|>", "x\xa0y", "\u3000a.b\u2028\x85c", "déjà##", "\x1c"]
    for _ in range(30):
        block = [" ".join(["".join(rng.choice(letters, 6)) for _ in range(8)] + often[: rng.integers(7)]) for _ in range(4)]
        for text, ids in zip(block, packing._ids_of(model, block)):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_fullest_combination_matches_brute_force():
    rng = np.random.default_rng(6)
    for _ in range(60):
        items = [int(x) for x in rng.integers(1, 30, 8)]
        counts = dict(collections.Counter(items))
        room = int(rng.integers(1, 70))
        chosen = packing.fullest(counts, sorted(counts, reverse=True), room)
        best = max(s for n in range(9) for c in itertools.combinations(items, n) if (s := sum(c)) <= room)
        assert sum(k * n for k, n in chosen) == best
        assert all(n <= counts[k] for k, n in chosen)


def test_packing_places_every_piece_once(spark):
    rng = np.random.default_rng(8)
    rows = [(i, "word " * int(rng.integers(0, 90)), 1) for i in range(120)]
    rows += [(500, "long text " * 300, 1), (501, None, 1), (501, None, 1), (None, "no id", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, piece int").repartition(7)
    got = packing.pack_documents(df, capacity=64).toPandas()
    total = 0
    for _, own in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert own["offset"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]]
        assert own["length"].sum() <= 64
        total += own["length"].sum()
    long = got[got["doc_id"] == 500].sort_values("piece")
    assert long["length"].tolist() == [64] * 9 + [25] and long["start"].tolist() == [64 * i for i in range(10)]
    # One token a word and the end; the long text is one piece of ten.
    assert len(got) == sum(-(-(len((t or '').split()) + 1) // 64) for _, t, _ in rows)
    assert got["sequence_id"].nunique() <= -(-total // 64) + 1
    end = got[got["doc_id"] == 501]
    assert end["ids_crc32"].tolist() == [zlib.crc32((1).to_bytes(4, "little"))] * 2
    assert packing.pack_documents(df.limit(0)).count() == 0


# -- archives ----------------------------------------------------------------------------------

def test_arc_versions_and_damage():
    body = b"HTTP/1.1 200 OK\r\nX: 1\r\n\r\npay\nload"
    for version in (1, 2):
        data = b"\n".join([warc.arc_start(version, "20240101000000"), warc.arc_record(version, "http://a/b", body, "202401020304"),
                           warc.arc_record(version, "dns:x", b"", "bad")])
        found = list(warc.parse_arc(data))
        assert [f["url"] for f, _ in found] == ["http://a/b", "dns:x"] and bytes(found[0][1]) == body
        assert warc.iso_date(found[0][0]["date"]) == "2024-01-02T03:04:00Z"
        with pytest.raises(ValueError, match="cut short"):
            list(warc.parse_arc(data[: data.index(b"pay")]))
    with pytest.raises(ValueError, match="version block"):
        list(warc.parse_arc(warc.arc_record(1, "http://a", b"x", "20240101000000")))
    assert list(warc.parse_arc(b"")) == []


def test_pages_round_trip_as_warc(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 3000)
    html = ["<p>a</p>", "", None, "x\r\n\r\nWARC/1.1\r\n", "é" * 50, "<p>a</p>", "y" * 9000, "\n\n"]
    rows = [(i, None if i == 3 else f"http://h/{i} b\n", html[i % 8], "z") for i in range(40)] + [(None, "u", "<p>a</p>", "z")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, n string").repartition(3)
    got = {r.page_id: r for r in warc.pages_to_warc(df, str(tmp_path / "w")).collect()}
    first = {}
    for i, _, h, _ in rows:
        if i is not None:
            first.setdefault(h or "", i)
    for i, _, h, _ in rows:
        data, r = (h or "").encode(), got[i]
        assert (r.payload_bytes, r.payload_digest) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        again = first[h or ""] != i
        assert (r.record_type, r.refers_to) == (("revisit", first[h or ""]) if again else ("response", None))
    files = list((tmp_path / "w").glob("part-*"))
    assert len(files) > 3
    for f in files:
        data = gzip.decompress(f.read_bytes())
        assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")
    least = warc.pages_to_warc(df, str(tmp_path / "v"), least_bytes=100)
    assert least.where("record_type = 'revisit' AND payload_bytes < 100").count() == 0
    assert warc.pages_to_warc(df.limit(0), str(tmp_path / "e")).count() == 0


# -- languages, rules, scores ------------------------------------------------------------------

SYLLABLES = {"en": "the and ing tion er wh", "de": "ung der sch ß ei ver", "fr": "é le eau ç ent ou", "es": "ñ que ción el ado os"}


def languages(spark, n=60):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(n * 4):
        lang = list(SYLLABLES)[i % 4]
        text = " ".join("".join(rng.choice(SYLLABLES[lang].split(), 3)) for _ in range(30))
        rows.append((i, text, lang, "a"))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string").repartition(3)


def test_languages_on_held_out_rows(spark):
    df = languages(spark)
    model = language_id.fit(language_id.learning_rows(df))
    assert model.families == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    got = language_id.predict(df, model)
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    held_out = got.where("crc32(cast(doc_id as string)) % 3 = 1")
    assert held_out.where("lang = lang_pred").count() >= 0.97 * held_out.count() > 0
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (4, "the " * 100_000)], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in language_id.predict(odd, model).collect()}
    assert [rows[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and rows[4].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert language_id.predict(odd.limit(0), model).count() == 0
    nothing = language_id.fit(df.limit(0))
    assert language_id.predict(odd, nothing).where("lang_pred <> 'und'").count() == 0


def brute_language(model, text):
    """Family and language by plain counting of byte grams and pairwise votes."""
    if not any(unicodedata.category(c).startswith("L") for c in text or ""):
        return "und"
    raw = text.encode("utf-8", "replace")
    plain = b" " + bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in raw) + b" "
    shift, half = 32 - language_id.RANGE_BITS, 1 << language_id.RANGE_BITS
    places = []
    for i in range(len(plain) - 2):
        two, three = plain[i] << 8 | plain[i + 1], (plain[i] << 8 | plain[i + 1]) << 8 | plain[i + 2]
        places += [(two * 2654435761 & 0xFFFFFFFF) >> shift, ((three * 2246822519 & 0xFFFFFFFF) >> shift) + half]
    margins = [sum(model.weights[p, k] for p in places) * language_id.SCALE / max(len(places), 1) + model.bias[k]
               for k in range(len(model.machines))]

    def vote(names, kind):
        own = {(a, b): margins[i] for i, (k, a, b) in enumerate(model.machines) if k == kind}
        wins = lambda n: sum((m > 0) if a == n else (-m > 0) for (a, b), m in own.items() if n in (a, b))
        total = lambda n: sum(m if a == n else -m for (a, b), m in own.items() if n in (a, b))
        return max(sorted(names), key=lambda n: (wins(n), total(n)))

    family = vote(list(model.families), "")
    return vote(model.families[family], family)


def test_languages_equal_brute_force_votes(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.fit(language_id.learning_rows(df), sample_rows=40)
    odd = [(1, "½ ² Ⅷ ② 1234 _ ٣"), (2, "ª"), (3, "ªº½"), (4, "日本"), (5, None), (6, ""), (7, "!?"), (8, "ß"), (9, "a" * 30_000)]
    rows = [tuple(r) for r in df.limit(40).select("doc_id", "text").collect()] + [(1000 + i, t) for i, t in odd]
    got = {r.doc_id: r.lang_pred for r in language_id.predict(spark.createDataFrame(rows, "doc_id bigint, text string"), model).collect()}
    assert got == {i: brute_language(model, t) for i, t in rows}
    assert [got[1000 + i] for i in (1, 5, 6, 7)] == ["und"] * 4 and got[1002] != "und"


def test_repeated_texts_enter_the_language_sample_once(spark):
    df = languages(spark, 20)
    hot = df.where("lang IS NOT NULL").limit(1).crossJoin(spark.range(300)).select(*df.columns)
    once = language_id.fit(df, sample_rows=10**6)
    more = language_id.fit(df.unionByName(hot), sample_rows=10**6)
    assert once.machines == more.machines
    assert np.allclose(once.weights, more.weights, atol=1e-6) and np.allclose(once.bias, more.bias, atol=1e-6)


def test_copies_do_not_thin_the_language_sample(spark):
    df = languages(spark, 60).where("lang IN ('en', 'es')")
    # Spanish is rare: four texts, a thousand copies each.
    rare = df.where("lang = 'es'").orderBy("doc_id").limit(4)
    copies = rare.crossJoin(spark.range(1000)).select(*df.columns)
    others = df.where("lang <> 'es'")
    few = language_id.fit(others.unionByName(rare), sample_rows=20)
    more = language_id.fit(others.unionByName(copies), sample_rows=20)
    assert few.machines == more.machines
    assert np.allclose(few.weights, more.weights, atol=1e-6) and np.allclose(few.bias, more.bias, atol=1e-6)
    found = language_id.predict(df.where("lang = 'es'"), more)
    assert found.where("lang_pred = 'es'").count() >= 54


def brute_rules(text):
    text = text or ""
    found = WORD.findall(text)
    windows = list(zip(found, found[1:], found[2:]))
    count = collections.Counter(windows)
    covered = {k + o for k, w in enumerate(windows) if count[w] > 1 for o in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)),
            len(covered))


def test_quality_measurements_match_brute_force(spark):
    rng = np.random.default_rng(12)
    texts = ODD + [" ".join(rng.choice(list("abcd"), int(rng.integers(0, 60)))) for _ in range(150)]
    texts += ["x y\nx y\n \nx y", "|#*$%&<> é\n" * 5, "w " * 3000, "a b c a b c", "a a a a"]
    rows = [(i, t, -1) for i, t in enumerate(texts)] + [(None, "q", -1)]
    got = quality_rules.ledger(spark.createDataFrame(rows, "doc_id bigint, text string, n_words int"))
    for r in got.collect():
        want = brute_rules(r.text)
        assert tuple(r[m] for m in quality_rules.MEASURES) == want, r.text
        assert bool(r.failed & quality_rules.BASE) == (want[0] < 50 or 100 * want[5] > 50 * want[0])
    kept = got.where(quality_rules.verdict("base")).count()
    table = {r.rule: r for r in quality_rules.ablations(got, "base").collect()}
    assert set(table) == {"too_few_words", "repeated_windows"} and table["too_few_words"].kept == kept
    assert table["too_few_words"].kept_without == got.where("failed & 2 = 0").count()
    assert quality_rules.ledger(got.select("doc_id", "text").limit(0)).count() == 0


def slow_ppm(trie, context, symbol):
    """Escape and exclusion, step by step, from the same counts."""
    p, excluded = 1.0, set()
    for order in range(len(context), -1, -1):
        seen = trie.get(context[len(context) - order :], {})
        counts = {k: c for k, c in seen.items() if k not in excluded}
        if not counts:
            continue
        whole = sum(counts.values()) + len(counts)
        if symbol in counts:
            return p * counts[symbol] / whole
        p *= len(counts) / whole
        excluded |= set(counts)
    return p / (256 - len(excluded))


def ppm_trie(texts):
    order, trie = ppm_scoring.ORDER, collections.defaultdict(collections.Counter)
    for t in texts:
        x = ppm_scoring.START + t.lower() + ppm_scoring.END
        for at in range(order, len(x)):
            for k in range(order + 1):
                trie[x[at - k : at]][x[at]] += 1
    return trie


def test_predictions_follow_escape_and_exclusion():
    rng = np.random.default_rng(14)
    texts = [bytes(rng.integers(97, 101, 80).astype(np.uint8)) for _ in range(6)]
    trie, size = ppm_trie(texts), ppm_scoring.ORDER
    trigrams = collections.Counter()
    for c, symbols in trie.items():
        if len(c) == 2:
            trigrams.update({c[0] << 16 | c[1] << 8 | k: n for k, n in symbols.items()})
    keys = np.array(sorted(trigrams))
    contexts = [c for c in trie if len(c) == size][:40] + [bytes(rng.integers(96, 104, size).astype(np.uint8)) for _ in range(40)]
    asked = {(c, k) for c in contexts for k in range(256)} | {(c, k) for c in trie if len(c) == size for k in trie[c]}
    asked = sorted((int.from_bytes(c + bytes([k]), "big"), c, k) for c, k in asked)
    grams = np.array([g for g, _, _ in asked])
    n = np.array([trie.get(c, {}).get(k, 0) for _, c, k in asked])
    got = ppm_scoring.predictions(grams, n, keys, np.array([trigrams[k] for k in keys.tolist()]))
    for (_, c, k), p in zip(asked, got):
        assert math.isclose(p, slow_ppm(trie, c, k), rel_tol=1e-9)
    whole = collections.Counter()
    for (_, c, _), p in zip(asked, got):
        whole[c] += p
    assert all(math.isclose(whole[c], 1, rel_tol=1e-9) for c in contexts)


@pytest.mark.parametrize("block_bytes", [6_000_000, 500])
def test_scores_match_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(ppm_scoring, "BLOCK_BYTES", block_bytes)
    rng = np.random.default_rng(15)
    texts = ODD + [" ".join(rng.choice(["The", "cat", "é", "sat", "x\ty"], 20)) for _ in range(60)]
    rows = [(i, t, "c") for i, t in enumerate(texts)] + [(None, "the cat", "c"), (3, texts[3], "c")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, score string").repartition(3)
    got = ppm_scoring.score(df, F.col("doc_id") % 3 != 0).collect()
    split = lambda t: [w.encode().lower() for w in WORD.findall(t or "")] + [None]
    counts = collections.Counter(w for i, t, _ in rows if i is not None and i % 3 for w in split(t))
    total, size = sum(counts.values()), len(counts)
    want = sorted((-1 if i is None else i, len(split(t)), sum(counts[w] > 0 for w in split(t)),
                   round(sum(math.log10((counts[w] + 1) / (total + size + 1)) for w in split(t)), 6)) for i, t, _ in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {total}
    trie = ppm_trie([(t or "").encode() for i, t, _ in rows if i is not None and i % 3])

    def whole(text):
        x, size = ppm_scoring.START + (text or "").encode().lower() + ppm_scoring.END, ppm_scoring.ORDER
        return sum(math.log10(slow_ppm(trie, x[at - size : at], x[at])) for at in range(size, len(x)))

    want = sorted((-1 if i is None else i, whole(t)) for i, t, _ in rows)
    for (_, w), (_, g) in zip(want, sorted((-1 if r.doc_id is None else r.doc_id, r.score) for r in got)):
        assert math.isclose(w, g, rel_tol=1e-5)
    assert ppm_scoring.score(df.limit(0), F.lit(True)).count() == 0
    none = ppm_scoring.score(df, F.lit(False)).collect()
    assert len(none) == len(rows) and {(r.train_tokens, r.n_known) for r in none} == {(0, 0)}
