"""Language-model scores by prediction by partial matching, beside a smoothed unigram of words.

The model is a trie of byte contexts of length 0 to ``ORDER``. A symbol is predicted by the longest known context; a
context that has not seen it escapes (the number of its distinct symbols against its count) to the next shorter one, where
the symbols it had seen are excluded. Symbols are all bytes, lower-cased in A-Z, and an end mark. Counts come from all
training texts.

The trie is not held anywhere as a whole. Blocks of documents send their distinct grams (context and symbol) with the
number of training occurrences to hash buckets of the last three context bytes, so that a bucket has every context
that ends in them; it returns one log-probability per gram. Only the counts of byte trigrams, which give contexts of up
to two bytes, are shared by all tasks. The unigram needs the corpus count of every word, which travels the same
way. A frequent word or gram is one entry per block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import crc_class, pack, slices, small_batches, table, text_bytes, unpack

#: Longest context in bytes; a gram and its context fit 64 bits up to 6.
ORDER = 5
START = b"\n" * ORDER
END = b"\xff"  # never part of UTF-8
BLOCK_BYTES = 6_000_000
BUCKET_BYTES = 12_000_000
#: Positions that are looked at together.
CHUNK = 1 << 21
#: Offset that tells returned grams from returned words.
GRAMS = 1 << 40
LN10 = np.log(10)


# -- grams -------------------------------------------------------------------------------------

def _stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, each behind its start marks and before an end mark, and what each text has to predict."""
    joined = b"".join(START + t.lower() + END for t in texts)
    return np.frombuffer(joined, np.uint8), np.array([len(t) + 1 for t in texts], np.int64)


def _windows(stream: np.ndarray, sizes: np.ndarray, order: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks of the grams of all predicted positions, with the number of their text."""
    order = ORDER if order is None else order
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + ORDER)
    starts = np.cumsum(sizes + ORDER) - (sizes + ORDER)
    predicted = np.ones(len(stream), bool)
    for i in range(ORDER):
        predicted[starts + i] = False
    for at in range(ORDER, len(stream), CHUNK):
        stop = min(at + CHUNK, len(stream))
        gram = np.zeros(stop - at, np.int32 if order < 3 else np.int64)
        for back in range(order, -1, -1):
            gram <<= 8
            gram |= stream[at - back : stop - back]
        keep = predicted[at:stop]
        yield gram[keep], doc[at:stop][keep]


def _numbered(stream: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct grams in order, and of every predicted position the number of its gram and of its text."""
    parts = [(*pd.factorize(gram), doc) for gram, doc in _windows(stream, sizes)]
    grams = np.sort(np.concatenate([np.zeros(0, np.int64), *(own for _, own, _ in parts)]))
    grams = grams[np.diff(grams, prepend=-1) != 0]
    none = np.zeros(0, np.int32)
    number = np.concatenate([none, *(np.searchsorted(grams, own).astype(np.int32)[at] for at, own, _ in parts)])
    return grams, number, np.concatenate([none, *(doc for _, _, doc in parts)])


def _gram_buckets(grams: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of grams by bucket, and where each bucket starts in it."""
    mixed = ((grams >> 8) & 0xFFFFFF) * 0x9E3779B1 & 0xFFFFFFFF
    bucket = (mixed >> 8) % buckets
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def trigram_counts(training: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and counts of the byte trigrams of all training texts; at most 2^24, whatever the corpus."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 24, np.int64)
        for batch in batches:
            texts = [t or b"" for t in batch.column(0).to_pylist()]
            for start, stop in slices([len(t) for t in texts], BLOCK_BYTES):
                for gram, _ in _windows(*_stream(texts[start:stop]), order=2):
                    own, times = np.unique(gram, return_counts=True)
                    total[own] += times
        at = np.flatnonzero(total)
        for part in range(0, len(at), 1 << 18):
            some = at[part : part + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["gram", "n"])

    found = training.mapInArrow(run, "gram int, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    grams = found["gram"].to_numpy()
    order = np.argsort(grams)
    return grams[order].astype(np.int64), found["n"].to_numpy()[order].astype(np.int64)


# -- the model ---------------------------------------------------------------------------------

class Level:
    """Grams of one order, sorted, with their counts and predictions.

    ``fresh`` is the prediction of a context that is entered first, ``after`` that of the context's suffixes once it
    has escaped, which excludes the symbols it has seen. ``total`` and ``distinct`` belong to the context.
    """

    def __init__(self, keys, n, total, distinct, after, fresh):
        self.keys, self.n, self.total, self.distinct, self.after, self.fresh = keys, n, total, distinct, after, fresh


def lowest(n: np.ndarray) -> Level:
    """Symbols without a context; those never seen share the escape alike."""
    seen, total = n > 0, float(n.sum())
    distinct = int(seen.sum())
    after = np.full(256, 1.0 / max(256 - distinct, 1))
    mass = total + distinct
    fresh = np.where(seen, n / mass, distinct / mass * after) if mass else np.full(256, 1.0 / 256)
    return Level(np.arange(256), n.astype(float), np.full(256, total), np.full(256, distinct), after, fresh)


def longer(short: Level, keys: np.ndarray, n: np.ndarray, order: int) -> Level:
    """The grams ``keys`` of contexts one longer; the suffix of each is in ``short``, and contexts are complete."""
    at = np.searchsorted(short.keys, keys & ((1 << 8 * order) - 1))
    group = np.cumsum(np.diff(keys >> 8, prepend=-1) != 0) - 1
    seen, n = n > 0, n.astype(float)
    per_context = lambda x: np.bincount(group, weights=x)[group] if len(group) else np.zeros(0)
    total, distinct = per_context(n), per_context(seen)
    suffix = short.n[at]
    new = short.distinct[at] - distinct
    whole = short.total[at] - per_context(np.where(seen, suffix, 0.0)) + new
    some = np.maximum(whole, 1)
    after = np.where(suffix > 0, suffix / some, np.where(whole > 0, new / some, 1.0) * short.after[at])
    mass = total + distinct
    fresh = np.where(mass > 0, np.where(seen, n, distinct * after) / np.maximum(mass, 1), short.fresh[at])
    return Level(keys, n, total, distinct, after, fresh)


def predictions(grams: np.ndarray, n: np.ndarray, trigrams: np.ndarray, trigram_n: np.ndarray) -> np.ndarray:
    """Probability of the symbol of every gram after its context.

    ``grams`` are sorted and distinct, with their training counts, and hold all grams of the corpus whose
    contexts end in the same three bytes; ``trigrams`` holds those of the whole corpus.
    """
    level = lowest(np.bincount(trigrams & 0xFF, weights=trigram_n, minlength=256))
    pairs = np.bincount(trigrams & 0xFFFF, weights=trigram_n, minlength=1 << 16)
    level = longer(level, np.arange(1 << 16), pairs, 1)
    for order in range(2, ORDER + 1):
        keys, at = np.unique(grams & ((1 << 8 * (order + 1)) - 1), return_inverse=True)
        counts = np.bincount(at, weights=n, minlength=len(keys))
        if order == 2:
            keys = np.union1d(trigrams, keys)
            counts = np.zeros(len(keys))
            counts[np.searchsorted(keys, trigrams)] = trigram_n
        level = longer(level, keys, counts, order)
    return level.fresh


# -- blocks and buckets ------------------------------------------------------------------------

def _words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, the number of each word of all texts, and the words of each text."""
    known: dict[bytes, int] = {}
    number = lambda w: known.setdefault(w, len(known))
    found = [np.fromiter(map(number, t.lower().split()), np.int32) for t in texts]
    sizes = np.array([len(x) for x in found], np.int64)
    return list(known), np.concatenate([np.zeros(0, np.int32), *found]), sizes


def _word_buckets(known: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of words, their order by bucket, and where each bucket starts in it."""
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in known), np.uint64, len(known))
    bucket = (hashes >> np.uint64(33)).astype(np.int64) % buckets
    order = np.lexsort((hashes, bucket))
    return hashes, order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _block(texts: list[bytes], learned: np.ndarray, buckets: int) -> Iterator[tuple[int, int, bytes]]:
    """(bucket, start, blob) of the distinct words and grams; buckets of grams follow those of words."""
    known, words, sizes = _words(texts)
    doc = np.repeat(np.arange(len(texts)), sizes)
    trained = np.bincount(words, weights=learned[doc], minlength=len(known)).astype(np.int64)
    hashes, order, cuts = _word_buckets(known, buckets)
    checks = np.fromiter((zlib.crc32(w) for w in known), np.uint32, len(known))
    for b in range(buckets):
        own = order[cuts[b] : cuts[b + 1]]
        if len(own):
            yield b, int(cuts[b]), pack(hashes[own], checks[own], trained[own])
    grams, number, doc = _numbered(*_stream(texts))
    trained = np.bincount(number, weights=learned[doc], minlength=len(grams)).astype(np.int64)
    order, cuts = _gram_buckets(grams, buckets)
    for b in range(buckets):
        own = order[cuts[b] : cuts[b + 1]]
        if len(own):
            small = np.uint16 if trained[own].max() < 1 << 16 else np.int64
            blob = pack(np.diff(grams[own], prepend=0), trained[own].astype(small))
            yield buckets + b, GRAMS + int(cuts[b]), zlib.compress(blob, 1)


BLOCKS = "block bigint, bucket bigint, start bigint, blob binary, info binary"


def _mapper(buckets: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for pdf in batches:
            texts = [t if t is not None else b"" for t in pdf["text"]]
            for start, stop in slices([len(t) for t in texts], BLOCK_BYTES):
                part, own = pdf.iloc[start:stop], texts[start:stop]
                learned = part["learned"].to_numpy(bool)
                rows = [(block, b, at, blob, None) for b, at, blob in _block(own, learned, buckets)]
                info = pack(part["id"].to_numpy(np.int64), part["has_id"].to_numpy(bool), learned)
                # The texts wait for the answers.
                rows.append((block, 2 * buckets + block, 0, zlib.compress(pack(own), 1), info))
                yield pd.DataFrame(rows, columns=["block", "bucket", "start", "blob", "info"])
                block += 1

    return run


def _merged_words(pdf: pd.DataFrame) -> list[tuple]:
    parts = [unpack(b) for b in pdf["blob"]]
    hashes, checks, n = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((checks, hashes))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order[1:]] != hashes[order[:-1]]) | (checks[order[1:]] != checks[order[:-1]])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    total = np.bincount(group, weights=n).astype(np.int64)
    counts = total[group]
    at, rows = 0, []
    for (own, _, _), block, start in zip(parts, pdf["block"], pdf["start"]):
        rows.append((block, 0, start, pack(counts[at : at + len(own)]), None))
        at += len(own)
    # The bucket's share of the vocabulary travels as a block of its own.
    rows.append((-1 - int(pdf["bucket"].iloc[0]), 0, 0, pack(np.array([(total > 0).sum(), total.sum()])), None))
    return rows


def _merged_grams(pdf: pd.DataFrame, trigrams: tuple[np.ndarray, np.ndarray]) -> list[tuple]:
    parts = [unpack(zlib.decompress(b)) for b in pdf["blob"]]
    sizes = [len(own) for own, _ in parts]
    grams, group = np.unique(np.concatenate([np.cumsum(own) for own, _ in parts]), return_inverse=True)
    n = np.bincount(group, weights=np.concatenate([n for _, n in parts]))
    logs = np.log(np.maximum(predictions(grams, n, *trigrams), 1e-300)).astype(np.float32)[group]
    ends = np.cumsum(sizes)
    return [
        (block, 0, start, pack(logs[end - size : end]), None)
        for block, start, size, end in zip(pdf["block"], pdf["start"], sizes, ends)
    ]


def _reducer(trigrams_ref, buckets: int):
    names = ["block", "bucket", "start", "blob", "info"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        bucket = pdf["bucket"].iloc[0]
        if bucket >= 2 * buckets:
            return pdf[names]
        rows = _merged_words(pdf) if bucket < buckets else _merged_grams(pdf, trigrams_ref.value)
        return pd.DataFrame(rows, columns=names)

    return run


DOCS = "id bigint, has_id boolean, learned boolean, n_words bigint, n_known bigint, logs double, score double, vocabulary bigint, trained bigint"


def _finisher(buckets: int):
    names = [c.split()[0] for c in DOCS.split(", ")]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["block"].iloc[0] < 0:
            vocabulary, trained = unpack(pdf["blob"].iloc[0])[0]
            row = (0, False, False, 0, 0, 0.0, 0.0, int(vocabulary), int(trained))
            return pd.DataFrame([row], columns=names)
        home = pdf[pdf["info"].notna()].iloc[0]
        ids, has_id, learned = unpack(home["info"])
        texts = unpack(zlib.decompress(home["blob"]))[0]
        back = pdf[pdf["info"].isna()].sort_values("start")

        def answers(rows: pd.DataFrame, order: np.ndarray, kind) -> np.ndarray:
            out = np.empty(len(order), kind)
            out[order] = np.concatenate([np.zeros(0, kind), *(unpack(b)[0] for b in rows["blob"])])
            return out

        known, words, n_words = _words(texts)
        counts = answers(back[back["start"] < GRAMS], _word_buckets(known, buckets)[1], np.int64)[words]
        doc = np.repeat(np.arange(len(texts)), n_words)
        sums = lambda x, d: np.bincount(d, weights=x, minlength=len(texts))
        grams, number, of = _numbered(*_stream(texts))
        logs = answers(back[back["start"] >= GRAMS], _gram_buckets(grams, buckets)[0], np.float32)
        score = sums(logs[number], of)
        return pd.DataFrame({
            "id": ids, "has_id": has_id, "learned": learned, "n_words": n_words,
            "n_known": sums(counts > 0, doc).astype(np.int64), "logs": sums(np.log10(counts + 1.0), doc),
            "score": score / LN10, "vocabulary": np.zeros(len(ids), np.int64) - 1, "trained": np.zeros(len(ids), np.int64),
        })

    return run


def score(docs: DataFrame, learned, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``id_col, learned, n_tokens, n_known, train_tokens, base_score, score``.

    ``learned`` is a condition for the rows to learn from; where it is null a row is not learned from. Tokens are
    words of the whole text, A-Z lower-cased, and one end. A null text is empty. Repeated rows keep a row each; an
    empty table gives an empty table. Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(docs)
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(0)).alias("id"), F.col(id_col).isNotNull().alias("has_id"),
        F.coalesce(learned, F.lit(False)).alias("learned"), F.col(text).cast("binary").alias("text"),
    )
    # At most 2^24 trigrams, whatever the corpus.
    trigrams = spark.sparkContext.broadcast(trigram_counts(rows.where("learned").select("text")))
    buckets = max(32, text_bytes(docs, text) // BUCKET_BYTES)
    blobs = rows.mapInPandas(_mapper(buckets), BLOCKS)
    counted = blobs.groupBy("bucket").applyInPandas(_reducer(trigrams, buckets), BLOCKS)
    finished = materialize(counted.groupBy("block").applyInPandas(_finisher(buckets), DOCS), "scores")
    found = finished.where("vocabulary < 0")
    totals = finished.where("vocabulary >= 0").agg(
        F.coalesce(F.sum("vocabulary"), F.lit(0)).alias("words"), F.coalesce(F.sum("trained"), F.lit(0)).alias("said"),
    ).crossJoin(found.agg(F.count_if("learned").alias("texts")))
    # The end is a token of every training text.
    v = F.col("words") + F.when(F.col("texts") > 0, 1).otherwise(0)
    n = F.col("said") + F.col("texts")
    tokens = F.col("n_words") + 1
    base = F.col("logs") + F.log10(F.col("texts") + 1.0) - tokens * F.log10(n + v + 1.0)
    return found.crossJoin(F.broadcast(totals)).select(
        F.when(F.col("has_id"), F.col("id")).alias(id_col), "learned", tokens.alias("n_tokens"),
        (F.col("n_known") + F.when(F.col("texts") > 0, 1).otherwise(0)).alias("n_known"),
        n.alias("train_tokens"), base.alias("base_score"), "score",
    )


def op10_ppm_scoring(spark, sf_dir):
    """Scores of all documents, learned from six sevenths of them."""
    held_out = crc_class(F.col("doc_id"), 7) == 2
    found = score(table(spark, sf_dir, "documents"), ~held_out)
    return found.select(
        "doc_id", F.coalesce(crc_class(F.col("doc_id"), 7) == 2, F.lit(False)).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score",
    )
