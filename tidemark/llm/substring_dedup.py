"""Repeated passages by De Bruijn compaction.

Edges are windows of k consecutive words. An edge is repeated if a document with a smaller id also has it.

1. Blocks of documents hash their windows. A window goes to the bucket of its minimiser, the smallest hash
   of the short grams in it, so that neighbouring windows travel as one run with one header. Edges that repeat inside a block
   are settled there, which also combines a hot passage before the shuffle.
2. Per bucket, sorting finds the first source (smallest document, then position) of each edge. Runs of repeated
   edges that follow each other in the document and in the source are compacted into paths.
3. Paths from different buckets that continue each other are compacted again per document. Each path is verified
   at its source coordinates: both texts are read and the words compared by a 128-bit digest.
4. The words under verified paths are removed.

Nothing is gathered beyond one document, one block or one bucket, whose number grows with the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import give_back, pack, slices, small_batches, table, text_bytes, unpack

WINDOW = 13
GRAM = 4
BLOCK_BYTES = 6_000_000
BUCKET_BYTES = 12_000_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _rolling(x: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash of every ``width`` consecutive values; the last ``width - 1`` entries are not used."""
    out, done, part, power, size = None, 0, x.copy(), int(MULTIPLIER), 1
    todo = width
    while todo:
        if todo & 1:
            factor = np.uint64(pow(int(MULTIPLIER), done, 1 << 64))
            piece = np.zeros_like(x)
            piece[: len(x) - done] = part[done:]
            out = piece * factor if out is None else out + piece * factor
            done += size
        nxt = np.zeros_like(x)
        nxt[: len(x) - size] = part[size:]
        part = part + nxt * np.uint64(power)
        power = power * power % (1 << 64)
        size, todo = size * 2, todo >> 1
    return _mix(out)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    out, size = x.copy(), 1
    while size < width:
        step = min(size, width - size)
        out[: len(out) - step] = np.minimum(out[: len(out) - step], out[step:])
        size += step
    return out


def _runs(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs that begin where ``new`` is true."""
    starts = np.flatnonzero(new)
    return starts, np.diff(np.append(starts, len(new)))


def _paths(doc, at, source, source_at):
    """Compact edges (sorted by document and position) that follow each other here and at the source."""
    if not len(doc):
        return (np.zeros(0, np.int64),) * 5
    new = np.ones(len(doc), bool)
    new[1:] = (
        (doc[1:] != doc[:-1]) | (source[1:] != source[:-1])
        | (at[1:] != at[:-1] + 1) | (source_at[1:] != source_at[:-1] + 1)
    )
    starts, lengths = _runs(new)
    return doc[starts], at[starts], lengths, source[starts], source_at[starts]


def _mapper(buckets: int, window: int, gram: int):
    # Buckets beyond the last carry paths that are settled already, spread by block.
    def block(ids: np.ndarray, marks: np.ndarray, texts: list[bytes], out: list) -> None:
        order = np.lexsort((marks, ids))
        found = [texts[i].split() for i in order]
        sizes = np.array([len(w) for w in found], dtype=np.int64)
        total = int(sizes.sum())
        if total < window:
            return
        digest = xxhash.xxh64_intdigest
        words = np.fromiter((digest(w) for doc in found for w in doc), np.uint64, total)
        seed = int(_mix(words[:1])[0] % np.uint64(1 << 20))
        del found
        ends = np.cumsum(sizes)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        at = np.arange(total) - (ends - sizes)[doc]
        fits = at + window <= sizes[doc]
        edge = _rolling(words, window)
        low = _mix(_sliding_min(_rolling(words, gram), window - gram + 1))
        del words
        here = np.flatnonzero(fits)
        if not len(here):
            return
        by_edge = here[np.argsort(edge[here], kind="stable")]
        new = np.ones(len(by_edge), bool)
        new[1:] = edge[by_edge[1:]] != edge[by_edge[:-1]]
        first = by_edge[np.flatnonzero(new)][np.cumsum(new) - 1]
        ids = ids[order]
        repeated = ids[doc[by_edge]] > ids[doc[first]]
        edges, firsts = by_edge[repeated], first[repeated]
        del here, by_edge, new, first, repeated
        sort = np.argsort(edges, kind="stable")
        edges, firsts = edges[sort], firsts[sort]
        paths = _paths(doc[edges], at[edges], doc[firsts], at[firsts])
        if len(paths[0]):
            marks_ = marks[order]
            out.append((buckets + seed, pack(
                ids[paths[0]], marks_[paths[0]], paths[1], paths[2], ids[paths[3]], marks_[paths[3]], paths[4])))
        fits[edges] = False
        del edges, firsts, sort, paths
        here = np.flatnonzero(fits)
        if not len(here):
            return
        new = np.ones(len(here), bool)
        new[1:] = (here[1:] != here[:-1] + 1) | (low[here[1:]] != low[here[:-1]]) | (at[here[1:]] == 0)
        starts, lengths = _runs(new)
        heads = here[starts]
        del here, new, fits
        bucket = ((low[heads] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        by_bucket = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
        ordinal = doc.astype(np.uint32)
        del doc, low, bucket
        for b in range(buckets):
            runs = by_bucket[cuts[b] : cuts[b + 1]]
            if not len(runs):
                continue
            n = lengths[runs]
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            owners, owner = np.unique(ordinal[heads[runs]], return_inverse=True)
            out.append((b, pack(
                ids[owners], marks[order][owners], owner.astype(np.uint16 if len(owners) < 65536 else np.uint32),
                at[heads[runs]].astype(np.uint32), n.astype(np.uint16 if n.max() < 65536 else np.uint32),
                # All 64 bits: windows of one minimiser differ in nothing else.
                edge[np.repeat(heads[runs], n) + inside],
            )))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for start, stop in slices([len(t) for t in texts], BLOCK_BYTES):
                out: list = []
                block(pdf["id"].to_numpy(np.int64)[start:stop], pdf["mark"].to_numpy(np.int64)[start:stop],
                      texts[start:stop], out)
                if out:
                    yield pd.DataFrame(out, columns=["bucket", "blob"])
        give_back()

    return run


def _reducer(buckets: int):
    names = ["id", "mark", "at", "n", "source", "source_mark", "source_at"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["bucket"].iloc[0] >= buckets:
            parts = [unpack(b) for b in pdf["blob"]]
            return pd.DataFrame({k: np.concatenate(x) for k, x in zip(names, zip(*parts))})
        ids, marks, owner, at, n, key = ([] for _ in range(6))
        base = 0
        for blob in pdf["blob"]:
            a, b, c, d, e, f = unpack(blob)
            ids.append(a); marks.append(b); owner.append(c.astype(np.int64) + base)  # noqa: E702
            at.append(d); n.append(e.astype(np.int64)); key.append(f)  # noqa: E702
            base += len(a)
        ids, marks = np.concatenate(ids), np.concatenate(marks)
        # Owners in the order of id and mark, so that the first of equal edges is the source.
        rank = np.empty(len(ids), np.int64)
        rank[np.lexsort((marks, ids))] = np.arange(len(ids))
        n = np.concatenate(n)
        owner = np.concatenate(owner)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        edge_at = np.repeat(np.concatenate(at).astype(np.int64), n) + inside
        edge_owner = np.repeat(owner, n)
        key = np.concatenate(key)
        del inside, owner, at, n
        # Blocks that were split differently may hold one document twice: equal rank order, any of them.
        order = np.argsort(key, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = key[order[1:]] != key[order[:-1]]
        group = np.cumsum(new) - 1
        del key, new
        twice = (np.bincount(group) > 1)[group]
        picked, group = order[twice], group[twice]
        del order, twice
        if not len(picked):
            return pd.DataFrame({k: np.zeros(0, np.int64) for k in names})
        sort = np.lexsort((edge_at[picked], rank[edge_owner[picked]], group))
        picked, group = picked[sort], group[sort]
        lead = np.ones(len(picked), bool)
        lead[1:] = group[1:] != group[:-1]
        first = picked[np.flatnonzero(lead)][np.cumsum(lead) - 1]
        later = ids[edge_owner[picked]] > ids[edge_owner[first]]
        picked, first = picked[later], first[later]
        sort = np.lexsort((edge_at[picked], edge_owner[picked]))
        picked, first = picked[sort], first[sort]
        paths = _paths(edge_owner[picked], edge_at[picked], edge_owner[first], edge_at[first])
        return pd.DataFrame(dict(zip(names, (
            ids[paths[0]], marks[paths[0]], paths[1], paths[2], ids[paths[3]], marks[paths[3]], paths[4]))))

    return run


PATHS = "id bigint, mark bigint, at bigint, n bigint, source bigint, source_mark bigint, source_at bigint"


def repeated_paths(keyed: DataFrame, total_bytes: int, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Compacted repeated paths: a row of ``PATHS`` per maximal run, of ``n`` windows from word ``at``.

    ``keyed`` has ``id`` and ``mark`` (a hash of the text) and the text in UTF-8; null ids are left out.
    """
    buckets = max(32, total_bytes // BUCKET_BYTES)
    rows = keyed.where(F.col("id").isNotNull() & (F.octet_length("text") >= 2 * window - 1))
    blobs = rows.mapInPandas(_mapper(buckets, window, gram), "bucket bigint, blob binary")
    found = blobs.groupBy("bucket").applyInPandas(_reducer(buckets), PATHS)
    # Paths of neighbouring buckets continue each other: same document and source, end to start.
    place = Window.partitionBy("id", "mark").orderBy("at", "n")
    last_at = F.lag(F.col("at") + F.col("n")).over(place)
    last_source = F.lag(F.col("source_at") + F.col("n")).over(place)
    joined = (
        (last_at == F.col("at")) & (last_source == F.col("source_at"))
        & (F.lag("source").over(place) == F.col("source")) & (F.lag("source_mark").over(place) == F.col("source_mark"))
    )
    starts = found.withColumn("fresh", F.when(joined, 0).otherwise(1))
    return (
        starts.withColumn("path", F.sum("fresh").over(place.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("id", "mark", "path", "source", "source_mark")
        .agg(F.min("at").alias("at"), F.sum("n").alias("n"), F.min("source_at").alias("source_at"))
        .drop("path")
    )


@F.pandas_udf(T.ArrayType(T.BinaryType()))
def _span_digests(texts: pd.Series, starts: pd.Series, sizes: pd.Series) -> pd.Series:
    """128-bit digest of each span (first word, words) of a text."""
    out = []
    for text, at, n in zip(texts, starts, sizes):
        found = (text or b"").split()
        out.append([xxhash.xxh3_128_digest(b" ".join(found[a : a + k])) for a, k in zip(at, n)])
    return pd.Series(out)


_KEPT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()),
])


@F.pandas_udf(_KEPT)
def _removed(texts: pd.Series, starts: pd.Series, sizes: pd.Series) -> pd.DataFrame:
    rows = []
    for text, at, n in zip(texts, starts, sizes):
        found = (text or b"").split()
        stays = np.ones(len(found), bool)
        for a, k in zip(at, n) if at is not None else ():
            stays[a : a + k] = False
        left = int(stays.sum())
        kept = found if left == len(found) else [found[i] for i in np.flatnonzero(stays)]
        rows.append((len(found), len(found) - left, b" ".join(kept).decode("utf-8", "replace")))
    return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """The columns of ``docs`` plus ``n_words``, ``n_removed`` and ``kept``: its words that stay, joined by a space.

    A word goes if it lies in a window of ``window`` words that also starts in a document with a smaller id. A null
    text has no words. Rows that share an id are never each other's source; rows with a null id
    lose nothing and are nobody's source. An empty table gives an empty table. Existing columns of the
    result's names are replaced.
    """
    docs = docs.drop(*[c for c in ("n_words", "n_removed", "kept") if c not in (id_col, text)])
    small_batches(docs)
    total = text_bytes(docs, text)
    docs_keyed = docs.withColumns({
        "__id": F.col(id_col).cast("bigint"), "__mark": F.xxhash64(text), "__body": F.col(text).cast("binary"),
    })
    keyed = docs_keyed.select(F.col("__id").alias("id"), F.col("__mark").alias("mark"), F.col("__body").alias("text"))
    paths = materialize(
        repeated_paths(keyed, total, window, gram).withColumn("n", F.col("n") + window - 1), "paths"
    )
    # A document is asked once for each of its spans, as a source or as a copy.
    own = paths.select("id", "mark", "at", "n")
    sources = paths.select("source", "source_mark", "source_at", "n")
    asked = (
        own.union(sources).groupBy("id", "mark").agg(F.collect_set(F.struct("at", "n")).alias("spans"))
        .select(F.col("id").alias("__i"), F.col("mark").alias("__m"),
                F.col("spans.at").alias("__at"), F.col("spans.n").alias("__n"))
    )
    # Both joins read the documents by the same keys, so the texts are shuffled once.
    same = (F.col("__id") == F.col("__i")) & (F.col("__mark") == F.col("__m"))
    answered = docs_keyed.join(asked, same, "left").where("__i IS NOT NULL")
    digests = answered.select(
        "__i", "__m", F.inline(F.arrays_zip("__at", "__n", _span_digests("__body", "__at", "__n").alias("digest")))
    ).toDF("id", "mark", "at", "n", "digest").distinct()
    source_digests = digests.toDF("source", "source_mark", "source_at", "n", "source_digest")
    verified = (
        paths.join(digests, ["id", "mark", "at", "n"])
        .join(source_digests, ["source", "source_mark", "source_at", "n"])
        .where("digest = source_digest")
        .groupBy("id", "mark").agg(F.collect_set(F.struct("at", "n")).alias("spans"))
        .select(F.col("id").alias("__i"), F.col("mark").alias("__m"),
                F.col("spans.at").alias("__at"), F.col("spans.n").alias("__n"))
    )
    # A generator keeps filters on the counts above it; below, they would run the function, and its workers, once more.
    result = docs_keyed.join(verified, same, "left")
    return result.select(*docs.columns, F.inline(F.array(_removed("__body", "__at", "__n"))))


def op8_substring_dedup(spark, sf_dir):
    """Words of all documents without passages of 13 words that an earlier document has."""
    left = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), windows AS (
  SELECT doc_id, i, sha256(array_to_string(w[i:i + 12], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) > 12)
), firsts AS (SELECT g, min(doc_id) AS source FROM windows GROUP BY g),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
  FROM windows JOIN firsts USING (g) WHERE source < doc_id
), placed AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
  FROM placed ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
