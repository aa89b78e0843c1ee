"""Near-duplicate texts by 64-bit SimHash fingerprints and anchor-point covering.

The anchors are the codewords of a covering code: the product of repetition codes of odd lengths that
add up to 64. Every fingerprint is within the covering radius R (half of each length, rounded down)
of its nearest anchor, its home, found by a majority vote in each block. A fingerprint is replicated to the
anchors within R plus the threshold, leaving out those that cannot be home to anything within the threshold
of it. So each linked pair meets at the home of either side and is compared there, and only there.
Equal fingerprints are collapsed before, and only real links leave the join.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import small_batches, table
from .components import components

BITS = 64
SEED = 42
SHINGLE = 3
CHUNK = 1 << 18
#: Nodes without an id sort after all ids.
NO_ID = 1 << 62


def fingerprint_of(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the word shingles of a UTF-8 text, A-Z lower-cased; 0 without a word."""
    # bytes.lower and bytes.split know exactly A-Z and the six ASCII blanks.
    found = (text or b"").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) < shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)[: len(found) - shingle + 1].tolist()
    ends = ends[shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(starts), CHUNK):
        hashes = np.array(
            [digest(joined[s:e], SEED) for s, e in zip(starts[at : at + CHUNK], ends[at : at + CHUNK])], dtype="<u8"
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for part in range(0, len(bits), 255):
            ones += bits[part : part + 255].sum(axis=0, dtype=np.uint8)
    return int(sum(1 << int(i) for i in np.flatnonzero(2 * ones > len(starts))))


@F.pandas_udf(T.LongType())
def _fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        values = np.array([fingerprint_of(t) for t in texts], dtype=np.uint64)
        yield pd.Series(values.view(np.int64))


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add the fingerprint as a signed long with the same bits."""
    return docs.withColumn(out, _fingerprints(F.col(text).cast("binary")))


def block_lengths(blocks: int) -> list[int]:
    """An even number of odd lengths that add up to 64, as equal as they can be."""
    short = BITS // blocks
    short -= 1 - short % 2
    longer = (BITS - blocks * short) // 2
    return [short + 2] * longer + [short] * (blocks - longer)


def covering_radius(blocks: int) -> int:
    return sum(length // 2 for length in block_lengths(blocks))


def _blocks(fp: Column, blocks: int) -> list[tuple[int, Column, Column]]:
    """Per block: its bit in the anchor, its majority, and how many flips would turn the majority."""
    out, low = [], 0
    for k, length in enumerate(block_lengths(blocks)):
        mask = ((1 << length) - 1) << low
        mask -= (1 << 64) if mask >= 1 << 63 else 0
        ones = F.bit_count(fp.bitwiseAND(F.lit(mask)))
        out.append((1 << k, ones * 2 > length, (F.abs(ones * 2 - length) + 1) / 2))
        low += length
    return out


def home_anchor(fp: Column, blocks: int) -> Column:
    bits = [F.when(majority, F.lit(bit)).otherwise(0) for bit, majority, _ in _blocks(fp, blocks)]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out.cast("int")


def reachable_anchors(fp: Column, blocks: int, threshold: int) -> Column:
    """Homes of everything within ``threshold`` bits: sets of blocks whose flips fit the threshold."""
    turns = F.array_compact(F.array(*[
        F.when(cost <= threshold, F.struct(F.lit(bit).alias("bit"), cost.cast("int").alias("cost")))
        for bit, _, cost in _blocks(fp, blocks)
    ]))
    start = F.array(F.struct(F.lit(0).alias("bit"), F.lit(0).alias("cost")))
    sets = F.aggregate(turns, start, lambda acc, b: F.concat(acc, F.transform(
        F.filter(acc, lambda s: s["cost"] + b["cost"] <= threshold),
        lambda s: F.struct(s["bit"].bitwiseOR(b["bit"]).alias("bit"), (s["cost"] + b["cost"]).alias("cost")),
    )))
    return F.transform(sets, lambda s: s["bit"])


def block_count(n: int) -> int:
    """Blocks for about 16 fingerprints at home with each anchor; it changes the work, not the links."""
    return max(4, min(20, 2 * round((n // 16).bit_length() / 2)))


def links(distinct: DataFrame, threshold: int = 2, blocks: int | None = None) -> DataFrame:
    """Pairs ``fp_a < fp_b`` of distinct fingerprints (column ``fp``) at most ``threshold`` bits apart."""
    if blocks is None:
        blocks = block_count(distinct.count())
    homes = distinct.select(F.col("fp").alias("fp_a"), home_anchor(F.col("fp"), blocks).alias("anchor"))
    guests = (
        distinct.select("fp", home_anchor(F.col("fp"), blocks).alias("home"),
                        reachable_anchors(F.col("fp"), blocks, threshold).alias("flips"))
        .select(F.col("fp").alias("fp_b"), "home", F.explode("flips").alias("flip"))
        .select("fp_b", F.col("home").bitwiseXOR(F.col("flip")).alias("anchor"))
    )
    near = F.bit_count(F.col("fp_a").bitwiseXOR(F.col("fp_b"))) <= threshold
    # Spark sizes the guests as if a fingerprint had one anchor, so it would send all of them to the driver for a broadcast.
    return homes.join(
        guests.hint("merge"), (homes["anchor"] == guests["anchor"]) & (F.col("fp_a") < F.col("fp_b")) & near
    ).select("fp_a", "fp_b")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: int = 2, blocks: int | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``id_col, fingerprint, component_id`` and the columns ``carry``: one row per document.

    ``fingerprint`` is 16 lowercase hex digits. Documents link if their fingerprints differ in at most
    ``threshold`` bits. Null, empty and blank texts have fingerprint zero and link like any other. A
    null id takes the smallest id it reaches (null if none); repeated ids keep a row each. An empty
    table gives an empty table. Other columns are not read.
    """
    small_batches(docs)
    read = docs.select(id_col, text, *[F.col(f"`{c}`").alias(f"__carried_{c}") for c in carry])
    hashed = materialize(fingerprints(read, text, "fp").drop(*{text} - {id_col}), "fingerprints")
    distinct = materialize(
        hashed.groupBy("fp").agg(F.min(id_col).cast("bigint").alias("first_id"))
        .withColumn("node", F.coalesce("first_id", F.lit(NO_ID) + F.abs(F.xxhash64("fp") % (1 << 61))))
        .drop("first_id"),
        "distinct",
    )
    pairs = links(distinct, threshold, blocks)
    a = distinct.select(F.col("fp").alias("fp_a"), F.col("node").alias("a"))
    b = distinct.select(F.col("fp").alias("fp_b"), F.col("node").alias("b"))
    groups = components(pairs.join(a, "fp_a").join(b, "fp_b"), "a", "b")
    found = distinct.join(groups, "node", "left").select(
        "fp", F.coalesce("component", "node").alias("component")
    )
    return hashed.join(found, "fp").select(
        id_col,
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("component") < NO_ID, F.col("component")).alias("component_id"),
        *[F.col(f"`__carried_{c}`").alias(c) for c in carry],
    )


def representatives(docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: int = 2) -> DataFrame:
    """One row of ``docs`` per group of near duplicates, whole: the smallest id of the group stands for it.

    If that id has several texts in the group, the one with the smallest hash stays; of repeated rows one stays. A
    group in which no row has an id is left out.
    """
    mark = "__text_hash"
    marked = docs.withColumn(mark, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    groups = near_duplicates(marked, id_col, text, threshold, carry=[mark])
    chosen = groups.where(F.col(id_col) == F.col("component_id")).groupBy(id_col).agg(F.min(mark).alias(mark))
    return marked.join(chosen, [id_col, mark]).dropDuplicates([id_col, mark]).select(*docs.columns)


def op2_simhash_dedup(spark, sf_dir):
    """SimHash groups of all documents at 2 bits."""
    return near_duplicates(table(spark, sf_dir, "documents"))
