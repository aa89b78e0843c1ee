"""Reproducible shuffle and sharding by a Feistel permutation of global row numbers.

Rows are numbered in the order of their id (then CRC-32, size), whatever their partitions. A balanced Feistel network
permutes the smallest even power of two that holds all numbers, and walks its cycles until a number below the row count
comes out, so it permutes exactly ``0..n-1``. Place ``p`` is slot ``p // shards`` of shard ``p % shards``: shards differ by
one row at most, slots have no gaps, and the row at any slot is computed by the inverse, without reading a table.
Every row is placed on its own, so a hot source or a group of equal texts is spread over all shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scale import sequential_ids
from .common import table

SHARDS = 8
SEED = 20_240_611
ROUNDS = 6
#: Odd multipliers of the round function; products of 31-bit numbers stay inside a signed long.
MIX = (739_982_445, 695_872_825)
WORD = (1 << 31) - 1
#: More rows need wider halves than the round function mixes.
MOST_ROWS = 1 << 62


class Permutation:
    """A permutation of ``0..n-1`` fixed by ``n`` and ``seed``; ``n`` may be 0 (nothing to permute)."""

    def __init__(self, n: int, seed: int = SEED, rounds: int = ROUNDS):
        if not 0 <= n <= MOST_ROWS:
            raise ValueError(f"{n} rows; a permutation has 0 to {MOST_ROWS}")
        self.n = n
        self.half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.keys = round_keys(seed, rounds)

    def _mixed(self, right: np.ndarray, key: int) -> np.ndarray:
        x = ((right ^ key) * MIX[0]) & WORD
        x = ((x ^ (x >> 15)) * MIX[1]) & WORD
        return (x ^ (x >> 13)) & ((1 << self.half) - 1)

    def _through(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & ((1 << self.half) - 1)
        for key in reversed(self.keys) if back else self.keys:
            if back:
                left, right = right ^ self._mixed(left, key), left
            else:
                left, right = right, left ^ self._mixed(right, key)
        return (left << self.half) | right

    def _walk(self, x, back: bool) -> np.ndarray:
        out = self._through(np.asarray(x, dtype=np.int64), back)
        while (outside := np.flatnonzero(out >= self.n)).size:
            out[outside] = self._through(out[outside], back)
        return out

    def place(self, row) -> np.ndarray:
        """Places of the row numbers ``row`` (each below ``n``)."""
        return self._walk(row, False)

    def row(self, place) -> np.ndarray:
        """The row numbers at the places ``place``: the inverse."""
        return self._walk(place, True)

    def row_at(self, shard: int, slot, shards: int = SHARDS) -> np.ndarray:
        """Row numbers at slots of a shard."""
        return self.row(np.asarray(slot, dtype=np.int64) * shards + shard)


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    """31-bit keys, a multiplicative sequence started by the seed."""
    state, out = seed % (1 << 64), []
    for _ in range(rounds):
        state = (state * 6_364_136_223_846_793_005 + 1_442_695_040_888_963_407) % (1 << 64)
        out.append(state >> 33)
    return out


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``size`` (UTF-8 bytes of the text, none for null, plus 1) and ``text_crc32`` (unsigned)."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns({
        "size": (F.octet_length(body) + 1).cast("bigint"), "text_crc32": F.crc32(body.cast("binary")).cast("bigint"),
    })


def placed(numbered: DataFrame, n: int, shards: int, seed: int, row: str = "__row") -> DataFrame:
    """Add ``shard`` and ``slot`` to rows numbered ``0..n-1``."""
    permutation = Permutation(n, seed)

    @F.pandas_udf("bigint")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            yield pd.Series(permutation.place(rows.to_numpy()))

    p = F.col("__place")
    return numbered.withColumn("__place", place(row)).withColumns({
        "shard": (p % shards).cast("int"), "slot": F.expr(f"__place div {shards}"),
    }).drop("__place")


def _numbered(rows: DataFrame, id_col: str) -> tuple[DataFrame, int]:
    numbered = sequential_ids(rows, "__row", [id_col, "text_crc32", "size"], start=0)
    return numbered, numbered.count()


def assign(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text: str = "text", seed: int = SEED
) -> DataFrame:
    """``id_col, size, text_crc32, law, shard, slot, grown_shard``: one row per document.

    The law is ``rows``: row counts of shards differ by one at most. Only ids, sizes and checksums are shuffled. Null ids
    come first in the numbering; rows that share an id are ordered by checksum and size and each gets a place; rows equal
    in all three are interchangeable. Null and empty texts have size 1. An empty table gives an empty table. Other columns
    are not read. With fewer rows than shards the last shards are empty.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    narrow = measured(docs.select(F.col(id_col).alias("__id"), F.col(text).alias("__text")), "__text").drop("__text")
    numbered, n = _numbered(narrow, "__id")
    return placed(numbered, n, shards, seed).select(
        F.col("__id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(
    docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text: str = "text", seed: int = SEED,
    file_rows: int = 1_000_000,
) -> None:
    """Write whole documents as ``path/shard=k/``, in slot order inside files of at most ``file_rows`` rows.

    Slots are range-partitioned, so a large shard is written by many tasks. Columns of ``docs`` named ``size``,
    ``text_crc32``, ``shard`` or ``slot`` are replaced.
    """
    own = [c for c in docs.columns if c not in ("size", "text_crc32", "shard", "slot")]
    numbered, n = _numbered(measured(docs.select(*own), text), id_col)
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = placed(numbered, n, shards, seed).drop("__row").repartitionByRange(width, "shard", "slot")
    rows.sortWithinPartitions("shard", "slot").write.option("maxRecordsPerFile", file_rows).partitionBy("shard").parquet(path)


def read_slots(spark: SparkSession, path: str, shard: int, first: int, count: int) -> DataFrame:
    """Rows of a written shard from slot ``first`` on; partition and row-group pruning leave the rest unread."""
    rows = spark.read.parquet(path).where((F.col("shard") == shard) & F.col("slot").between(first, first + count - 1))
    return rows.orderBy("slot")


def op11_sharding(spark, sf_dir):
    """All documents in 8 shards of equal row counts."""
    return assign(table(spark, sf_dir, "documents"))


def _sql() -> str:
    def mixed(x: str, key: str) -> str:
        one = f"(xor({x}, {key}) * {MIX[0]}) & {WORD}"
        two = f"(xor({one}, ({one}) >> 15) * {MIX[1]}) & {WORD}"
        return f"(xor({two}, ({two}) >> 13) & ((1::BIGINT << half) - 1))"

    keys = round_keys(SEED)
    return f"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce([b] || range(8), lambda c, k: if(c & 1 = 1, xor(c >> 1, 3988292384), c >> 1)) AS c
    FROM range(256) r(b))
), body AS (
  SELECT doc_id, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                                lambda x: ('0x' || x)::BIGINT) AS l FROM documents
), measured AS (
  SELECT doc_id, (len(l) + 1)::BIGINT AS size,
    xor(list_reduce(l, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS text_crc32
  FROM body, crc_table
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS row_,
    count(*) OVER () AS n FROM measured
), split AS (
  SELECT *, (length(bin(greatest(n - 1, 1)::BIGINT)) + 1) // 2 AS half FROM numbered
), walk AS (
  SELECT row_, n, half, row_ >> half AS l, row_ & ((1::BIGINT << half) - 1) AS r, 0 AS step FROM split
  UNION ALL
  SELECT row_, n, half, r, xor(l, {mixed('r', f'({keys}::BIGINT[])[step % {ROUNDS} + 1]')}), step + 1
  FROM walk WHERE step % {ROUNDS} > 0 OR step = 0 OR ((l << half) | r) >= n
), ends AS (
  SELECT row_, (l << half) | r AS p FROM walk WHERE step > 0 AND step % {ROUNDS} = 0 AND ((l << half) | r) < n
)
SELECT doc_id, size, text_crc32, 'rows' AS law, (p % {SHARDS})::INTEGER AS shard, p // {SHARDS} AS slot,
  NULL::INTEGER AS grown_shard
FROM numbered JOIN ends USING (row_)
"""


OP11_SQL = _sql()
