"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than space, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


#: Bytes of the batches in which rows travel to Python.
BATCH_BYTES = "8m"


def small_batches(df: DataFrame, size: str = BATCH_BYTES) -> DataFrame:
    """Bound the batches that Python gets from now on, whatever the length of the texts."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def words(text: Column) -> Column:
    """The words of a text as an array; an empty array for null, empty or blank texts."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, BLANK_RUN))


def crc_class(key: Column, classes: int) -> Column:
    """CRC-32 of a key written as text, modulo ``classes``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % classes


def give_back() -> None:
    """Return to the system what Arrow keeps of batches that are gone; a worker may idle beside other stages."""
    pa.default_memory_pool().release_unused()


def pack(*arrays) -> bytes:
    return pickle.dumps(arrays, protocol=5)


def unpack(blob: bytes) -> tuple:
    return pickle.loads(blob)


def slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes sum to about ``limit``; one large item is a range of its own."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts; sizes partition counts, never results."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
