"""Packing token sequences by minimum bin slack.

Documents become pieces of at most the capacity. Only the lengths matter for packing, and there are at most
``capacity`` of them, so the packing is planned on their counts: per bin, the longest remaining length is
fixed and a bitset subset-sum over the available lengths finds the fullest combination with it. A combination is
taken as often as the counts allow, which uses up at least one of its lengths, so the plan stays bounded
by the number of lengths whatever the number of documents. Pieces of one length are then numbered in parallel
and look up their place in the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..session import materialize
from .common import give_back, slices, small_batches, table

MODEL = "word_bpe_49k.json"
END = 1
#: Units between which the tokenizer always cuts: it drops white space (``SPACE`` is what is not ASCII of it), and a run of
#: letters that are lower case already ends at ASCII punctuation other than the apostrophe of a contraction.
SPACE = r"[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
LETTERS, MARKS = "[a-zà-öø-ÿ]+", "[.,!?;:|#*$%&<>]"
#: Units, and bytes of them, beyond which a worker forgets those that only one block has had and those of more bytes than
#: ``LONG``, the runs of letters of a text encoded at once, the other units of a batch, and the bytes of a block.
TABLE_LIMIT = 400_000
TABLE_BYTES = 32_000_000
LONG = 100
#: Units that a worker keeps between tasks; it may idle beside other stages.
IDLE_LIMIT = 100_000
TOGETHER = 100
BATCH = 4_000
BLOCK_BYTES = 4_000_000
#: Buckets in which pieces of one length are numbered.
BUCKETS = 1024
RANK_BITS = 44
#: What is found of a piece.
CUT = pa.schema([
    ("key", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
])


# -- planning ----------------------------------------------------------------------------------

def fullest(counts: dict[int, int], order: list[int], room: int) -> list[tuple[int, int]]:
    """Lengths and how often each, summing as close to ``room`` as the counts allow.

    ``order`` lists the available lengths, longest first. Bit ``s`` of a set says that sum ``s`` can be
    reached; copies of a length enter in doubling portions, and the sets are kept to read the choice back.
    """
    reach, steps = 1, []
    full = (1 << (room + 1)) - 1
    for length in order:
        if length > room:
            continue
        left, portion = min(counts[length], room // length), 1
        while left:
            portion = min(portion, left)
            steps.append((reach, length, portion))
            reach |= (reach << (length * portion)) & full
            left -= portion
            portion *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for before, length, portion in reversed(steps):
        if not before >> total & 1:
            total -= length * portion
            chosen[length] = chosen.get(length, 0) + portion
    return sorted(chosen.items(), reverse=True)


def plan(lengths: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins as (how many alike, [(length, times)]), for counts per length."""
    counts = {k: n for k, n in lengths.items() if n > 0}
    bins = []
    while counts:
        order = sorted(counts, reverse=True)
        largest = order[0]
        counts[largest] -= 1
        rest = fullest(counts, order, capacity - largest)
        counts[largest] += 1
        used = dict(rest)
        used[largest] = used.get(largest, 0) + 1
        alike = min(counts[length] // times for length, times in used.items())
        bins.append((alike, sorted(used.items(), reverse=True)))
        for length, times in used.items():
            counts[length] -= alike * times
            if not counts[length]:
                del counts[length]
    return bins


def places(bins) -> pd.DataFrame:
    """Per length, consecutive ranges of piece ranks and where they go."""
    first_rank: dict[int, int] = {}
    rows, sequence = [], 0
    for alike, content in bins:
        offset = 0
        for length, times in content:
            at = first_rank.get(length, 0)
            rows.append((length, at, times, sequence, offset))
            first_rank[length] = at + alike * times
            offset += length * times
        sequence += alike
    return pd.DataFrame(rows, columns=["length", "rank", "times", "sequence", "offset"]).sort_values(["length", "rank"])


# -- tokens ------------------------------------------------------------------------------------

def _bounds(sizes: np.ndarray) -> np.ndarray:
    """How much comes before each of some sizes, and after the last."""
    return np.concatenate([[0], np.cumsum(sizes)])


def _gather(ids: np.ndarray, bounds: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists of these numbers, end to end, and their bounds; list ``i`` is ``ids[bounds[i] : bounds[i + 1]]``."""
    start = bounds[numbers]
    size = bounds[numbers + 1] - start
    found = _bounds(size)
    at = np.repeat(start - found[:-1], size)
    at += np.arange(found[-1])
    return ids[at], found


class UnitTable:
    """Ids of distinct units as lists end to end. Units of more than one block outlive those that passed by once."""

    def __init__(self, model: str):
        self.library = Tokenizer.from_file(model)
        size = self.library.get_vocab_size()
        self.ends = np.array([(self.library.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.units = pa.array([], pa.string())
        self.ids, self.bounds, self.blocks = np.zeros(0, "<u4"), np.zeros(1, np.int64), np.zeros(0, np.int64)

    def find(self, units: pa.Array) -> np.ndarray:
        """Numbers of a block's units; unknown ones are learnt."""
        if len(self.units) > TABLE_LIMIT or self.units.nbytes > TABLE_BYTES:
            self.forget(TABLE_LIMIT // 2)
        # Units of the table come first in the dictionary, in their order, and unknown ones behind them.
        both = pa.concat_arrays([self.units, units]).dictionary_encode()
        numbers = both.indices.to_numpy()[len(self.units) :]
        self._learn(both.dictionary[len(self.units) :])
        self.units = both.dictionary
        self.blocks[numbers] += 1
        return numbers

    def forget(self, limit: int) -> None:
        """Keep at most ``limit`` units, short ones of several blocks; they must be met again to be kept the next time."""
        again = (self.blocks > 1) & (pc.binary_length(self.units).to_numpy() <= LONG)
        kept = np.flatnonzero(again & (np.cumsum(again) <= limit))
        self.ids, self.bounds = _gather(self.ids, self.bounds, kept)
        self.units, self.blocks = self.units.take(pa.array(kept)), np.ones(len(kept), np.int64)

    def _learn(self, units: pa.Array) -> None:
        plain = pc.match_substring_regex(units, rf"^{LETTERS}$").to_numpy(zero_copy_only=False)
        order, ids, sizes, other = [], [self.ids[:0]], [], [np.flatnonzero(~plain)]
        # A run of letters is one word to the tokenizer, so many can be encoded as one text and cut at word ends.
        runs = np.flatnonzero(plain)
        texts = units.take(pa.array(runs)).to_pylist()
        for at in range(0, len(texts), TOGETHER):
            part = texts[at : at + TOGETHER]
            found = np.array(self.library.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(self.ends[found]) + 1
            if len(cuts) != len(part):
                other.append(runs[at : at + TOGETHER])
                continue
            order.append(runs[at : at + TOGETHER])
            ids.append(found)
            sizes.append(np.diff(cuts, prepend=0))
        other = np.concatenate(other)
        for at in range(0, len(other), BATCH):
            part = units.take(pa.array(other[at : at + BATCH])).to_pylist()
            found = [e.ids for e in self.library.encode_batch(part, add_special_tokens=False)]
            order.append(other[at : at + BATCH])
            ids.append(np.fromiter(chain.from_iterable(found), "<u4"))
            sizes.append(np.fromiter(map(len, found), np.int64))
        if order:
            back = np.argsort(np.concatenate(order))
            ids, bounds = _gather(np.concatenate(ids), _bounds(np.concatenate(sizes)), back)
            self.ids = np.concatenate([self.ids, ids])
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + bounds[1:]])
            self.blocks = np.concatenate([self.blocks, np.zeros(len(units), np.int64)])


_TABLES: dict[str, UnitTable] = {}


def _ids_of(model: str, texts: list[str] | pa.Array) -> list[bytes]:
    """Ids of whole texts; the tokenizer lower-cases, so A-Z can be lower-cased before its table is asked."""
    known = _TABLES.get(model) or _TABLES.setdefault(model, UnitTable(model))
    words = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.string()) if isinstance(texts, list) else texts))
    block = words.values.dictionary_encode()
    spaced = pc.replace_substring_regex(block.dictionary, SPACE, " ")
    units = pc.ascii_split_whitespace(pc.replace_substring_regex(spaced, rf"^({LETTERS})({MARKS})", r"\1 \2"))
    numbers = known.find(units.values)
    ids, bounds = _gather(known.ids, known.bounds, numbers)
    ids, bounds = _gather(ids, bounds[units.offsets.to_numpy()], block.indices.to_numpy())
    cuts = bounds[words.offsets.to_numpy()].tolist()
    return [ids[start:stop].tobytes() for start, stop in pairwise(cuts)]


def _cutter(model: str, capacity: int):
    end = END.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").fill_null("")
            for start, stop in slices(pc.binary_length(texts).to_pylist(), BLOCK_BYTES):
                out = []
                for row, ids in enumerate(_ids_of(model, texts[start:stop]), start):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        out.append((row, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                row, *others = map(pa.array, zip(*out), CUT.types)
                yield pa.RecordBatch.from_arrays([batch.column("key").take(row), *others], schema=CUT)
        if model in _TABLES:
            _TABLES[model].forget(IDLE_LIMIT)
        give_back()

    return cut


def pieces(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", capacity: int = 4096, model: str | None = None
) -> DataFrame:
    """``id_col, piece, start, length, ids_crc32`` of every whole text followed by the end id."""
    model = model or public_tokenizers.path(MODEL)
    rows = docs.select(F.col(id_col).cast("bigint").alias("key"), F.col(text).alias("text"))
    cut = rows.mapInArrow(
        _cutter(model, capacity), "key bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    )
    return cut.withColumnRenamed("key", id_col)


def pack(cut: DataFrame, id_col: str = "doc_id", capacity: int = 4096) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table of pieces; it is read twice, so pass a written one.

    Pieces of equal length, repeated rows included, are numbered by id, piece and content; rows that agree in
    all of these are interchangeable. An empty table gives an empty table.
    """
    spark = cut.sparkSession
    numbered = cut.withColumn("__bucket", F.pmod(F.xxhash64(id_col, "piece", "ids_crc32"), F.lit(BUCKETS)).cast("int"))
    sizes = numbered.groupBy("length", "__bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("length").alias("__l"), F.col("__bucket").alias("__b"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__first"),
    )
    # At most one row per length up to the capacity.
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    found = places(plan(counts, capacity))
    keys = (found["length"].to_numpy(np.int64) << RANK_BITS) + found["rank"].to_numpy(np.int64)
    # At most a few bins per length and a capacity's worth of distinct lengths in a bin, whatever the input.
    lookup = spark.sparkContext.broadcast((
        keys, *(found[c].to_numpy(np.int64) for c in ("rank", "times", "sequence", "offset")),
    ))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        keys, first, times, sequence, offset = lookup.value
        size, n = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        at = np.searchsorted(keys, (size << RANK_BITS) + n, side="right") - 1
        inside = n - first[at]
        return pd.DataFrame({
            "sequence_id": sequence[at] + inside // times[at], "offset": offset[at] + inside % times[at] * size,
        })

    inside = Window.partitionBy("length", "__bucket").orderBy(id_col, "piece", "ids_crc32")
    ranked = numbered.withColumn("__n", F.row_number().over(inside) - 1).join(
        offsets, (F.col("length") == F.col("__l")) & (F.col("__bucket") == F.col("__b"))
    )
    spot = place(F.col("length"), F.col("__first") + F.col("__n"))
    return ranked.withColumn("__spot", spot).select(*cut.columns, "__spot.sequence_id", "__spot.offset")


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", capacity: int = 4096, model: str | None = None
) -> DataFrame:
    """Pieces of all documents with their places; see ``pieces`` and ``pack``.

    A null or empty text is the end id alone. Null ids are kept. Other columns are not read.
    """
    small_batches(docs)
    return pack(materialize(pieces(docs, id_col, text, capacity, model), "pieces"), id_col, capacity)


def op7_best_fit_packing(spark, sf_dir):
    """All documents in sequences of at most 4096 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"))
