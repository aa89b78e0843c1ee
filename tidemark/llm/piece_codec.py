"""SentencePiece encoding and decoding over a table of distinct marked words.

In the model no piece holds a whitespace marker after another character, so no piece crosses the start of
a run of spaces. A text, with the dummy space in front, is cut there into chunks (spaces, then other
characters); each distinct chunk of a block of documents is segmented and decoded once with the library, and
the ids and characters are joined back by position. The table belongs to the task: a table of the whole corpus
would have to be joined with every word occurrence, which shuffles several times the input.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import slices, table

MODEL = "piece_bpe_32k.model"
CHUNK = re.compile(r" +[^ ]*")
#: Entries beyond which a worker keeps only the chunks of its current block, and characters of a block.
TABLE_LIMIT = 250_000
BLOCK_BYTES = 2_000_000


class ChunkTable:
    """Ids (little-endian 32-bit) and decoded characters per distinct chunk."""

    def __init__(self, model: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        self.marker = self.library.piece_to_id("▁")
        self.before = self.library.encode("a")
        self.before_chars = len(self.library.decode(self.before))
        self.ids: dict[str, bytes] = {}
        self.chars: dict[str, str] = {}

    def learn(self, chunks: set[str]) -> None:
        if len(self.ids) + len(chunks) > TABLE_LIMIT:
            self.ids = {c: self.ids[c] for c in chunks if c in self.ids}
            self.chars = {c: self.chars[c] for c in self.ids}
        new = [c for c in chunks if c not in self.ids]
        # The library puts one space before what it encodes; it gives nothing for an empty text.
        found = self.library.encode([c[1:] for c in new], num_threads=1)
        found = [ids or [self.marker] for ids in found]
        # Decoded behind a word, because decoding drops the space at the start of a text.
        decoded = self.library.decode([self.before + ids for ids in found], num_threads=1) if found else []
        for chunk, ids, chars in zip(new, found, decoded):
            self.ids[chunk] = b"".join(i.to_bytes(4, "little") for i in ids)
            self.chars[chunk] = chars[self.before_chars :]


def cut(text: str) -> list[str]:
    """Chunks of a text with the dummy space; none for the empty text. The marker character is a space."""
    return CHUNK.findall(" " + text.replace("▁", " ")) if text else []


_TABLES: dict[str, ChunkTable] = {}


def _codec(model: str, text_at: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _TABLES.get(model) or _TABLES.setdefault(model, ChunkTable(model))
        for batch in batches:
            texts = [t or "" for t in batch.column(text_at).to_pylist()]
            for start, stop in slices([len(t) for t in texts], BLOCK_BYTES):
                chunks = [cut(t) for t in texts[start:stop]]
                known.learn(set().union(*chunks))
                ids = [b"".join(map(known.ids.__getitem__, c)) for c in chunks]
                # Decoding drops the dummy space of a text.
                chars = ["".join(map(known.chars.__getitem__, c))[1:] for c in chunks]
                ends = [0]
                for x in ids:
                    ends.append(ends[-1] + len(x) // 4)
                values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(ids))])
                kept = [batch.column(i).slice(start, stop - start) for i in range(batch.num_columns) if i != text_at]
                out = [*kept, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values), pa.array(chars, pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [a.cast(f.type) if a.type != f.type else a for a, f in zip(out, schema)], schema=schema
                )

    return run


def encode_and_decode(docs: DataFrame, text: str = "text", model: str | None = None) -> DataFrame:
    """The other columns of ``docs`` plus ``ids`` (array of int) and ``decoded``, as the library gives them.

    Whole texts, without begin or end ids; null is the empty text, which has no ids and decodes to the empty
    text. Columns called ``ids`` or ``decoded`` are replaced. Empty tables stay empty.
    """
    model = model or public_tokenizers.path(MODEL)
    docs = docs.drop(*[c for c in ("ids", "decoded") if c != text])
    others = [c for c in docs.columns if c != text]
    rows = docs.select(text, *others)
    schema = T.StructType([
        *[rows.schema[c] for c in others], T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.StringType()),
    ])
    return rows.mapInArrow(_codec(model, 0, to_arrow_schema(schema)), schema)


def op4_piece_codec(spark, sf_dir):
    """Digests of the ids and the decoded text of all documents."""
    coded = encode_and_decode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
