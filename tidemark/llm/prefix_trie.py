"""Prefix trie of conversations in minimal-perfect-hash node tables.

A turn is known by the SHA-256 of its role and text. The digest of a prefix is the value of a polynomial in those
hashes, modulo 2^61 - 1, at two points; so digests of a conversation that spans several partitions are put together from
the digests of its parts, and every node is checked: its members must agree in the parent's digest and the last turn's
SHA-256, or the trie is built anew at other points. By induction equal digests then are equal prefixes.

Nodes are cut into pieces that fit a task. The level of a node is the smallest k with at most ``FAN ** k`` different
conversations below it, and a piece is a subtree of nodes of one level and one band of depths. It has ``FAN`` nodes a depth
at most, because the nodes of lower levels under it enter as sums per parent. The pieces of a level are dealt to shards. A shard
gives each digest a slot by a minimal perfect hash, verified against the digest stored there, scatters counts
into flat arrays by slot, and adds children to their parents' slots in order of depth. Bands are worked from the deepest up
and levels from the lowest up, each with all its shards at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scale import sequential_ids
from ..session import materialize
from .common import table

FAN = 256
BAND = 8192
SHARD_NODES = 100_000
PRIME = (1 << 61) - 1
#: Turns so far and the digest's two values, with and without the last turn.
STATE = ("n", "a", "b", "above_a", "above_b")
ROOT = (1).to_bytes(8, "big") * 2
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
#: Bytes of joined ids that travel as one row.
BLOB = 1 << 20
NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, " \
       "saved_tokens bigint, ends_sha256 string"


# -- turns -------------------------------------------------------------------------------------

def marked_turns(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv, pos, mark, chars``: turns numbered from 0 by ``turn`` (null first; ties by SHA-256), without their texts.

    Positions come from one global order, so a conversation of any length is spread over tasks. Null roles and texts are
    empty; rows without a conversation are left out.
    """
    who, said = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("bigint").alias("conv"), F.col(turn).alias("turn"),
        F.unhex(F.sha2(F.concat(F.char_length(who).cast("string"), F.lit(":"), who, said).cast("binary"), 256)).alias("mark"),
        F.char_length(said).cast("bigint").alias("chars"),
    )
    numbered = sequential_ids(rows, "row", ["conv", "turn", "mark"], start=0)
    first = numbered.groupBy("conv").agg(F.min("row").alias("first"))
    return numbered.join(first, "conv").select("conv", (F.col("row") - F.col("first")).alias("pos"), "mark", "chars")


def lengths_of(turns: DataFrame) -> DataFrame:
    """``conv, total``: number of turns of each conversation."""
    return turns.groupBy("conv").agg(F.count("*").alias("total"))


def grafted(turns: DataFrame, every: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that start with turns of another: turns and lengths.

    With h = CRC-32 of the decimal id modulo ``heads``, the first h turns of conversation ``c - c % every`` (all it has, none
    if it is absent) replace the first h turns of ``c``. The remainder takes the sign of ``c``.
    """
    key = F.col("conv")
    own = lengths_of(turns).select(
        "conv", F.col("total").alias("n"), (key - key % every).alias("base"),
        (F.crc32(key.cast("string").cast("binary")) % heads).alias("h"),
    )
    base = own.where(key % every == 0).select(key.alias("base"), F.col("n").alias("n_base"))
    kept = F.least("h", F.coalesce("n_base", F.lit(0)))
    plan = materialize(
        own.join(base, "base", "left").withColumn("kept", kept)
        .withColumn("total", F.col("kept") + F.greatest(F.col("n") - F.col("h"), F.lit(0))),
        "grafts",
    )
    lent = turns.where((key % every == 0) & (F.col("pos") < heads)).withColumnRenamed("conv", "base")
    # A base lends at most ``heads - 1`` turns to each of the ``every`` conversations of its range.
    borrowed = plan.join(lent, "base").where("pos < h").select("conv", "pos", "mark", "chars")
    rest = turns.join(plan.select("conv", "h", "kept"), "conv").where("pos >= h").select(
        "conv", (F.col("pos") - F.col("h") + F.col("kept")).alias("pos"), "mark", "chars")
    return borrowed.unionByName(rest), plan.select("conv", "total")


# -- digests -----------------------------------------------------------------------------------

def _points(attempt: int) -> tuple[int, int]:
    seed = hashlib.sha256(f"points {attempt}".encode()).digest()
    return tuple(int.from_bytes(seed[i : i + 8], "big") % (PRIME - 2) + 2 for i in (0, 8))


def _local_digests(points: tuple[int, int]) -> Callable:
    """Digests as if each conversation began in this partition; a last row tells how the partition ends."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        (p, q), conv, first, n, a, b = points, None, None, 0, 1, 1
        for pdf in batches:
            out = []
            for c, mark in zip(pdf["conv"].tolist(), pdf["mark"]):
                if c != conv:
                    first, conv, n, a, b = (c if conv is None else first), c, 0, 1, 1
                above_a, above_b = a, b
                a = (a * p + int.from_bytes(mark[:8], "big")) % PRIME
                b = (b * q + int.from_bytes(mark[8:16], "big")) % PRIME
                n += 1
                out.append((n, a, b, above_a, above_b))
            if out:
                found = np.array(out, dtype=np.int64)
                yield pdf.assign(part=part, **{c: found[:, i] for i, c in enumerate(STATE)}, first=None)
        if conv is not None:
            yield pd.DataFrame([{"conv": conv, "pos": None, "mark": None, "chars": None, "part": part, "n": n, "a": a, "b": b,
                                 "above_a": None, "above_b": None, "first": first}])

    return run


def _carries(ends: list, points: tuple[int, int]) -> dict[int, tuple[int, int, int]]:
    """Per partition the conversation that goes on from the one before, with its digest so far; one row a partition."""
    carries, before = {}, None
    for r in sorted(ends, key=lambda r: r["part"]):
        a, b = r["a"], r["b"]
        if before is not None and before[0] == r["first"]:
            carries[r["part"]] = before
            if r["first"] == r["conv"]:
                a, b = _continued(r["n"], a, b, before, points)
        before = (r["conv"], a, b)
    return carries


def _continued(n: int, a: int, b: int, carry: tuple[int, int, int], points: tuple[int, int]) -> tuple[int, int]:
    p, q = points
    return (a + (carry[1] - 1) * pow(p, n, PRIME)) % PRIME, (b + (carry[2] - 1) * pow(q, n, PRIME)) % PRIME


def _whole_digests(carries: dict[int, tuple[int, int, int]], points: tuple[int, int]) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            node, parent = [], []
            for part, conv, n, a, b, above_a, above_b in zip(*(pdf[c].tolist() for c in ("part", "conv", *STATE))):
                carry = carries.get(part)
                if carry is not None and carry[0] == conv:
                    a, b = _continued(n, a, b, carry, points)
                    above_a, above_b = _continued(n - 1, above_a, above_b, carry, points)
                node.append(a.to_bytes(8, "big") + b.to_bytes(8, "big"))
                parent.append(above_a.to_bytes(8, "big") + above_b.to_bytes(8, "big"))
            yield pd.DataFrame({"conv": pdf["conv"], "depth": pdf["pos"] + 1, "mark": pdf["mark"], "chars": pdf["chars"],
                                "node": node, "parent": parent})

    return run


def prefix_digests(turns: DataFrame, points: tuple[int, int]) -> DataFrame:
    """``conv, depth, mark, chars, node, parent``: the digest of every prefix (depths from 1) and of the one before."""
    width = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = turns.select("conv", "pos", "mark", "chars").repartitionByRange(width, "conv", "pos").sortWithinPartitions("conv", "pos")
    local = materialize(placed.mapInPandas(
        _local_digests(points),
        "conv bigint, pos bigint, mark binary, chars bigint, part int, n bigint, a bigint, b bigint, above_a bigint, "
        "above_b bigint, first bigint",
    ), "local-digests")
    ends = local.where("first IS NOT NULL").select("part", "first", "conv", "n", "a", "b").collect()
    return materialize(local.where("first IS NULL").mapInPandas(
        _whole_digests(_carries(ends, points), points),
        "conv bigint, depth bigint, mark binary, chars bigint, node binary, parent binary",
    ), "prefix-digests")


# -- nodes -------------------------------------------------------------------------------------

class SlotTable:
    """A minimal perfect hash of 16-byte digests, with the digests themselves by slot.

    Keys that are alone at a place of the first bit table take the rank of their bit; the others go on to the next table.
    """

    def __init__(self, keys: np.ndarray):
        self.tables, rest, base = [], np.arange(len(keys)), 0
        while len(rest):
            if len(self.tables) > 200:
                raise ValueError("a digest occurs twice")
            size = max(64, 2 * len(rest))
            at = self._at(keys[rest], len(self.tables), size)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, dtype=bool)
            bits[at[alone]] = True
            self.tables.append((bits, np.cumsum(bits) - 1 + base))
            base += int(alone.sum())
            rest = rest[~alone]
        self.keys = np.zeros_like(keys)
        self.keys[self._candidates(keys)] = keys
        if (self.slots(keys) < 0).any():
            raise ValueError("slots are not distinct")

    @staticmethod
    def _at(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        x = keys[:, 0] ^ (keys[:, 1] * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64((level * 0xD1B54A32D192ED03) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)

    def _candidates(self, keys: np.ndarray) -> np.ndarray:
        out, rest = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys))
        for level, (bits, rank) in enumerate(self.tables):
            at = self._at(keys[rest], level, len(bits))
            hit = bits[at]
            out[rest[hit]] = rank[at[hit]]
            rest = rest[~hit]
        return out

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slots of keys; -1 for a key that is not in the table."""
        found = self._candidates(keys)
        known = found >= 0
        known[known] = (self.keys[found[known]] == keys[known]).all(axis=1)
        return np.where(known, found, -1)


def _keys(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=">u8").reshape(-1, 2).astype(np.uint64)


def _summed(pdf: pd.DataFrame) -> pd.DataFrame:
    """Children, leaves and savings of the subtrees of a shard's nodes, in flat arrays by slot."""
    keys = _keys(pdf["node"])
    slots = SlotTable(keys)
    at = slots.slots(keys)
    n = len(pdf)
    above, depth, children, leaves, saved = (np.zeros(n, dtype=np.int64) for _ in range(5))
    above[at] = slots.slots(_keys(pdf["parent"].fillna(ROOT)))
    root = pdf["parent"].isna().to_numpy()
    above[at[root]] = -1
    depth[at] = pdf["depth"]
    children[at], leaves[at] = pdf["c_children"], pdf["c_leaves"]
    saved[at] = pdf["c_saved"] + (pdf["n_convs"] - 1) * pdf["chars"]
    order = np.argsort(-depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[order])) + 1
    for same in np.split(order, cuts):
        leaves[same[children[same] == 0]] = 1
        inner = same[above[same] >= 0]
        np.add.at(children, above[inner], 1)
        np.add.at(leaves, above[inner], leaves[inner])
        np.add.at(saved, above[inner], saved[inner])
    return pd.DataFrame({"node": pdf["node"], "n_children": children[at], "n_leaves": leaves[at], "saved_tokens": saved[at]})


def collide(digests: DataFrame) -> bool:
    """Whether different prefixes share a digest: members of a node differ in depth, last turn or parent."""
    apart = digests.groupBy("node").agg(*[(F.min(c) != F.max(c)).alias(c) for c in ("depth", "mark", "parent")])
    return not apart.where(f"depth OR mark OR parent OR node = X'{ROOT.hex()}'").isEmpty()


def _distinct_nodes(paths: DataFrame) -> DataFrame:
    return paths.groupBy("node").agg(
        F.min("conv").alias("conv"), F.max("depth").alias("depth"), F.max("parent").alias("parent"),
        F.sum("copies").alias("n_convs"), F.count("*").alias("paths"), F.max("chars").alias("chars"),
    )


def _paths(digests: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of one conversation for each different one (``copies`` of it), root included; and where each ends."""
    ends = lengths.join(digests.withColumnRenamed("depth", "total").select("conv", "total", "node"), ["conv", "total"], "left")
    ends = materialize(ends.select("conv", F.coalesce("node", F.lit(ROOT)).alias("node")), "ends")
    copies = ends.groupBy("node").agg(F.min("conv").alias("conv"), F.count("*").alias("copies")).drop("node")
    deeper = digests.join(copies, "conv").select("conv", "depth", "chars", "node", "parent", "copies")
    root = copies.select(
        "conv", F.lit(0).cast("bigint").alias("depth"), F.lit(0).cast("bigint").alias("chars"), F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), "copies")
    return materialize(deeper.unionByName(root), "paths"), ends


def _level(paths, fan: int):
    """Smallest k from 1 on with ``fan ** k >= paths``."""
    powers, x = [], fan
    while x < 1 << 62:
        powers.append(x)
        x *= fan
    return F.lit(1) + F.size(F.filter(F.array(*[F.lit(p) for p in powers]), lambda p: p < paths))


def _ends_hashes(ends: DataFrame) -> DataFrame:
    """``node, ends_sha256``: ids are joined in range partitions first, so the hash of a hot node reads few long rows."""

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, first, ids, size = None, None, [], 0
        for pdf in batches:
            out = []
            for k, c in zip(pdf["node"], pdf["conv"].tolist()):
                if k != node or size > BLOB:
                    if ids:
                        out.append((node, first, ",".join(ids)))
                    node, first, ids, size = k, c, [], 0
                ids.append(str(c))
                size += len(ids[-1]) + 1
            yield pd.DataFrame(out, columns=["node", "first", "ids"])
        if ids:
            yield pd.DataFrame([(node, first, ",".join(ids))], columns=["node", "first", "ids"])

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state = None, None
        for pdf in batches:
            out = []
            for k, ids in zip(pdf["node"], pdf["ids"]):
                if k != node:
                    if node is not None:
                        out.append((node, state.hexdigest()))
                    node, state = k, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield pd.DataFrame(out, columns=["node", "ends_sha256"])
        if node is not None:
            yield pd.DataFrame([(node, state.hexdigest())], columns=["node", "ends_sha256"])

    width = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blobs = (
        ends.repartitionByRange(width, "node", "conv").sortWithinPartitions("node", "conv")
        .mapInPandas(joined, "node binary, first bigint, ids string")
    )
    return blobs.repartition(width, "node").sortWithinPartitions("node", "first").mapInPandas(hashed, "node binary, ends_sha256 string")


def prefix_trie(
    turns: DataFrame, lengths: DataFrame, fan: int = FAN, band: int = BAND, shard_nodes: int = SHARD_NODES, tries: int = 5
) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``turns`` has ``conv, pos, mark, chars`` with positions from 0, ``lengths`` every conversation and its number of turns. A
    node is a different sequence of first turns, named by the smallest conversation that starts with it; the root is the
    empty one (depth 0, no parent). ``saved_tokens`` sums, over a subtree, the characters of each node's last turn times its
    conversations but one. ``ends_sha256`` hashes the ids of the conversations that end there. Copies of a conversation
    are one path with a count. Without conversations there is no root and no row. ``fan``, ``band`` and ``shard_nodes`` only
    change how the nodes are cut: each round works one level of one band, and the rounds of a band see the sums below it.
    """
    spark = turns.sparkSession
    if lengths.isEmpty():
        return spark.createDataFrame([], NODE)
    for attempt in range(tries):
        digests = prefix_digests(turns, _points(attempt))
        if not collide(digests):
            break
    else:
        raise ValueError("prefix digests collide")
    paths, ends = _paths(digests, lengths)
    nodes = materialize(
        _distinct_nodes(paths).withColumns({"level": _level(F.col("paths"), fan), "band": F.floor(F.col("depth") / band)}),
        "nodes",
    )
    cut = paths.select("conv", "depth", "node").join(nodes.select("node", "level", "band"), "node")
    tops = cut.groupBy("conv", "level", "band").agg(F.min_by("node", "depth").alias("top"))
    placed = materialize(nodes.join(tops, ["conv", "level", "band"]), "placed-nodes")
    rounds = placed.groupBy("band", "level").agg(F.count("*").alias("n")).collect()
    sums = spark.createDataFrame([], "parent binary, c_children bigint, c_leaves bigint, c_saved bigint")
    done = None
    for r in sorted(rounds, key=lambda r: (-r["band"], r["level"])):
        part = placed.where((F.col("band") == r["band"]) & (F.col("level") == r["level"]))
        below = sums.groupBy(F.col("parent").alias("node")).agg(*[F.sum(c).alias(c) for c in sums.columns[1:]])
        shard = F.pmod(F.xxhash64("top"), F.lit(max(1, -(-r["n"] // shard_nodes))))
        found = materialize(
            part.join(below, "node", "left").fillna(0, sums.columns[1:]).withColumn("shard", shard)
            .groupBy("shard").applyInPandas(_summed, "node binary, n_children bigint, n_leaves bigint, saved_tokens bigint"),
            "node-sums",
        )
        up = part.where("node = top AND parent IS NOT NULL").select("node", "parent").join(found, "node").select(
            "parent", F.lit(1).cast("bigint").alias("c_children"), F.col("n_leaves").alias("c_leaves"),
            F.col("saved_tokens").alias("c_saved"))
        sums = sums.unionByName(up)
        done = found if done is None else done.unionByName(found)
    owner = nodes.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"))
    return (
        nodes.join(done, "node").join(owner, "parent", "left").join(_ends_hashes(ends), "node", "left")
        .select(
            F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"),
        )
    )


def op12_prefix_trie(spark, sf_dir):
    """The trie of all conversations, each started with turns of the first of its hundred."""
    turns = materialize(marked_turns(table(spark, sf_dir, "conversations")), "turns")
    return prefix_trie(*grafted(turns))


OP12_SQL = """
WITH crc_table AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce([b] || range(8), lambda c, k: if(c & 1 = 1, xor(c >> 1, 3988292384), c >> 1)) AS c
    FROM range(256) r(b))
), turns AS (
  SELECT conv_id AS c, mark, chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, mark) - 1 AS pos
  FROM (SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
          sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS mark
        FROM conversations WHERE conv_id IS NOT NULL)
), convs AS (
  SELECT c, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(c::VARCHAR)), '..'), lambda x: ('0x' || x)::BIGINT),
                            lambda s, x: xor(s >> 8, t[(xor(s, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT c FROM turns), crc_table
), lent AS (
  SELECT v.c, t.mark, t.chars, t.pos FROM convs v JOIN turns t ON t.c = v.c - v.c % 100 AND t.pos < v.h
), rebuilt AS (
  SELECT c, mark, chars, 0 AS own, pos FROM lent
  UNION ALL SELECT c, mark, chars, 1, pos FROM turns JOIN convs USING (c) WHERE pos >= h
), numbered AS (
  SELECT c, mark, chars, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS d FROM rebuilt
), prefixes AS (
  SELECT c, d, chars, array_to_string(list(mark) OVER (PARTITION BY c ORDER BY d), '') AS key FROM numbered
  UNION ALL SELECT c, 0, 0, '' FROM convs
), nodes AS (
  SELECT key, min(c) AS conv_id, max(d) AS depth, count(*) AS n_convs, max(chars) AS chars FROM prefixes GROUP BY key
), children AS (
  SELECT left(key, -64) AS key, count(*) AS n FROM nodes WHERE key <> '' GROUP BY 1
), below AS (
  SELECT p.key, sum((n.n_convs - 1) * n.chars) AS saved, count(*) FILTER (WHERE k.n IS NULL) AS leaves
  FROM nodes n LEFT JOIN children k USING (key) JOIN prefixes p ON p.c = n.conv_id AND p.d <= n.depth GROUP BY p.key
), ends AS (
  SELECT key, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS s
  FROM (SELECT c, max_by(key, d) AS key FROM prefixes GROUP BY c) GROUP BY key
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0)::BIGINT AS n_children,
  b.leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, coalesce(e.s, sha256('')) AS ends_sha256
FROM nodes n JOIN below b USING (key) LEFT JOIN children k USING (key) LEFT JOIN ends e USING (key)
LEFT JOIN nodes p ON n.key <> '' AND p.key = left(n.key, -64)
"""
