"""Connected components of any number of links, by alternating large-star and small-star steps.

Each step lets a node point its neighbours at the smallest node it sees. A round is a grouped minimum
and a join, so a hub is combined before the shuffle and its join partition can be split; no
neighbour list is gathered. The links of a round are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _with_smallest(links: DataFrame) -> DataFrame:
    smallest = links.groupBy("u").agg(F.min("v").alias("m"))
    return links.join(smallest, "u")


def _round(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = (
        _with_smallest(both).where("v > u")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
    )
    pointed = _with_smallest(large)
    return (
        pointed.select("u", F.col("m").alias("v"))
        .union(pointed.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        .distinct()
    )


def _checksum(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(20,0)"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` for every linked node; the component is its smallest reachable node.

    Nodes are longs. Repeated links, both directions and self links are fine; nodes without a link
    to another node are left out. No link gives an empty table.
    """
    links = materialize(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "links",
    )
    before = _checksum(links)
    while before[0]:
        links = materialize(_round(links), "links")
        after = _checksum(links)
        if after == before:
            break
        before = after
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
