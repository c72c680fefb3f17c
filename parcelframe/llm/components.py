"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelframe.session import discard, stored


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst: long), the component being its smallest node.

    Each round links a node's larger neighbours to its smallest one, then does the same for its smaller ones, until
    nothing changes; the number of rounds grows with the logarithm of the longest path. Every round is written to
    the shared folder, which cuts the lineage, and deleted once the next one is there. Loops, null ends and repeated edges are without effect.
    """
    u, v = F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")
    now = stored(edges.filter("src <> dst").select(u, v).distinct(), "edges")
    before = None
    while (digest := _digest(now)) != before:
        before = digest
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lows = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low"))
        large = both.join(lows, "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        # In large every pair points from a larger to a smaller node already.
        large = stored(large.distinct(), "edges")
        lows = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(lows, "u")
        moved = small.filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        last, now = now, stored(moved.unionByName(lows.select("u", F.col("low").alias("v"))).distinct(), "edges")
        discard(last, large)
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
