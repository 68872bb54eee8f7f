"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.session import stored


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node) for all nodes of the undirected links (u, v).

    Each round joins every node's links to the smallest node near it, first those to larger nodes, then
    those to smaller ones, until all links are stars. The links of a node are never gathered: minima are
    partial aggregates, and a node with very many links is only the left side of a join with one row.
    """
    now = stored(links.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).where("a <> b").distinct())
    before, state = None, _state(now)
    while state != before and state[0]:
        both = now.union(now.select("b", "a"))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = stored(both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(moved.union(lowest.select("a", "m")).distinct())
        before, state = state, _state(now)
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
