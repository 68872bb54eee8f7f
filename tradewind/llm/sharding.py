"""Sharding by a hierarchical weighted hash tree.

Regions hold racks and racks hold shards. A document descends the tree: at each level every child
draws a number from a hash of the document's id and the child's name, stretched by the child's
weight (``ln(u) / weight``), and the highest draw wins. A child wins with a probability in
proportion to its weight, whatever the other children are. When a weight changes, draws of other
children do not, so documents move only into or out of the subtree whose weight changed.

``tree_of`` fills regions one after the other; a shard beyond full regions opens a region, which
is the only subtree that changes then, so the new shard takes documents only into itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.columns import bytes_of, ranked, whole
from tradewind.session import stored

# region -> rack -> shard -> weight
Tree = dict[int, dict[int, dict[int, float]]]


def tree_of(shards: int, racks_in_region: int = 2, shards_in_rack: int = 4) -> Tree:
    """A tree of equal shards, numbered from 0, filled region by region and rack by rack."""
    tree: Tree = {}
    for shard in range(shards):
        rack = shard // shards_in_rack
        tree.setdefault(rack // racks_in_region, {}).setdefault(rack, {})[shard] = 1.0
    return tree


def _winner(key: Column, level: str, weights: dict[int, float]) -> Column:
    """The child with the highest draw among those with a positive weight."""
    draws = []
    for child, weight in sorted(weights.items()):
        if weight > 0:
            bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(level), F.lit(child)), 11)
            draw = F.log((bits.cast("double") + 0.5) / F.lit(float(2**53))) / F.lit(float(weight))
            draws.append(F.struct(draw.alias("draw"), F.lit(child).alias("child")))
    return F.array_max(F.array(*draws))["child"]


def _below(chosen: Column, options: dict[int, Column]) -> Column:
    picked = None
    for child, result in options.items():
        picked = F.when(chosen == child, result) if picked is None else picked.when(chosen == child, result)
    return picked


def place(docs: DataFrame, key: str, tree: Tree, prefix: str = "") -> DataFrame:
    """``docs`` with columns region, rack and shard (after ``prefix``), from ``key`` and the tree alone."""
    rack_weights = {r: {k: sum(shards.values()) for k, shards in racks.items()} for r, racks in tree.items()}
    region_weights = {r: sum(weights.values()) for r, weights in rack_weights.items()}
    if not any(weight > 0 for weight in region_weights.values()):
        raise ValueError("the tree has no shard with a positive weight")
    live = {r: racks for r, racks in rack_weights.items() if region_weights[r] > 0}
    shelves = {k: tree[r][k] for r, racks in live.items() for k, weight in racks.items() if weight > 0}
    region, rack, shard = f"{prefix}region", f"{prefix}rack", f"{prefix}shard"
    return (
        docs.withColumn(region, _winner(F.col(key), "region", region_weights))
        .withColumn(rack, _below(F.col(region), {r: _winner(F.col(key), "rack", racks) for r, racks in live.items()}))
        .withColumn(shard, _below(F.col(rack), {k: _winner(F.col(key), "shard", shards) for k, shards in shelves.items()}))
    )


def shard_documents(docs: DataFrame, shards: int, tree: Tree | None = None, grown: Tree | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, region, rack, shard, slot, grown_shard.

    Law ``key``: id and tree decide. ``size`` is the text's UTF-8 bytes plus 8, ``text_crc32`` its
    unsigned CRC-32; null counts as empty. ``grown_shard`` is the place in a tree with one more
    shard. Rows with the same id share a shard and get slots of their own; null ids share one
    shard. Only ``doc_id`` and ``text`` are read.
    """
    tree = tree or tree_of(shards)
    grown = grown or tree_of(shards + 1)
    rows = docs.select("doc_id", (bytes_of(F.col("text")) + 8).alias("size"),
                       F.crc32(whole(F.col("text"))).alias("text_crc32"))
    # Read twice below; the texts should not be.
    placed = stored(place(place(rows, "doc_id", tree), "doc_id", grown, "grown_"))
    return ranked(placed, "shard", ["doc_id", "text_crc32", "size"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "region", "rack", "shard", "slot", "grown_shard"
    )
