"""Merkle manifest of a dataset, with its trees in van Emde Boas layout.

Every document is a leaf; each language has a tree over its leaves, and one more tree stands on the roots
of the languages. A tree has ``FANOUT`` children for each node. Trees are stored in blocks: the aligned
subtree of ``LEVELS`` levels above 4096 nodes is one row, and the roots of a tree's blocks are the nodes of
the next layer of blocks. So a tree of any size is a few tables, and no task holds more than a block.

Within a block digests lie in van Emde Boas order: the upper half of the levels is a subtree that is stored
first, then the subtrees below it, one after the other, each laid out in the same way. ``addresses`` finds
any node by arithmetic, without pointers, both when a block is built and when siblings are read.

Roots are built from the leaves up, one layer after the other. Proofs go the other way: each block hands
the path above it to the blocks it stands on, so siblings above a block are read once for its 4096 leaves.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.llm.columns import small_batches
from tradewind.session import stored

# Fixed by the contract: nodes in a run.
FANOUT = 8
_BITS = 3
#: Levels of a block above its leaves: 8^4 = 4096 leaves.
LEVELS = 4
BLOCK = FANOUT**LEVELS
_WIDTH = 32  # bytes of a digest


def size_of(levels: int) -> int:
    """Nodes of a full subtree with so many levels, leaves included."""
    return (FANOUT**levels - 1) // (FANOUT - 1)


def addresses(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Where the nodes ``index`` at ``depth`` (0: root) lie in a subtree of so many levels."""
    if levels == 1:
        return np.zeros(len(index), dtype=np.int64)
    top = levels // 2
    if depth < top:
        return addresses(top, depth, index)
    under = index >> (_BITS * (depth - top))  # the subtree below the upper half, and the place in it
    within = addresses(levels - top, depth - top, index & ((1 << (_BITS * (depth - top))) - 1))
    return size_of(top) + under * size_of(levels - top) + within


@cache
def _level(levels: int, depth: int) -> np.ndarray:
    return addresses(levels, depth, np.arange(FANOUT**depth))


def _hash(children: list[bytes]) -> bytes:
    return hashlib.sha256("".join(child.hex() for child in children).encode()).digest()


def build(leaves: list[bytes], height: int) -> bytes:
    """The block with ``height`` levels above its leaves, in van Emde Boas order; absent nodes are zero bytes."""
    out = np.zeros((size_of(height + 1), _WIDTH), dtype=np.uint8)
    nodes = leaves
    for depth in range(height, -1, -1):
        places = _level(height + 1, depth)[: len(nodes)]
        out[places] = np.frombuffer(b"".join(nodes), dtype=np.uint8).reshape(-1, _WIDTH)
        if depth:
            nodes = [_hash(nodes[i : i + FANOUT]) for i in range(0, len(nodes), FANOUT)]
    return out.tobytes()


class Block:
    """A stored block of ``count`` leaves."""

    def __init__(self, data: bytes, height: int, count: int) -> None:
        self.data, self.height, self.count = data, height, count

    def node(self, depth: int, index: int) -> bytes:
        at = int(_level(self.height + 1, depth)[index]) * _WIDTH
        return self.data[at : at + _WIDTH]

    def path(self, leaf: int) -> list[tuple[int, list[bytes]]]:
        """For each level from ``leaf`` up: its place in the run and the run's other nodes, left to right."""
        steps = []
        for depth in range(self.height, 0, -1):
            first = leaf // FANOUT * FANOUT
            last = min(first + FANOUT, self.count_at(depth))
            steps.append((leaf - first, [self.node(depth, i) for i in range(first, last) if i != leaf]))
            leaf //= FANOUT
        return steps

    def count_at(self, depth: int) -> int:
        return -(-self.count // FANOUT ** (self.height - depth))


def fold(digest: bytes, path: list[tuple[int, list[bytes]]]) -> bytes:
    """The root that a leaf and its siblings lead to."""
    for place, others in path:
        digest = _hash([*others[:place], digest, *others[place:]])
    return digest


def proof(path: list[tuple[int, list[bytes]]]) -> str:
    return hashlib.sha256("".join(d.hex() for _, others in path for d in others).encode()).hexdigest()


_PATH = "array<struct<place: int, others: binary>>"


def _plain(path: list[tuple[int, list[bytes]]]) -> list[dict]:
    return [{"place": place, "others": b"".join(others)} for place, others in path]


def _unplain(path: list[dict] | None) -> list[tuple[int, list[bytes]]]:
    return [(s["place"], [s["others"][i : i + _WIDTH] for i in range(0, len(s["others"]), _WIDTH)]) for s in path or []]


def leaf_digest(columns: dict[str, Column]) -> Column:
    """SHA-256 of the columns in this order, each as UTF-8 byte count, ``:`` and value, or ``-`` if null."""
    parts = []
    for column in columns.values():
        text = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def in_order(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``rows`` with their ``rank`` within ``tree``, from 0 in the given order, which must leave no ties.

    Rows are dealt out by ranges, numbered within each range, and a range begins where the ranges before it
    end: a tree with most of the rows takes many ranges.
    """
    # Which range a row fell into is kept, as boundaries are sampled and could differ in a second run.
    dealt = stored(rows.repartitionByRange(tree, *order).withColumn("range", F.spark_partition_id()))
    sizes = dealt.groupBy(tree, "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy(tree).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select(tree, "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    within = F.row_number().over(Window.partitionBy(tree, "range").orderBy(*order)) - 1
    return (
        dealt.withColumn("rank", within.cast("long")).join(begins, [tree, "range"])
        .withColumn("rank", F.col("begin") + F.col("rank")).drop("begin", "range")
    )


def _built() -> Column:
    @F.arrow_udf("struct<data: binary, root: binary>")
    def make(leaves: pa.Array, height: pa.Array) -> pa.Array:
        blocks = [build(nodes, h) for nodes, h in zip(leaves.to_pylist(), height.to_pylist())]
        # The root is the first node of its subtree in every half, so it lies at the front.
        return pa.StructArray.from_arrays(
            [pa.array(blocks, pa.binary()), pa.array([b[:_WIDTH] for b in blocks], pa.binary())], names=["data", "root"])

    return make("leaves", "height")


def layers(nodes: DataFrame) -> list[DataFrame]:
    """The layers of blocks over ``nodes`` (tree, rank, digest and a struct ``about``), from the leaves up.

    A layer has tree, block, height, data (van Emde Boas order), root, count, and ``about`` of its leaves (in
    the first layer). The layer in which a tree has one block ends it.
    """
    out: list[DataFrame] = []
    while True:
        first = not out
        counts = nodes.groupBy("tree").agg(F.count("*").alias("n"))
        member = F.struct("rank", "digest", "about") if first else F.struct("rank", "digest")
        steps = [F.when(F.col("n") > FANOUT**k, F.lit(1)).otherwise(F.lit(0)) for k in range(LEVELS)]
        blocks = (
            nodes.withColumn("block", F.expr(f"rank div {BLOCK}"))
            .groupBy("tree", "block").agg(F.sort_array(F.collect_list(member)).alias("members"))
            .join(counts, "tree").withColumn("height", sum(steps[1:], steps[0]))
            .withColumn("leaves", F.col("members.digest")).withColumn("count", F.size("members"))
            .withColumn("built", _built())
            .select("tree", "block", "height", "built.data", "built.root", "count", (F.col("n") <= BLOCK).alias("last"),
                    *([F.col("members.about").alias("about")] if first else []))
        )
        out.append(stored(blocks))
        nodes = out[-1].where("not last").select("tree", F.col("block").alias("rank"), F.col("root").alias("digest"))
        if nodes.isEmpty():
            return out


def roots(built: list[DataFrame]) -> DataFrame:
    """tree and its root (column ``subroot``)."""
    found = None
    for layer in built:
        here = layer.where("last").select("tree", F.col("root").alias("subroot"))
        found = here if found is None else found.union(here)
    return found


def _handed_down(above: DataFrame) -> DataFrame:
    """For each leaf of the blocks ``above`` (with ``upper``, the path over the block): tree, rank and path."""

    @F.arrow_udf(f"array<{_PATH}>")
    def paths(data: pa.Array, height: pa.Array, count: pa.Array, upper: pa.Array) -> pa.Array:
        out = []
        for d, h, n, up in zip(data.to_pylist(), height.to_pylist(), count.to_pylist(), upper.to_pylist()):
            block = Block(d, h, n)
            out.append([_plain(block.path(i)) + (up or []) for i in range(n)])
        return pa.array(out, pa.list_(pa.list_(pa.struct([("place", pa.int32()), ("others", pa.binary())]))))

    each = above.select("tree", "block", F.posexplode(paths("data", "height", "count", "upper")).alias("at", "path"))
    return each.select("tree", (F.col("block") * BLOCK + F.col("at")).alias("block"), "path")


def lowest_paths(built: list[DataFrame], over: DataFrame) -> DataFrame:
    """The first layer with ``upper``: the path from each block's root to the end of ``over`` (tree, path)."""
    upper: DataFrame | None = None
    for layer in reversed(built):
        ends = layer.where("last").join(over.select("tree", F.col("path").alias("upper")), "tree")
        if upper is None:
            below = ends
        else:
            below = ends.unionByName(layer.where("not last").join(upper.withColumnRenamed("path", "upper"), ["tree", "block"]))
        upper = stored(_handed_down(below)) if layer is not built[0] else below
    return upper


def _judged() -> Column:
    """For each leaf of a block of the first layer: leaf, doc_id, proof, and the root its ``checked`` leads to."""
    kind = "array<struct<doc_id: bigint, leaf: binary, proof: string, folded: binary>>"
    arrow = pa.list_(pa.struct([("doc_id", pa.int64()), ("leaf", pa.binary()), ("proof", pa.string()), ("folded", pa.binary())]))

    @F.arrow_udf(kind)
    def judge(data: pa.Array, height: pa.Array, upper: pa.Array, about: pa.Array) -> pa.Array:
        out = []
        for d, h, up, leaves in zip(data.to_pylist(), height.to_pylist(), upper.to_pylist(), about.to_pylist()):
            block, over, rows = Block(d, h, len(leaves)), _unplain(up), []
            for i, leaf in enumerate(leaves):
                path = block.path(i) + over
                rows.append({"doc_id": leaf["doc_id"], "leaf": block.node(h, i), "proof": proof(path), "folded": fold(leaf["checked"], path)})
            out.append(rows)
        return pa.array(out, arrow)

    return judge("data", "height", "upper", "about")


def manifest(docs: DataFrame, columns: list[str], checked: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``columns`` are hashed in this order. ``checked`` gives other values for some of them, as a reader might
    find them later: ``folded_root`` is what they lead to with the stored siblings, and ``verified`` says
    that it is the root. Within a ``lang`` (null is one of its own) leaves ascend by doc_id, nulls first; rows
    with one id ascend by their leaf, and rows that are all alike take any order. Empty texts are texts of
    no bytes, unlike nulls. Only ``columns``, doc_id and lang are read. No rows give no rows.
    """
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    original = {name: F.col(name) for name in columns}
    tree = F.coalesce(F.concat(F.lit("+"), F.col("lang")), F.lit(""))  # null comes first, "" after it
    # Hashed once: dealing out by ranges reads its rows twice.
    leaves = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), tree.alias("tree"), leaf_digest(original).alias("digest"), leaf_digest(original | (checked or {})).alias("checked"),
        F.monotonically_increasing_id().alias("seq")))
    ranked = in_order(leaves, "tree", ["doc_id", "digest", "seq"])
    langs = layers(ranked.select("tree", "rank", "digest", F.struct("doc_id", "checked").alias("about")))
    subroots = in_order(roots(langs).withColumn("whole", F.lit("")), "whole", ["tree"])
    top = layers(subroots.select(F.col("whole").alias("tree"), "rank", F.col("subroot").alias("digest"), F.struct("tree").alias("about")))
    end = roots(top).first()
    if end is None:
        return leaves.select("doc_id", *[F.lit("").alias(n) for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root")],
                             F.lit(True).alias("verified")).limit(0)
    nothing = spark.createDataFrame([("", [])], f"tree string, path {_PATH}")
    first = lowest_paths(top, nothing)
    over = _handed_down(first).select(F.col("block").alias("rank"), "path")
    over = stored(subroots.join(over, "rank").select("tree", "subroot", "path"))
    blocks = lowest_paths(langs, over).join(over.select("tree", "subroot"), "tree")
    each = blocks.select("subroot", F.explode(_judged()).alias("z")).select("subroot", "z.*")

    def text(digest: str) -> Column:
        return F.lower(F.hex(digest))

    root = F.lit(end.subroot.hex())
    return each.select(
        "doc_id", text("leaf").alias("leaf"), text("subroot").alias("subroot"), root.alias("root"),
        F.col("proof").alias("proof_sha256"), text("folded").alias("folded_root"), (text("folded") == root).alias("verified"))
