"""Exact dedup by deterministic block naming.

The normalised text of a document is cut into blocks of a fixed number of characters. The distinct blocks at a
position, over all documents, are sorted and numbered; then adjacent numbers are paired, and the distinct pairs
numbered again, until one number is left for each document. That number is the document's identity: two
documents have the same one if and only if their texts are equal, as every number stands for exactly one block
or pair. Groups are documents with one identity.

Blocks are sorted by a 64-bit hash first and by their content second, so content is compared only where a hash
is shared: a block that is alone with its hash has its place in the order whatever it holds. Blocks that share
a hash are reduced to their distinct contents, and contents that collide in a hash get different numbers.
A document is finished at the level where it has one number left; the level is part of the identity, as
documents with different numbers of levels have different lengths.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.columns import SPACE_CLASS, fresh, ranked, whole
from tradewind.session import stored

BLOCK_CHARS = 16_384
#: Levels an identity can hold: 2^63 blocks.
_LEVELS = 64


def normalised(text: Column) -> Column:
    """The text without blanks and control spaces; null counts as empty."""
    return F.regexp_replace(whole(text), f"{SPACE_CLASS}+", "")


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def _blocks(body: Column, block_chars: int) -> Column:
    """The blocks of a normalised text; an empty one has one empty block."""
    found = F.regexp_extract_all(body, F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("")))


def hash_of(block: Column) -> Column:
    """What blocks are sorted by first."""
    return F.xxhash64(block)


def _contents(docs: DataFrame, block_chars: int, first: Callable[[Column], Column]) -> DataFrame:
    """digest, doc_id, n_points, pos, key, block of all blocks."""
    return (
        docs.select("doc_id", F.char_length(whole(F.col("text"))).alias("n_points"), _digest(F.col("text")).alias("digest"),
                    F.posexplode(_blocks(normalised(F.col("text")), block_chars)).alias("pos", "block"))
        .withColumn("key", first(F.col("block")))
    )


def _collisions(docs: DataFrame, shared: DataFrame, block_chars: int, first: Callable[[Column], Column]) -> DataFrame:
    """pos, key, block, place: the contents that share a hash with another content, sorted within it."""
    contents = _contents(docs, block_chars, first).select("pos", "key", "block").join(shared, ["pos", "key"], "left_semi").distinct()
    in_order = Window.partitionBy("pos", "key")
    return stored(
        contents.withColumn("contents", F.count("*").over(in_order)).where("contents > 1")
        .select("pos", "key", "block", (F.row_number().over(in_order.orderBy("block")) - 1).alias("place"))
    )


def _numbered(parts: DataFrame, content: list[str]) -> DataFrame:
    """``parts`` (pos and ``content``) with ``name``, the number of their content among those at the position."""
    distinct = stored(parts.select("pos", *content).distinct())
    # Stored, so that the join reads both sides from shuffles and AQE can split a name that very many have.
    return parts.join(stored(ranked(distinct, "pos", content, "name")), ["pos", *content])


def identities(docs: DataFrame, rows: DataFrame, block_chars: int = BLOCK_CHARS, first: Callable[[Column], Column] = hash_of) -> DataFrame:
    """row and identity of each of ``rows`` (row, digest, doc_id, n_points, keys: the hashes of its blocks)."""
    level = rows.select("row", F.posexplode("keys").alias("pos", "key"))
    holders = level.groupBy("pos", "key").agg(F.count("*").alias("holders"))
    collided = _collisions(docs, holders.where("holders > 1").select("pos", "key"), block_chars, first)
    if collided.isEmpty():
        level = level.withColumn("place", F.lit(0))
    else:
        held = _contents(docs, block_chars, first).join(collided, ["pos", "key", "block"]).select(
            "digest", F.col("doc_id").alias("held_id"), F.col("n_points").alias("held_points"), "pos", "place").distinct()
        on = (rows["digest"] == held["digest"]) & rows["doc_id"].eqNullSafe(held["held_id"]) & (rows["n_points"] == held["held_points"])
        places = rows.join(held, on).select("row", "pos", "place")
        level = level.join(places, ["row", "pos"], "left").withColumn("place", F.coalesce("place", F.lit(0)))
    level = stored(_numbered(level, ["key", "place"]).select("row", "pos", "name"))
    sizes = rows.select("row", F.size("keys").alias("left"))
    most = rows.agg(F.max(F.size("keys"))).first()[0] or 1
    if most == 1:
        return level.select("row", (F.col("name") * _LEVELS).alias("identity"))
    level = stored(level.join(sizes, "row"))
    out, step = None, 0
    while True:
        done = level.where("left = 1").select("row", (F.col("name") * _LEVELS + step).alias("identity"))
        out = done if out is None else out.union(done)
        if most == 1:
            return out
        side = F.col("pos") % 2
        pairs = level.where("left > 1").groupBy("row", "left", F.expr("pos div 2").cast("int").alias("pos")).agg(
            F.max(F.when(side == 0, F.col("name"))).alias("one"),
            F.coalesce(F.max(F.when(side == 1, F.col("name"))), F.lit(-1)).alias("other"),
        )
        level = stored(_numbered(stored(pairs), ["one", "other"]).select(
            "row", "pos", "name", F.expr("(left + 1) div 2").cast("int").alias("left")))
        most, step = (most + 1) // 2, step + 1


def document_groups(docs: DataFrame, block_chars: int = BLOCK_CHARS, first: Callable[[Column], Column] = hash_of) -> DataFrame:
    """One row per document: doc_id, n_points, keep_id, group_size, kept, text_sha256.

    Of equal texts, the one with the most code points before normalisation, then the smallest
    doc_id, stays (a null doc_id counts as smallest). Null texts count as empty, and empty texts
    equal each other. Of rows repeated with the same doc_id, one stays. Very long texts are more blocks. Only
    ``doc_id`` and ``text`` are read; other columns do not matter. No rows give no rows. ``first`` is
    what blocks are sorted by before their content; it changes no result.
    """
    # The digest tells rows of one doc_id apart and is the contract's text_sha256; it groups nothing.
    rows = stored(
        docs.select("doc_id", F.char_length(whole(F.col("text"))).alias("n_points"), _digest(F.col("text")).alias("digest"),
                    F.transform(_blocks(normalised(F.col("text")), block_chars), first).alias("keys"))
        .groupBy("digest", "doc_id", "n_points", "keys").agg(F.count("*").alias("rows"))
        .withColumn("row", F.monotonically_increasing_id())
    )
    told = stored(rows.drop("keys").join(identities(docs, rows, block_chars, first), "row"))
    groups = told.groupBy("identity").agg(
        F.min(F.struct((-F.col("n_points")).alias("points"), F.col("doc_id").alias("id"))).alias("best"),
        F.sum("rows").alias("group_size"),
    )
    best = (-F.col("best.points") == F.col("n_points")) & F.col("best.id").eqNullSafe(F.col("doc_id"))
    return (
        told.join(groups, "identity")
        .withColumn("repeat", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
        .select("doc_id", "n_points", F.col("best.id").alias("keep_id"), "group_size",
                (best & (F.col("repeat") == 1)).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
    )


def drop_copies(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that stay, with all their columns; see ``document_groups``."""
    key, points, turn = (fresh(docs, name) for name in ("kept_id", "kept_points", "turn"))
    digest, theirs = fresh(docs, "digest"), fresh(docs, "kept_digest")
    keepers = document_groups(docs, block_chars).where("kept").select(
        F.col("doc_id").alias(key), F.col("n_points").alias(points), F.unhex("text_sha256").alias(theirs)
    )
    ours = docs.withColumn(digest, _digest(docs["text"]))
    kept = ours.join(
        keepers,
        (F.col(digest) == F.col(theirs)) & ours["doc_id"].eqNullSafe(F.col(key))
        & (F.char_length(whole(ours["text"])) == F.col(points)),
        "left_semi",
    )
    # Rows repeated with the same id and text meet in the partition of the join.
    once = F.row_number().over(Window.partitionBy(digest, "doc_id").orderBy("text"))
    return kept.withColumn(turn, once).where(F.col(turn) == 1).select(*docs.columns)
