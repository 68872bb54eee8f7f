"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document is its set of word shingles. The sketch has ``COORDINATES`` coordinates. In round ``i`` of
the first half every shingle is thrown into a hashed bin with a hashed value, and a bin keeps its
smallest value of the earliest round that filled it; in round ``t + i`` all shingles go to bin ``i``, so
every coordinate is filled in the end. A set of n shingles is done after about t log t / n rounds, and
the share of equal coordinates is concentrated round the Jaccard similarity as with one hash per
coordinate. Documents with an equal band of coordinates are candidates, and candidates are links only
if their full sets say so.

Groups of any size: equal sets are one class. In a band's bucket each class is compared with one
pivot, so a bucket of n classes gives n - 1 candidates, not n squared. Components come from those
links. What then still shares a bucket with another component is searched to the end: shingles that no
other document of these buckets has cannot be in an intersection, and the others are counted in parts of
the hash space: a pair's intersection is at most the sum of the smaller counts. What this bound leaves is
compared with other pivots for a few turns, which joins most components that links join. Then all pairs of
different components that the bound leaves are verified too. So no link between candidates is lost.

With 32 bands of 4, a pair of similarity 0.8 misses every band with probability 5e-8.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm import tokens
from tradewind.llm.columns import fresh, small_batches
from tradewind.llm.graph import components
from tradewind.session import stored

COORDINATES = 128
BAND_ROWS = 4
SIMILARITY = 80  # in hundredths
PARTS = 128  # of the shingles, for the bound on intersections
TURNS = 4  # at other pivots, before all pairs that are left
CHUNK_BYTES = 1 << 20
_NONE = np.uint64(2**64 - 1)
_SEEDS = tokens.mix(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BAND_FACTORS = tokens.mix(np.arange(1, COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)


def sketches(sets: list[np.ndarray], t: int = COORDINATES) -> np.ndarray:
    """A row of ``t`` coordinates (a power of two up to 128) for each set; empty sets stay unfilled."""
    shift = np.uint64(64 - t.bit_length() + 1)
    low = np.uint64(2**56 - 1)
    out = np.full((len(sets), t), _NONE, dtype=np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    items = np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)
    flat = out.reshape(-1)
    for i in range(2 * t):
        if not len(items):
            break
        hashed = tokens.mix(items ^ _SEEDS[i])
        bins = (hashed >> shift).astype(np.int64) if i < t else i - t
        # The round is in the high byte, so a value of a later round never replaces an earlier one.
        np.minimum.at(flat, owner * t + bins, np.uint64(i << 56) | (tokens.mix(hashed) & low))
        open_rows = (out == _NONE).any(axis=1)
        going = open_rows[owner]
        items, owner = items[going], owner[going]
    return out


def bands(sketch: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """One 64-bit key for each band of coordinates."""
    n, t = sketch.shape
    spread = tokens.mix(sketch) * _BAND_FACTORS[:t]
    return tokens.mix(spread.reshape(n, t // rows, rows).sum(axis=2, dtype=np.uint64))


def set_key(items: np.ndarray) -> bytes:
    """128 bits that stand for a set of hashes."""
    a = int(tokens.mix(items ^ np.uint64(0x243F6A8885A308D3)).sum(dtype=np.uint64))
    b = int(tokens.mix(items ^ np.uint64(0x13198A2E03707344)).sum(dtype=np.uint64))
    return a.to_bytes(8, "big") + b.to_bytes(8, "big")


def _sets(text: pa.Array, size: int) -> list[np.ndarray]:
    texts = [t or b"" for t in text.cast(pa.binary()).to_pylist()]
    sets: list[np.ndarray] = []
    for a, b in tokens.slices([len(t) for t in texts], CHUNK_BYTES):
        sets += tokens.shingle_sets(texts[a:b], size)
    return sets


def signature(text: Column, size: int) -> Column:
    """struct n, node, bands: size of the set, its key, and its band keys; without words 0, null, null."""

    @F.arrow_udf("struct<n: bigint, node: binary, bands: array<bigint>>")
    def sign(text: pa.Array) -> pa.Array:
        texts = [t or b"" for t in text.cast(pa.binary()).to_pylist()]
        n, nodes, keys = [], [], []
        for a, b in tokens.slices([len(t) for t in texts], CHUNK_BYTES):
            sets = tokens.shingle_sets(texts[a:b], size)
            for items, key in zip(sets, bands(sketches(sets)).view(np.int64)):
                n.append(len(items))
                nodes.append(set_key(items) if len(items) else None)
                keys.append(key if len(items) else None)
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(nodes, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
            names=["n", "node", "bands"],
        )

    return sign(text)


def shingle_hashes(text: Column, size: int) -> Column:
    """struct node, items: the set's key and its hashes."""

    @F.arrow_udf("struct<node: binary, items: array<bigint>>")
    def hashes(text: pa.Array) -> pa.Array:
        sets = _sets(text, size)
        return pa.StructArray.from_arrays(
            [pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
             pa.ListArray.from_arrays(
                 pa.array(np.concatenate(([0], np.cumsum([len(s) for s in sets]))), pa.int32()),
                 pa.array(np.concatenate(sets).view(np.int64) if sets else [], pa.int64()))],
            names=["node", "items"],
        )

    # So that a filter on the result does not move it below the join in front of it, onto all rows.
    return hashes.asNondeterministic()(text)


def _close(n: Column, m: Column, common: Column, similarity: int) -> Column:
    """100 * intersection >= similarity * union."""
    return 100 * common >= similarity * (n + m - common)


def _verified(pairs: DataFrame, left: DataFrame, right: DataFrame, similarity: int) -> DataFrame:
    """Those of the pairs (u, v) whose full sets, one in ``left`` and one in ``right``, are similar enough."""
    ours = left.select(F.col("node").alias("u"), F.col("items").alias("x"))
    theirs = right.select(F.col("node").alias("v"), F.col("items").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return pairs.join(ours, "u").join(theirs, "v").where(
        _close(F.size("x"), F.size("y"), common, similarity)).select("u", "v")


def _mixed(members: DataFrame) -> DataFrame:
    """The members whose key still has members of several components."""
    keys = members.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    return members.join(keys.select("key"), "key")


def _live(members: DataFrame, found: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Members of buckets of several components that can still be similar enough to another, with bounds."""
    open_members = stored(_mixed(members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))))
    items = (
        sets.join(open_members.select("node").distinct(), "node", "left_semi")
        .select("node", F.explode("items").alias("item")).withColumn("part", F.pmod("item", F.lit(PARTS)))
    )
    alone = (
        items.groupBy("item", "part").agg(F.count("*").alias("holders"), F.min("node").alias("node")).where("holders = 1")
        .groupBy("node", "part").agg(F.count("*").alias("alone"))
    )
    counted = items.groupBy("node", "part").agg(F.count("*").alias("all")).join(alone, ["node", "part"], "left")
    in_part = F.map_from_entries(F.collect_list(F.struct("part", F.col("all") - F.coalesce("alone", F.lit(0)))))
    profile = counted.groupBy("node").agg(in_part.alias("in_part")).select("node", F.transform(
        F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda q: F.coalesce(F.col("in_part")[q.cast("long")], F.lit(0)).cast("int")).alias("parts"))
    # With s hundredths: intersection <= what both share with others, so n + m <= (100 + s) / s * the smaller one.
    held = F.aggregate("parts", F.lit(0), lambda done, count: done + count)
    bounded = open_members.join(profile, "node").withColumn("reach", F.lit(100 + similarity) * held / F.lit(similarity))
    smallest = bounded.groupBy("key").agg(F.min("n").alias("least_n"))
    return stored(_mixed(bounded.join(smallest, "key").where("n + least_n <= reach").drop("least_n")))


def _fits(a: Column, b: Column, similarity: int) -> Column:
    """Whether members of different components can be similar enough, by their sizes and bounds."""
    # The same bound part by part is close to the intersection itself.
    common = F.aggregate(F.zip_with(a["parts"], b["parts"], lambda x, y: F.least(x, y)), F.lit(0), lambda done, count: done + count)
    return (
        (a["component"] != b["component"])
        & (a["n"] + b["n"] <= F.least(a["reach"], b["reach"]))
        & (100 * F.least(a["n"], b["n"]) >= similarity * F.greatest(a["n"], b["n"]))
        & ((100 + similarity) * common >= similarity * (a["n"] + b["n"]))
    )


def _stars(live: DataFrame, turn: int, similarity: int) -> DataFrame:
    """Pairs (u, v) of each member with one of its bucket, another in every turn."""
    whole = F.struct(*[c for c in live.columns if c != "key"])
    pivots = live.groupBy("key").agg(F.min_by(whole, F.struct(F.xxhash64("node", F.lit(turn)), "node")).alias("pivot"))
    pairs = live.select("key", whole.alias("own")).join(pivots, "key").where(_fits(F.col("own"), F.col("pivot"), similarity))
    return pairs.select(F.least("own.node", "pivot.node").alias("u"), F.greatest("own.node", "pivot.node").alias("v")).distinct()


def _all_pairs(live: DataFrame, similarity: int) -> DataFrame:
    """Each pair (u, v) of different components in one bucket that can be similar enough, in the first of its buckets."""
    keys = live.groupBy("node").agg(F.collect_list("key").alias("keys"))
    row = F.struct(*[c for c in live.columns if c != "key"], "keys")
    sides = stored(live.join(keys, "node").select("key", row.alias("m")))
    a, b = sides.select("key", F.col("m").alias("a")), sides.select("key", F.col("m").alias("b"))
    once = F.array_min(F.array_intersect("a.keys", "b.keys"))
    fits = (a["key"] == b["key"]) & (F.col("a.node") < F.col("b.node")) & _fits(F.col("a"), F.col("b"), similarity)
    return a.join(b, fits & (a["key"] == once)).select(F.col("a.node").alias("u"), F.col("b.node").alias("v"))


def _rest(members: DataFrame, found: DataFrame, sets: DataFrame, tried: DataFrame, similarity: int) -> DataFrame:
    """Links (u, v) between different components among the untried pairs in one bucket.

    At first each member is compared with one of its bucket for ``TURNS`` times at most, as one link settles all
    pairs of two components. Then all pairs of what is still apart are.
    """
    live = _live(members, found, sets, similarity)
    sets = stored(sets.join(live.select("node").distinct(), "node", "left_semi"))
    links = []
    for turn in range(TURNS):
        pairs = stored(_stars(live, turn, similarity).join(tried, ["u", "v"], "left_anti"))
        if pairs.isEmpty():
            break
        tried = tried.union(pairs)
        new = stored(_verified(pairs, sets, sets, similarity))
        if new.isEmpty():
            break
        links.append(new)
        labels = live.select("node", "component").distinct()
        between = new.join(labels.toDF("u", "a"), "u").join(labels.toDF("v", "b"), "v").select(F.col("a").alias("u"), F.col("b").alias("v"))
        moved = components(between).select(F.col("node").alias("component"), F.col("component").alias("now"))
        merged = live.join(moved, "component", "left").withColumn("component", F.coalesce("now", "component")).select(*live.columns)
        live = stored(_mixed(merged))
    pairs = _all_pairs(live, similarity).join(tried, ["u", "v"], "left_anti")
    return reduce(DataFrame.union, links, _verified(pairs, sets, sets, similarity))


def classes_of(docs: DataFrame, size: int, similarity: int) -> tuple[DataFrame, DataFrame]:
    """Documents with their class, and the classes' components.

    The first has doc_id, text_key, n, node; the second node and component, for classes with links only.
    """
    small_batches(docs.sparkSession)
    signed = stored(
        docs.select("doc_id", F.xxhash64("text").alias("text_key"), signature(docs["text"], size).alias("s"))
        .select("doc_id", "text_key", "s.*")
    )
    # The row whose text stands for the class: its id and text key, as one hash.
    holder = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("row")
    classes = signed.where("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.first("bands").alias("bands"), holder)
    members = classes.select("node", "n", F.explode("bands").alias("key"))
    pivots = members.groupBy("key").agg(F.min(F.struct("node", "n")).alias("pivot"), F.count("*").alias("members")).where("members > 1")
    shared = stored(members.join(pivots.select("key", "pivot"), "key"))
    star = stored(
        shared.where("node <> pivot.node")
        .where(100 * F.least("n", "pivot.n") >= similarity * F.greatest("n", "pivot.n"))
        .select(F.col("pivot.node").alias("u"), F.col("node").alias("v")).distinct()
    )
    # The classes in question, and on which side of the pairs they are, so that only those are sent there.
    no, yes = F.lit(False), F.lit(True)
    sides = (
        shared.select("node", no.alias("left"), no.alias("right"))
        .union(star.select("u", yes, no)).union(star.select("v", no, yes))
        .groupBy("node").agg(F.bool_or("left").alias("left"), F.bool_or("right").alias("right"))
    )
    wanted = classes.select(F.xxhash64("row.doc_id", "row.text_key").alias("holder"), F.col("node").alias("wanted")).join(
        sides.withColumnRenamed("node", "wanted"), "wanted")
    sets = stored(
        docs.select(F.xxhash64("doc_id", F.xxhash64("text")).alias("holder"), "text").join(wanted, "holder")
        .select("holder", "wanted", "left", "right", shingle_hashes(F.col("text"), size).alias("s"))
        .where(F.col("s.node") == F.col("wanted"))
        .groupBy("holder", "wanted", "left", "right").agg(F.first("s.items").alias("items"))
        .select(F.col("wanted").alias("node"), "left", "right", "items")
    )
    links = stored(_verified(star, sets.where("left"), sets.where("right"), similarity))
    found = stored(components(links))
    more = stored(_rest(shared.select("key", "node", "n"), found, sets.select("node", "items"), star, similarity))
    if not more.isEmpty():
        found = components(more.union(found.select(F.col("node").alias("u"), F.col("component").alias("v"))))
    return signed.drop("bands"), found


def near_groups(docs: DataFrame, size: int = 5, similarity: int = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, text_key, component.

    Texts are lower-cased (A-Z) and split at blanks and control spaces. Fewer than ``size`` words are
    one shingle; no words, or a null text, are an empty set that is linked with nothing.
    ``component_id`` is the smallest doc_id that links reach; ``kept`` says that it is the document's own.
    Null ids are ignored in the minimum unless there is no other. Only ``doc_id`` and ``text`` are read.
    """
    signed, found = classes_of(docs, size, similarity)
    told = signed.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = told.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("lowest"))
    component_id = F.when(F.col("n") > 0, F.col("lowest")).otherwise(F.col("doc_id"))
    return told.join(lowest, "component", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component_id.alias("component_id"),
        component_id.eqNullSafe(F.col("doc_id")).alias("kept"), "text_key", "component",
    )


def drop_near_copies(docs: DataFrame, size: int = 5, similarity: int = SIMILARITY) -> DataFrame:
    """The documents of which ``near_groups`` keeps one for each component, with all their columns.

    Of rows that repeat id and text, one stays. Documents without words all stay.
    """
    theirs, their_key = fresh(docs, "kept_id"), fresh(docs, "kept_key")
    key, turn = fresh(docs, "text_key"), fresh(docs, "turn")
    groups = near_groups(docs, size, similarity).where("kept")
    # Texts that differ but share id and component: one of them stays. Without words, each is its own.
    own = F.when(F.col("n_shingles") == 0, F.col("text_key"))
    keepers = groups.groupBy("doc_id", "component", own.alias("own")).agg(F.min("text_key").alias(their_key)).select(
        F.col("doc_id").alias(theirs), their_key)
    ours = docs.withColumn(key, F.xxhash64(docs["text"]))
    kept = ours.join(keepers, F.col(key).eqNullSafe(F.col(their_key)) & ours["doc_id"].eqNullSafe(F.col(theirs)), "left_semi")
    once = F.row_number().over(Window.partitionBy(key, "doc_id").orderBy("text"))
    return kept.withColumn(turn, once).where(F.col(turn) == 1).select(*docs.columns)
