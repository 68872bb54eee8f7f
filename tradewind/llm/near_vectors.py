"""Near-duplicate embeddings by int8 quantised tile products with rigorous error bounds.

Vectors are compared within their label. Each distinct vector of a label is one class; classes are dealt
into tiles of at most ``TILE_ROWS``, and each pair of tiles of a label is one row of work, so a label with
most of the rows is many rows of work. In a pair of tiles, unit vectors are rounded to int8:
``x = s q + e`` with ``|q| <= 127``. Products of the quantised vectors are whole numbers (below 2^24 for
1024 dimensions at a time, hence exact in single precision). With X = s q,

    x·y = X·Y + X·e_y + e_x·y,   so   |x·y - X·Y| <= |X| |e_y| + |e_x|

as y is a unit vector. The lengths |X| and |e| are measured for each vector, not estimated. Only pairs
whose product could reach the threshold are computed again, in double precision from the full vectors.

A pair of tiles answers with the number of links of each class and with a spanning forest of its links:
at most a row for each class, however many pairs are linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.columns import ranked, small_batches
from tradewind.llm.graph import components
from tradewind.session import stored

SIMILARITY = 0.98
TILE_ROWS = 4096
TILE_BYTES = 4 << 20
STRIP = 256  # rows of a tile that are multiplied at once
DIMS_AT_ONCE = 1024  # 127 * 127 * 1024 < 2^24
PAIRS_AT_ONCE = 1 << 15  # pairs that are computed again at once
#: Rounding of the bounds themselves.
SLACK = 1e-6
_KEY = ["label", "dims"]


def comparable(vector: Column) -> Column:
    """The vector is there, all its entries are finite, and one is not zero."""
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(True)) & F.exists(vector, lambda c: c != 0)


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaling by a power of two first keeps squares in range."""
    _, exponent = np.frexp(np.abs(x).max(axis=1))
    x = np.ldexp(x, -exponent[:, None])
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


class Quantised:
    """int8 rows with their scales, and what a product of two rows can be off by."""

    def __init__(self, unit: np.ndarray) -> None:
        self.scale = np.abs(unit).max(axis=1) / 127
        self.rows = np.rint(unit / self.scale[:, None]).astype(np.int8)
        rounded = self.rows * self.scale[:, None]
        self.length = np.sqrt(np.einsum("ij,ij->i", rounded, rounded))
        self.single = self.rows.astype(np.float32)
        rest = unit - rounded
        self.error = np.sqrt(np.einsum("ij,ij->i", rest, rest))

    def could_reach(self, other: Quantised, start: int, stop: int, threshold: float) -> np.ndarray:
        """Which products of rows start to stop with the rows of ``other`` may be ``threshold`` or more."""
        total = np.zeros((stop - start, len(other.rows)))
        for d in range(0, self.rows.shape[1], DIMS_AT_ONCE):
            total += self.single[start:stop, d : d + DIMS_AT_ONCE] @ other.single[:, d : d + DIMS_AT_ONCE].T
        total *= self.scale[start:stop, None]
        total *= other.scale[None, :]
        bound = self.length[start:stop, None] * other.error[None, :] + self.error[start:stop, None]
        return total + bound + SLACK >= threshold


def links_of(left: np.ndarray, right: np.ndarray, same: bool, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index arrays of linked rows of two tiles of full vectors, strip by strip; i < j where they are the same."""
    x, y = unit_rows(left), unit_rows(right)
    p, q = Quantised(x), Quantised(y)
    for start in range(0, len(x), STRIP):
        stop = min(start + STRIP, len(x))
        i, j = np.nonzero(p.could_reach(q, start, stop, threshold))
        i += start
        if same:
            i, j = i[i < j], j[i < j]
        for at in range(0, len(i), PAIRS_AT_ONCE):
            a, b = i[at : at + PAIRS_AT_ONCE], j[at : at + PAIRS_AT_ONCE]
            linked = np.einsum("ij,ij->i", x[a], y[b]) >= threshold
            yield a[linked], b[linked]


def join_up(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the trees of a and b, in place; each node points at the smallest of its tree."""
    while True:
        x, y = roots[a], roots[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(roots, np.maximum(x, y), np.minimum(x, y))
        while True:
            nearer = roots[roots]
            if (nearer == roots).all():
                break
            roots[:] = nearer


def compare(left: np.ndarray, right: np.ndarray, same: bool, copies: tuple[np.ndarray, np.ndarray], threshold: float):
    """Links of each row of the left and the right tile, counting copies, and a forest of (node, root).

    Nodes of the right tile follow those of the left one; a tile against itself has one set of nodes.
    """
    shift = 0 if same else len(left)
    counts = np.zeros(shift + len(right), dtype=np.int64)
    roots = np.arange(len(counts))
    for a, b in links_of(left, right, same, threshold):
        b = b + shift
        np.add.at(counts, a, copies[1][b - shift])
        np.add.at(counts, b, copies[0][a])
        join_up(roots, a, b)
    return counts, roots


_RESULT = "array<struct<node: bigint, links: bigint, root: bigint>>"


def _tile_pairs(threshold: float):
    @F.arrow_udf(_RESULT)
    def linked(a: pa.Array, b: pa.Array, same: pa.Array) -> pa.Array:
        out = []
        for ours, theirs, one in zip(a, b, same.to_pylist()):
            x, nodes, copies = _tile(ours)
            y, their_nodes, their_copies = (x, nodes, copies) if one else _tile(theirs)
            counts, roots = compare(x, y, one, (copies, their_copies), threshold)
            names = nodes if one else np.concatenate((nodes, their_nodes))
            some = np.nonzero(counts)[0]
            out.append((names[some], counts[some], names[roots[some]]))
        ends = np.cumsum([0, *(len(o[0]) for o in out)])
        columns = [np.concatenate([o[k] for o in out]) if out else np.empty(0, dtype=np.int64) for k in range(3)]
        items = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["node", "links", "root"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)

    return linked


def _tile(members: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = members.values
    vectors = rows.field("vector")
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    nodes = rows.field("node").to_numpy(zero_copy_only=False)
    return flat.reshape(len(nodes), -1), nodes, rows.field("copies").to_numpy(zero_copy_only=False)


def _digest(vector: Column) -> Column:
    """Stands for the vector's exact entries (SHA-256)."""
    return F.unhex(F.sha2(F.array_join(vector.cast("array<string>"), " "), 256))


def near_vectors(vectors: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors (column ``embedding``) of one ``label`` with a cosine of ``threshold`` or more are linked.
    ``n_links`` counts the other rows that a row is linked with directly, its exact copies included;
    ``component_id`` is the smallest vec_id that links reach, the row's own included (null ids only if there
    is no other); ``kept`` says that it is the row's own. Rows with a null label, and vectors that are null,
    empty, zero or have null or non-finite entries, link with nothing, as do vectors of different lengths.
    Repeated rows are rows of their own. Only vec_id, embedding and label are read; no rows give no rows.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    vector = F.col("embedding")
    live = F.col("label").isNotNull() & comparable(vector)
    rows = vectors.select("vec_id", "label", F.size("embedding").alias("dims"), "embedding", live.alias("live"))
    # Rows that are not compared get short keys, which meet no digest and spread over all tasks.
    spread = F.unhex(F.md5(F.concat_ws(" ", F.col("vec_id").cast("string"), F.xxhash64("embedding").cast("string"))))
    marked = rows.withColumn("digest", F.when(F.col("live"), _digest(vector)).otherwise(spread))
    classes = stored(
        marked.where("live").groupBy(*_KEY, "digest")
        .agg(F.first("embedding").alias("vector"), F.count("*").alias("copies"), F.min("vec_id").alias("low_id"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    answers = stored(_answers(classes, threshold))
    counts = answers.groupBy("node").agg(F.sum("links").alias("links"))
    found = components(answers.select(F.col("node").alias("u"), F.col("root").alias("v")))
    told = (
        classes.drop("vector").join(counts, "node", "left").join(found, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    lowest = told.groupBy("component").agg(F.min("low_id").alias("component_id"))
    told = told.join(lowest, "component").select(
        *_KEY, "digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id", F.lit(True).alias("classed"))
    component_id = F.when(F.col("classed"), F.col("component_id")).otherwise(F.col("vec_id"))
    return marked.drop("embedding").join(told, [*_KEY, "digest"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component_id.alias("component_id"),
        component_id.eqNullSafe(F.col("vec_id")).alias("kept"))


def _answers(classes: DataFrame, threshold: float) -> DataFrame:
    """node, links and root of all pairs of tiles: how many links a class has there, and who it hangs on."""
    fits = F.greatest(F.lit(1), F.least(F.lit(TILE_ROWS), F.lit(TILE_BYTES) / (8 * F.col("dims"))).cast("long"))
    # Places within a label, dealt by the node's hash, so that no task numbers a whole label.
    placed = ranked(classes.withColumn("grp", F.struct(*_KEY)), "grp", ["node"], "place")
    member = F.struct("place", "node", "copies", "vector")
    tiles = stored(
        placed.withColumn("tile", F.expr("place").cast("long") - F.pmod("place", fits)).withColumn("tile", (F.col("tile") / fits).cast("long"))
        .groupBy("grp", "tile").agg(F.sort_array(F.collect_list(member)).alias("members"))
    )
    count = tiles.groupBy("grp").agg((F.max("tile") + 1).alias("n"))
    # The pair {s, t} is asked of s where s + t is even, else of t, so that each tile is asked as often.
    pairs = (
        count.withColumn("s", F.explode(F.expr("sequence(0L, n - 1)"))).repartition("grp", "s").withColumn("t", F.explode(F.expr("sequence(s, n - 1)")))
        .select("grp", F.when((F.col("s") + F.col("t")) % 2 == 0, F.col("s")).otherwise(F.col("t")).alias("first"),
                F.when((F.col("s") + F.col("t")) % 2 == 0, F.col("t")).otherwise(F.col("s")).alias("second"))
    )
    ours = tiles.select("grp", F.col("tile").alias("first"), F.col("members").alias("a"))
    theirs = tiles.select("grp", F.col("tile").alias("second"), F.col("members").alias("b"))
    both = pairs.join(ours, ["grp", "first"]).join(theirs, ["grp", "second"])
    return both.select(F.explode(_tile_pairs(threshold)("a", "b", F.col("first") == F.col("second"))).alias("r")).select("r.*")
