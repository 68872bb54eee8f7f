"""Whitened embeddings from a bit-sliced scatter matrix.

Entries become whole numbers. Each dimension is shifted by its smallest value, so that its numbers fit
few bits, and the bits of one place over 64 rows are packed into a word: a bit plane. The sum of products
of two dimensions is then a weighted sum of popcounts, ``2^(i + j) * popcount(plane_i & plane_j)``: exact
whole numbers, whatever the order in which tasks are added. Means are taken off as whole numbers too
(``n * sum(xy) - sum(x) * sum(y)``), and only the finished matrix becomes doubles and goes to ``eigh``.

What passes through the driver is the matrix: dimensions squared, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.columns import fresh, small_batches
from tradewind.session import stored

# Fixed by the contract: entries become floor(SCALE * entry) + SHIFT.
SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
#: Scaled entries beyond this count as this, so that they and their differences stay longs.
LIMIT = 2.0**60
#: Rows whose planes are counted at once: 256 words for each plane.
ROWS = 16_384
#: Sums of products leave a task in limbs of so many bits, so that sums over all tasks stay longs.
LIMB_BITS = 20
#: Components with less than this part of the largest variance have none.
NO_VARIANCE = 1e-13


def usable(vector: Column) -> Column:
    """The vector is there and all its entries are finite numbers."""
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(True))


def whole_numbers(vector: Column) -> Column:
    """Entries as longs: ``floor(64 * entry) + 1000000``."""

    def one(c: Column) -> Column:
        c = c.cast("double")
        within = F.greatest(F.least(c, F.lit(LIMIT / SCALE)), F.lit(-LIMIT / SCALE))
        return F.floor(within * SCALE).cast("long") + F.lit(SHIFT)

    return F.transform(vector, one)


def matrix_of(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of ``dims`` longs; shorter vectors are filled up with the number of a zero entry."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = np.diff(column.offsets.to_numpy())
    if len(lengths) and (lengths == dims).all():
        return values.reshape(len(lengths), dims)
    out = np.full((len(lengths), dims), SHIFT, dtype=np.int64)
    out[np.arange(dims)[None, :] < lengths[:, None]] = values
    return out


def planes(x: np.ndarray, bits: list[int]) -> np.ndarray:
    """Bit planes of non-negative ``x``: for each column, lowest bit first, one row of 64-row words."""
    rows = -(-len(x) // 64) * 64
    packed = []
    for d, n in enumerate(bits):
        for bit in range(n):
            plane = np.zeros(rows, dtype=np.uint8)
            plane[: len(x)] = (x[:, d] >> bit) & 1
            packed.append(np.packbits(plane).view(np.uint64))
    return np.array(packed, dtype=np.uint64).reshape(len(packed), rows // 64)


class Scatter:
    """Counts of common bits of all pairs of planes, kept as limbs of the pairs of dimensions."""

    def __init__(self, bits: list[int]) -> None:
        self.bits = bits
        self.owner = np.repeat(np.arange(len(bits)), bits)
        self.place = np.concatenate([np.arange(n) for n in bits] or [np.empty(0, dtype=int)]).astype(int)
        self.starts = np.concatenate(([0], np.cumsum(bits))).astype(int)
        self.common = np.zeros((len(self.owner), len(self.owner)), dtype=np.int64)

    def add(self, x: np.ndarray) -> None:
        for at in range(0, len(x), ROWS):
            words = planes(x[at : at + ROWS], self.bits)
            for p in range(len(words)):
                self.common[p, p:] += np.bitwise_count(words[p:] & words[p]).sum(axis=1, dtype=np.int64)

    def limbs(self) -> Iterator[tuple[int, int, int, int]]:
        """d, e, limb and its value, for d <= e."""
        both = np.triu(self.common) + np.triu(self.common, 1).T
        weight = self.place[:, None] + self.place[None, :]
        for limb in range(int(weight.max(initial=0)) // LIMB_BITS + 1):
            here = weight // LIMB_BITS == limb
            part = np.where(here, both << np.where(here, weight % LIMB_BITS, 0), 0)
            for d, n in enumerate(self.bits):
                if n:
                    rows = part[self.starts[d] : self.starts[d + 1]].sum(axis=0)
                    sums = np.bincount(self.owner, minlength=len(self.bits)) * 0
                    np.add.at(sums, self.owner, rows)
                    for e in range(d, len(self.bits)):
                        if sums[e]:
                            yield d, e, limb, int(sums[e])


@dataclass
class Moments:
    """Exact first and second moments of the fit list; sums are of numbers less ``low``."""

    n: int
    low: list[int]
    high: list[int]
    sums: list[int]
    products: list[list[int]]

    def covariance(self) -> np.ndarray:
        """n² times the covariance is a whole number; it is rounded once, then divided."""
        dims = range(len(self.low))
        return np.array([[float(self.n * self.products[d][e] - self.sums[d] * self.sums[e]) for e in dims] for d in dims]).reshape(
            len(self.low), len(self.low)) / float(self.n) ** 2


def moments(fit: DataFrame, dims: int) -> Moments:
    """Moments of ``fit`` (column x, an array of longs), by two passes: ranges, then bit planes."""

    def ranges(batches):
        low = high = None
        n = 0
        for batch in batches:
            x = matrix_of(batch.column("x"), dims)
            if len(x):
                n += len(x)
                low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
                high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims), pa.int32()), pa.array(low), pa.array(high),
                                              pa.array(np.full(dims, n))], names=["d", "low", "high", "n"])

    found = (
        fit.select("x").mapInArrow(ranges, "d int, low long, high long, n long")
        .groupBy("d").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).orderBy("d").collect()
    )
    low, high = [r.low for r in found], [r.high for r in found]
    bits = [(b - a).bit_length() for a, b in zip(low, high)]

    def scatter(batches):
        counts, sums, any_rows = Scatter(bits), [0] * dims, False
        for batch in batches:
            x = matrix_of(batch.column("x"), dims) - np.array(low, dtype=np.int64)
            any_rows |= len(x) > 0
            counts.add(x)
        if any_rows:
            # A plane's own popcounts, weighted, are the sums of its dimension.
            for p, (d, bit) in enumerate(zip(counts.owner, counts.place)):
                sums[d] += int(counts.common[p, p]) << int(bit)
            rows = list(counts.limbs())
            rows += [(-1, d, k, part) for d in range(dims) for k, part in enumerate(_split(sums[d]))]
            columns = list(zip(*rows)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()),
                                              pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int64())],
                                             names=["d", "e", "limb", "value"])

    sums, products = [0] * dims, [[0] * dims for _ in range(dims)]
    limbs = fit.select("x").mapInArrow(scatter, "d int, e int, limb int, value long").groupBy("d", "e", "limb").agg(
        F.sum("value").alias("value"))
    for r in limbs.collect():
        value = r.value << (LIMB_BITS * r.limb)
        if r.d < 0:
            sums[r.e] += value
        else:
            products[r.d][r.e] += value
            if r.d != r.e:
                products[r.e][r.d] += value
    return Moments(found[0].n if found else 0, low, high, sums, products)


def _split(value: int) -> list[int]:
    out = []
    while value:
        out.append(value & ((1 << LIMB_BITS) - 1))
        value >>= LIMB_BITS
    return out


def axes(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns; each one's largest entry is positive."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values, vectors * signs


def _deviations(x: np.ndarray, m: Moments) -> list[int | None]:
    """Sums over dimensions of (n * x - S)², exact; null beyond a long."""
    spread = max([m.n * (b - a) for a, b in zip(m.low, m.high)], default=0)
    kind = np.int64 if spread * spread * max(len(m.low), 1) < 2**62 else object
    off = (x - np.array(m.low, dtype=np.int64)).astype(kind) * m.n - np.array(m.sums, dtype=kind)
    return [int(v) if v < 2**63 else None for v in (off * off).sum(axis=1)]


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vectors`` with a struct column ``whitening``: n, deviation, identity_error, coordinates.

    ``coordinates`` is an array of component (from 1), whitened and explained, one for each of the first
    ``components`` axes of the column ``embedding``, as far as there are dimensions. The fit takes each
    distinct vector of whole numbers once. Rows whose vector is null or has null or non-finite entries
    are dropped. Shorter vectors, empty ones included, count as followed by zeros. Entries beyond
    2^54 count as 2^54. ``deviation`` is null beyond a long. Axes without variance give null as
    ``whitened`` and are left out of ``identity_error`` (null if all are); without any variance ``explained``
    is null. Repeated rows and ids stay. No usable rows, or only empty vectors, give no components.
    All other columns are kept; one named ``whitening`` is kept and the result gets a ``_`` in front.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    x, out = fresh(vectors, "x"), fresh(vectors, "whitening")
    rows = vectors.where(usable(F.col("embedding"))).withColumn(x, whole_numbers(F.col("embedding")))
    fit = stored(rows.select(F.col(x).alias("x")).distinct())
    dims = fit.agg(F.max(F.size("x"))).first()[0] or 0
    if dims:
        # Vectors that differ only in zeros at the end are one vector of the fit.
        if fit.agg(F.min(F.size("x"))).first()[0] < dims:
            tail = F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(dims) - F.size("x"))
            fit = stored(fit.select(F.concat("x", tail).alias("x")).distinct())
    m = moments(fit, dims)
    covariance = m.covariance() if m.n else np.zeros((0, 0))
    values, unit = axes(covariance, components) if len(covariance) else (np.zeros(0), np.zeros((0, 0)))
    trace = float(np.trace(covariance))
    live = values > (values[0] * NO_VARIANCE if len(values) else 0)
    scaled = unit[:, live] / np.sqrt(values[live])
    means = np.array([float(s) for s in m.sums]) / max(m.n, 1)
    low = np.array(m.low, dtype=np.int64)

    def project(numbers: np.ndarray) -> np.ndarray:
        return ((numbers - low).astype(np.float64) - means) @ scaled

    error = _identity_error(fit, dims, project, m.n, int(live.sum()))
    explained = [float(v) / trace if trace > 0 else None for v in values]
    kind = (
        "struct<n: bigint, deviation: bigint, identity_error: double, "
        "coordinates: array<struct<component: int, whitened: double, explained: double>>>"
    )

    @F.arrow_udf(kind)
    def coordinates(column: pa.Array) -> pa.Array:
        numbers = matrix_of(column, dims)
        rows, k = len(numbers), len(values)
        flat = np.zeros((rows, k))
        flat[:, live] = project(numbers)
        dead = np.broadcast_to(~live, (rows, k)).reshape(-1)
        items = pa.StructArray.from_arrays(
            [pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()), pa.array(flat.reshape(-1), pa.float64(), mask=dead),
             pa.array(explained * rows, pa.float64())], names=["component", "whitened", "explained"])
        lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * k, pa.int32()), items)
        return pa.StructArray.from_arrays(
            [pa.array([m.n] * rows, pa.int64()), pa.array(_deviations(numbers, m), pa.int64()),
             pa.array([error] * rows, pa.float64()), lists],
            names=["n", "deviation", "identity_error", "coordinates"])

    return rows.withColumn(out, coordinates(F.col(x))).select(*vectors.columns, out)


def _identity_error(fit: DataFrame, dims: int, project, n: int, k: int) -> float | None:
    """Largest entry of the whitened fit list's covariance minus the identity, from the rows themselves."""
    if not k:
        return None

    def products(batches):
        total, sums, any_rows = np.zeros((k, k)), np.zeros(k), False
        for batch in batches:
            white = project(matrix_of(batch.column("x"), dims))
            any_rows |= len(white) > 0
            total += white.T @ white
            sums += white.sum(axis=0)
        if any_rows:
            rows = [(a, b, float(total[a, b])) for a in range(k) for b in range(k)] + [(-1, b, float(sums[b])) for b in range(k)]
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()),
                                              pa.array(columns[2], pa.float64())], names=["a", "b", "value"])

    got = fit.select("x").mapInArrow(products, "a int, b int, value double").groupBy("a", "b").agg(F.sum("value").alias("value"))
    second, first = np.zeros((k, k)), np.zeros(k)
    for r in got.collect():
        if r.a < 0:
            first[r.b] = r.value / n
        else:
            second[r.a, r.b] = r.value / n
    return float(np.abs(second - np.outer(first, first) - np.eye(k)).max())
