"""Whitened and near-duplicate embeddings against brute force, on odd rows too."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradewind.llm import near_vectors, queries, whitening

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, digest string, x int, whitening string, node string"


def frame(spark, rows, schema=SCHEMA, parts=3):
    return spark.createDataFrame([(i, v, label, "d", 1, "w", "n") for i, v, label in rows], schema).repartition(parts)


def random_rows(seed, n=300, dims=8, labels=3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(12)]
    rows = []
    for i in range(n):
        c, noise = rng.choice(centres), rng.choice([0.0, 0.02, 0.05, 0.08, 0.1, 0.6])
        scale = rng.choice([1, 1, 0.001, 300])
        rows.append((i, [float(np.float32(scale * (a + rng.gauss(0, noise)))) for a in c], rng.randrange(labels)))
    return rows


ODD = [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 8, 1), (1003, [1.0, None] * 4, 1), (1004, [NAN] * 8, 1), (1005, [INF] * 8, 1),
       (1006, [1.0] * 8, None), (1007, [1.0] * 8, None), (1008, [1.0] * 8, 2), (1009, [1.0] * 7, 2), (1010, [1.0] * 8, 2), (1010, [1.0] * 8, 2),
       (None, [1.0] * 8, 2), (1011, [-0.0, 1.0] * 4, 2), (1012, [0.0, 1.0] * 4, 2), (1013, [1e-40] * 8, 2), (1014, [3e38] * 8, 2)]


# --- whitening


def brute_whitening(rows, dims):
    """n, sums, covariance and the rows that count, from exact whole numbers."""
    used = [(i, v) for i, v, _ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    whole = [(i, [math.floor(64 * c) + 1_000_000 for c in v] + [1_000_000] * (dims - len(v))) for i, v in used]
    fit = sorted({tuple(x) for _, x in whole})
    n, sums = len(fit), [sum(x[d] for x in fit) for d in range(dims)]
    centred = [[n * x[d] - sums[d] for d in range(dims)] for x in fit]
    cov = np.array([[sum(c[a] * c[b] for c in centred) / n**3 for b in range(dims)] for a in range(dims)])
    return whole, n, sums, cov


def test_whitening(spark):
    rows = [r for r in random_rows(1)] + [r for r in ODD if r[0] != 1014]
    whole, n, sums, cov = brute_whitening(rows, 8)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    got = whitening.whiten(frame(spark, rows), components=5)
    assert got.columns == [*SCHEMA.replace(",", "").split()[::2], "_whitening"]
    got = [(r.vec_id, r["_whitening"]) for r in got.collect()]
    assert sorted(str(i) for i, _ in got) == sorted(str(i) for i, _ in whole)
    by_id = {}
    for i, x in whole:
        by_id.setdefault(i, []).append(x)
    for i, w in got:
        x = by_id[i][0]
        assert w.n == n and w.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums)) and w.identity_error < 1e-9
        assert [c.component for c in w.coordinates] == [1, 2, 3, 4, 5]
        want = (np.array([a - s / n for a, s in zip(x, sums)]) @ vectors[:, :5]) / np.sqrt(values[:5])
        assert np.allclose(np.abs([c.whitened for c in w.coordinates]), np.abs(want), rtol=1e-6, atol=1e-7)
        assert np.allclose([c.explained for c in w.coordinates], values[:5] / values.sum(), rtol=1e-9)


def test_whitening_query(spark):
    got = queries.QUERIES["op11_whitening"](spark, "/root/testdata/sf0.001").toPandas().sort_values(["vec_id", "component"])
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").orderBy("vec_id").toPandas()
    x = np.floor(64 * np.stack(table.embedding).astype(float)).astype(int) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov((n * fit - sums).T / n, bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    assert (got.n == n).all() and got.identity_error.max() < 1e-9
    assert (got.deviation.to_numpy()[::16] == ((n * x - sums) ** 2).sum(axis=1)).all()
    want = ((n * x - sums) / n) @ vectors[:, :16] / np.sqrt(values[:16])
    assert np.allclose(np.abs(got.whitened.to_numpy().reshape(-1, 16)), np.abs(want), atol=1e-7)
    assert np.allclose(got.explained.to_numpy()[:16], values[:16] / values.sum(), rtol=1e-9)


def test_whitening_without_variance(spark):
    one = whitening.whiten(frame(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)])).collect()
    assert [(r["_whitening"].n, r["_whitening"].deviation, r["_whitening"].identity_error) for r in one] == [(1, 0, None)] * 2
    assert all(c.whitened is None and c.explained is None for r in one for c in r["_whitening"].coordinates)
    flat = whitening.whiten(frame(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 3.0], 0)])).collect()
    assert [[c.whitened is None for c in r["_whitening"].coordinates] for r in flat] == [[False, True]] * 2
    assert {abs(r["_whitening"].coordinates[0].whitened) for r in flat} == {1.0}
    assert whitening.whiten(frame(spark, [])).count() == 0
    empty = whitening.whiten(frame(spark, [(1, [], 0)])).collect()
    assert [r["_whitening"].coordinates for r in empty] == [[]]
    assert whitening.whiten(frame(spark, [(1, None, 0)])).count() == 0


def test_whitening_of_huge_entries(spark):
    rows = [(1, [3e38, 1.0], 0), (2, [-3e38, 2.0], 0), (3, [5e10, 2.5], 0)]
    got = sorted(((r.vec_id, r["_whitening"]) for r in whitening.whiten(frame(spark, rows)).collect()), key=lambda r: r[0])
    assert [w.deviation for _, w in got] == [None] * 3
    assert got[0][1].identity_error < 1e-6 and abs(sum(c.explained for c in got[0][1].coordinates) - 1) < 1e-12


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-(2**61), 2**61), min_size=3, max_size=3), min_size=1, max_size=200))
def test_popcounts_are_products(rows):
    x = np.array(rows, dtype=object)
    low = x.min(axis=0)
    shifted = (x - low).astype(np.int64)
    counts = whitening.Scatter([int(v).bit_length() for v in (x.max(axis=0) - low)])
    counts.add(shifted[: len(rows) // 2])
    counts.add(shifted[len(rows) // 2 :])
    products = {}
    for d, e, limb, value in counts.limbs():
        products[d, e] = products.get((d, e), 0) + (value << (whitening.LIMB_BITS * limb))
    big = shifted.astype(object)
    for d in range(3):
        for e in range(d, 3):
            assert products.get((d, e), 0) == sum(big[:, d] * big[:, e])


# --- near duplicates


def brute_links(rows, threshold=0.98):
    live = [(k, np.array(v, dtype=float), label) for k, (_, v, label) in enumerate(rows)
            if v and label is not None and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    live = [(k, v / np.abs(v).max(), label) for k, v, label in live]
    partners = {k: set() for k in range(len(rows))}
    for n, (a, x, la) in enumerate(live):
        for b, y, lb in live[:n]:
            if la == lb and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                partners[a].add(b)
                partners[b].add(a)
    out = []
    for k, (i, _, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for b in partners[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        ids = [rows[b][0] for b in seen if rows[b][0] is not None]
        low = min(ids) if ids else None
        out.append((i, len(partners[k]), low, i == low))
    return sorted(out, key=repr)


@pytest.mark.parametrize("tile_rows", [7, 4096])
@pytest.mark.parametrize("threshold", [0.98, 0.9])
def test_near_vectors(spark, monkeypatch, tile_rows, threshold):
    monkeypatch.setattr(near_vectors, "TILE_ROWS", tile_rows)
    rows = random_rows(2) + ODD
    want = brute_links(rows, threshold)
    assert sum(n for _, n, _, _ in want) > 100
    got = near_vectors.near_vectors(frame(spark, rows), threshold)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_near_vectors_of_nothing(spark):
    assert near_vectors.near_vectors(frame(spark, [])).count() == 0
    assert [tuple(r) for r in near_vectors.near_vectors(frame(spark, [(5, None, None)])).collect()] == [(5, 0, 5, True)]


def test_hot_vector_and_doubles(spark):
    """A third of the rows is one vector; entries are doubles with squares beyond range."""
    rows = spark.range(3000).select(
        F.col("id").alias("vec_id"), F.lit(1).alias("label"),
        F.when(F.col("id") % 3 == 0, F.array(F.lit(1e200), F.lit(0.0))).otherwise(
            F.array(F.cos(F.col("id") * 0.7), F.sin(F.col("id") * 0.7))).alias("embedding"))
    got = {r.vec_id: r for r in near_vectors.near_vectors(rows).collect()}
    angles = {i: 0.0 if i % 3 == 0 else i * 0.7 for i in range(3000)}
    for i in (0, 1, 2, 2999):
        near = sum(j != i and math.cos(angles[i] - angles[j]) >= 0.98 for j in range(3000))
        assert got[i].n_links == near


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 40), st.integers(1, 90), st.floats(-1, 1))
def test_bounds_are_rigorous(seed, rows, dims, threshold):
    rng = np.random.default_rng(seed)
    x = near_vectors.unit_rows(rng.standard_normal((rows, dims)) * rng.choice([1e-3, 1, 50], (rows, 1)) + rng.random((rows, dims)))
    q = near_vectors.Quantised(x)
    assert (q.could_reach(q, 0, rows, threshold) | (x @ x.T < threshold)).all()


def test_products_of_many_dimensions_are_exact():
    x = near_vectors.unit_rows(np.ones((2, 5000)))
    q = near_vectors.Quantised(x)
    assert not q.could_reach(q, 0, 2, 1.0001).any() and q.could_reach(q, 0, 2, 1.0).all()
