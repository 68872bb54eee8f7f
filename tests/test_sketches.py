"""Sketches: error bounds, merging in any order, ties and skew."""

import random

import pytest
from pyspark.sql import functions as F

from tradewind.operators import sketches


@pytest.fixture(scope="module")
def parts(spark):
    """20 000 rows in 40 parts: 15 000 users, skewed items with ties, values with repeats."""
    rng = random.Random(5)
    rows = []
    for n in range(20_000):
        item = f"i{int(rng.paretovariate(0.8)) % 3000}" if n % 4 else f"tie{n // 4 % 5}"
        rows.append((n % 40, rng.randrange(15_000), float(round(rng.expovariate(0.1))), item))
    return rows, spark.createDataFrame(rows, "part int, user int, value double, item string").repartition(4)


def test_merged_equals_whole_within_bounds(parts):
    rows, df = parts
    pieces = sketches.sketched(df, ["part"], ["user"], ["value"], ["item"], tracked=256)
    twice = sketches.merged(pieces, [(F.col("part") % 7).alias("seventh")], tracked=256)
    one = sketches.merged(twice, [], tracked=256).select(
        "rows", sketches.distinct_count("user").alias("users"), sketches.quantile_values("value", [0.0, 0.5, 0.95, 0.99, 1.0]).alias("values"),
        sketches.top_items("item", 20).alias("top"), sketches.rank_of("value", F.lit(10.0)).alias("rank")).first()
    users = len({r[1] for r in rows})
    assert one["rows"] == len(rows) and abs(one.users - users) <= users * sketches.distinct_error()
    ordered = sorted(r[2] for r in rows)
    for q, value in zip([0.0, 0.5, 0.95, 0.99, 1.0], one["values"]):
        below, upto = sum(v < value for v in ordered) / len(rows), sum(v <= value for v in ordered) / len(rows)
        assert below - sketches.RANK_ERROR <= q <= upto + sketches.RANK_ERROR
    assert abs(one["rank"] - sum(v <= 10 for v in ordered) / len(rows)) <= sketches.RANK_ERROR
    exact = {}
    for r in rows:
        exact[r[3]] = exact.get(r[3], 0) + 1
    error = sketches.frequency_error(len(rows), 256)
    found = {t["item"]: t["count"] for t in one.top}
    assert all(abs(n - exact[item]) <= error for item, n in found.items())
    # Nothing clearly more frequent than the twentieth answer is missed, ties at the top included.
    assert {item for item, n in exact.items() if n > min(found.values()) + error} <= set(found)
    assert {f"tie{k}" for k in range(5)} <= set(found)


def test_sketches_of_nothing(spark):
    empty = spark.createDataFrame([(1, None, None, None)], "part int, user int, value double, item string")
    one = sketches.merged(sketches.sketched(empty, ["part"], ["user"], ["value"], ["item"]), []).select(
        "rows", sketches.distinct_count("user").alias("users"), sketches.quantile_values("value", [0.5]).alias("values"),
        sketches.top_items("item", 3).alias("top")).first()
    assert one["rows"] == 1 and one.users == 0 and one["values"] is None and one.top == []
