"""Mergeable sketches: distinct counts, quantiles and frequent items that windows can be merged from.

A sketch has a bounded size whatever it has seen, and sketches of parts merge into the sketch of the whole:
hours into days, in a batch or over what a stream stored. One aggregate holds all of them.

Errors, with the default sizes:

* distinct counts (HyperLogLog, 2^14 buckets): ``distinct_error`` is three standard errors, 2.4 %;
* quantiles (KLL, k = 400): the rank of the answer is off by at most ``RANK_ERROR`` of the rows;
* frequent items (1024 tracked): a count is off by at most 3.5 / 1024 of the rows. Items more frequent than
  that are never missed; with fewer different items than 768, three quarters of those tracked, counts are exact.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_BUCKETS = 14
KLL_K = 400
TRACKED = 1024
#: Normalised rank error of a KLL sketch with ``KLL_K``, with 99 % confidence.
RANK_ERROR = 0.0075


def distinct_error(lg_buckets: int = LG_BUCKETS) -> float:
    """Relative error of a merged distinct count, three standard errors."""
    return 3 * 1.04 / math.sqrt(2**lg_buckets)


def frequency_error(rows: int, tracked: int = TRACKED) -> float:
    """By how much a count of a frequent item can be off."""
    return 3.5 * rows / tracked


def _name(kind: str, column: str) -> str:
    return f"{column}_{kind}"


def sketched(
    rows: DataFrame,
    by: list[str | Column],
    distinct: list[str] = (),
    quantiles: list[str] = (),
    frequent: list[str] = (),
    tracked: int = TRACKED,
) -> DataFrame:
    """Per group: the number of ``rows``, and a sketch of each named column, in one aggregate.

    ``by`` may hold a window, so that this runs in a stream. Nulls are not counted by any sketch. The sketch
    columns are named after their column: ``_distinct``, ``_quantiles``, ``_frequent``.
    """
    sketches = [F.hll_sketch_agg(c, LG_BUCKETS).alias(_name("distinct", c)) for c in distinct]
    sketches += [F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(KLL_K)).alias(_name("quantiles", c)) for c in quantiles]
    # Tracked without nulls: a filter on the aggregate keeps them out of the items.
    sketches += [F.expr(f"approx_top_k_accumulate(`{c}`, {tracked}) FILTER (WHERE `{c}` IS NOT NULL)").alias(_name("frequent", c)) for c in frequent]
    return rows.groupBy(*by).agg(F.count("*").alias("rows"), *sketches)


def merged(sketches: DataFrame, by: list[str | Column], tracked: int = TRACKED) -> DataFrame:
    """The sketches of larger groups, from those of their parts (``sketched``), in one aggregate."""
    merges = [F.sum("rows").alias("rows")]
    for name in sketches.columns:
        if name.endswith("_distinct"):
            merges.append(F.hll_union_agg(name).alias(name))
        elif name.endswith("_quantiles"):
            merges.append(F.kll_merge_agg_double(name).alias(name))
        elif name.endswith("_frequent"):
            merges.append(F.expr(f"approx_top_k_combine(`{name}`, {tracked})").alias(name))
    return sketches.groupBy(*by).agg(*merges)


def distinct_count(column: str) -> Column:
    return F.hll_sketch_estimate(_name("distinct", column))


def quantile_values(column: str, ranks: list[float]) -> Column:
    """An array with the value at each of ``ranks``, all read from one sketch; null without any value."""
    sketch = F.col(_name("quantiles", column))
    asked = F.array(*[F.lit(float(q)) for q in ranks])
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, asked))


def rank_of(column: str, value: Column) -> Column:
    """The share of values that are at most ``value``."""
    return F.kll_sketch_get_rank_double(_name("quantiles", column), value)


def top_items(column: str, n: int) -> Column:
    """An array of (item, count) of the ``n`` most frequent items, most frequent first."""
    return F.expr(f"approx_top_k_estimate(`{_name('frequent', column)}`, {n})")
