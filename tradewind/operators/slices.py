"""Running sums and previous-row lookups that stay parallel inside one hot key.

A window over a key puts all of the key's rows into one task. So keys are cut into slices of
time. Every slice is first reduced to one row, combined before the shuffle, and a window over those
few rows gives the value each slice starts from. That start joins the slice as one extra row in
front, so the detail rows need only a window over (key, slice) and no join. All keys get the
same plan, whatever their size, and nothing is counted when a query is built.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tradewind.functions.timing import interval, slice_of

_SLICE, _START, _OPENS = "_slice", "_is_start", "_opens"


def _ordered(keys: list[str], ts: str, ties: list[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(F.col(_START).desc(), F.col(ts), *ties)


def _with_starts(
    rows: DataFrame, starts: DataFrame, add: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Put the start rows in front of the detail rows, add the window column, drop them again."""
    marked = rows.withColumn(_START, F.lit(False)).unionByName(
        starts.withColumn(_START, F.lit(True)), allowMissingColumns=True
    )
    return add(marked).filter(~F.col(_START)).drop(_START)


def running_sum(
    df: DataFrame,
    keys: list[str],
    ts: str,
    value: str,
    out: str,
    ties: list[str] = (),
    opening: DataFrame | None = None,
    width: str = "1 hour",
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over this and all earlier rows of the key.

    Rows are ordered by ``ts`` then ``ties``; rows without a time come first. ``opening`` (keys +
    ``value``, one row per key) is an amount each key starts from. ``width`` bounds the part of a
    key one task sorts, and changes no result.
    """
    sliced = df.withColumn(_SLICE, slice_of(ts, width))
    totals = sliced.groupBy(*keys, _SLICE).agg(F.sum(value).alias(value)).withColumn(_OPENS, F.lit(False))
    if opening is not None:
        before_all = opening.select(
            *keys, F.lit(None).cast("bigint").alias(_SLICE), value, F.lit(True).alias(_OPENS)
        )
        totals = totals.unionByName(before_all)
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(F.col(_OPENS).desc(), F.col(_SLICE).asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        totals.withColumn(value, F.sum(value).over(earlier))
        .filter(F.col(value).isNotNull() & ~F.col(_OPENS))
        .drop(_OPENS)
    )
    order = _ordered([*keys, _SLICE], ts, list(ties))
    so_far = F.sum(value).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return _with_starts(sliced, starts, lambda rows: rows.withColumn(out, so_far)).drop(_SLICE)


def previous_row(
    df: DataFrame,
    keys: list[str],
    ts: str,
    columns: list[str],
    ties: list[str] = (),
    prefix: str = "prev_",
    width: str = "1 hour",
) -> DataFrame:
    """Add ``prev_<column>`` for each of ``columns``: its value in the key's previous row."""

    def lagged(rows: DataFrame) -> DataFrame:
        previous = [F.lag(column).over(order).alias(prefix + column) for column in columns]
        return rows.select("*", *previous)

    order = _ordered([*keys, _SLICE], ts, list(ties))
    sliced = df.withColumn(_SLICE, slice_of(ts, width))
    lasts = sliced.groupBy(*keys, _SLICE).agg(
        F.max_by(F.struct(*columns), F.struct(ts, *ties)).alias("_last")
    )
    slice_before = F.lag("_last").over(Window.partitionBy(*keys).orderBy(_SLICE))
    starts = (
        lasts.withColumn("_last", slice_before)
        .filter(F.col("_last").isNotNull())
        .select(*keys, _SLICE, "_last.*")
    )
    return _with_starts(sliced, starts, lagged).drop(_SLICE)


def as_of_values(
    points: DataFrame,
    samples: DataFrame,
    keys: list[str],
    ts: str,
    columns: list[str],
    within: str | None = None,
    ties: list[str] = (),
    prefix: str = "as_of_",
    width: str = "1 hour",
) -> DataFrame:
    """Add to each point the ``columns`` of the last sample of its key at or before it, and that sample's time.

    Both sides have ``keys`` and the time ``ts``. Of samples at one time the last by ``ties``, then by ``columns``
    counts. A sample older than ``within`` is stale: all nulls then, as where there is none. Points without a time
    have none. No pairs are formed: points and samples are sorted together within slices, and the
    last sample of the slices before is carried into each slice.
    """
    sample = F.struct(ts, *ties, *[column for column in columns if column not in ties])
    kind = samples.select(sample.alias("s")).schema["s"].dataType
    both = points.withColumn("_sample", F.lit(None).cast(kind)).unionByName(
        samples.filter(F.col(ts).isNotNull()).select(*keys, ts, sample.alias("_sample")), allowMissingColumns=True
    ).withColumn(_SLICE, slice_of(ts, width))
    marked = both.withColumn("_is_point", F.col("_sample").isNull())
    lasts = both.groupBy(*keys, _SLICE).agg(F.max("_sample").alias("_sample"))
    earlier = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        lasts.withColumn("_sample", F.last("_sample", ignorenulls=True).over(earlier))
        .filter(F.col("_sample").isNotNull()).withColumn("_is_point", F.lit(False))
    )
    # Samples at the time of a point come before it, in their own order; a start comes before all.
    order = Window.partitionBy(*keys, _SLICE).orderBy(F.col(_START).desc(), ts, "_is_point", "_sample").rowsBetween(Window.unboundedPreceding, 0)
    found = _with_starts(marked, starts, lambda rows: rows.withColumn("_found", F.last("_sample", ignorenulls=True).over(order)))
    fresh = F.col(f"_found.{ts}") <= F.col(ts)
    if within is not None:
        fresh = fresh & (F.col(ts) <= F.col(f"_found.{ts}") + interval(within))
    values = [F.when(fresh, F.col(f"_found.{name}")).alias(prefix + name) for name in (ts, *columns)]
    return found.filter("_is_point").select(*points.columns, *values)
