"""Joins with semantics Spark has no single operator for, each reduced to an equi-join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.timing import micros, slice_of


# An event id is shared by several event types of one order.
EVENT_KEY = ["event_type", "event_id"]


def _always_zero(*keys: str) -> Column:
    """A join key that is equal for equal keys and always zero.

    AQE splits a hot join partition only if both sides come straight from a shuffle. A side that
    was aggregated by the join keys would be joined where it is. One key more makes Spark
    shuffle it once more, after it has been reduced, and AQE can split the other side.
    """
    return F.pmod(F.xxhash64(*keys), F.lit(1))


def _matching(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    # Repeated keys of the right side collapse inside each task, before any shuffle.
    names = [f"_right_{key}" for key in keys]
    listed = right.select(*keys).distinct().toDF(*names)
    same = [F.col(key) == F.col(name) for key, name in zip(keys, names)]
    return left.join(listed, [*same, _always_zero(*keys) == _always_zero(*names)], how)


def having(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``. Either side may have hot keys."""
    return _matching(left, right, keys, "left_semi")


def lacking(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``. Either side may have hot keys."""
    return _matching(left, right, keys, "left_anti")


def newest_rows(rows: DataFrame, keys: list[str], age: Column) -> DataFrame:
    """The rows with the largest ``age`` of their key; all rows that tie stay, nulls in a key equal each other.

    The largest age of a key is a partial aggregate, so only a row for each key and task is shuffled for it,
    and AQE can split the rows of a hot key in the join.
    """
    names = [f"_right_{key}" for key in keys]
    newest = rows.groupBy(*keys).agg(F.max(age).alias("_newest")).toDF(*names, "_newest")
    same = [F.col(key).eqNullSafe(F.col(name)) for key, name in zip(keys, names)]
    on = [*same, age.eqNullSafe(F.col("_newest")), _always_zero(*keys) == _always_zero(*names)]
    return rows.join(newest, on, "left_semi")


def unmatched_within(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, within: str
) -> DataFrame:
    """Rows of ``left`` without a ``right`` row of the same key in [left_ts, left_ts + within].

    No pairs are formed. Time is cut into slices as wide as ``within``, so a match can only lie
    in the row's own slice, at or after the row, or in the next slice, at or before the limit.
    The last time in the own slice and the first time in the next one decide both. The right
    side is thus reduced map-side to one row per (key, slice) before an ordinary outer join,
    whose left side AQE can split when a key is hot.
    """
    width = micros(within)
    at = slice_of(right_ts, within)
    role = F.struct
    times = F.array(
        role(at.alias("s"), F.col(right_ts).alias("own"), F.lit(None).cast("timestamp").alias("next")),
        role(
            (at - F.lit(width)).alias("s"),
            F.lit(None).cast("timestamp").alias("own"),
            F.col(right_ts).alias("next"),
        ),
    )
    bounds = (
        right.filter(F.col(right_ts).isNotNull() & F.col(key).isNotNull())
        .select(F.col(key).alias("_key"), F.explode(times).alias("t"))
        .groupBy("_key", F.col("t.s").alias("_slice"))
        .agg(F.max("t.own").alias("_own"), F.min("t.next").alias("_next"))
    )
    limit = F.col(left_ts) + F.expr(f"INTERVAL {within}")
    matched = (F.col("_own") >= F.col(left_ts)) | (F.col("_next") <= limit)
    own_slice = slice_of(left_ts, within)
    same = [
        F.col(key) == F.col("_key"),
        own_slice == F.col("_slice"),
        _always_zero(key) == _always_zero("_key"),
    ]
    joined = left.join(bounds, same, "left")
    return joined.filter(~F.coalesce(matched, F.lit(False))).select(*left.columns)


def contained_in(
    needles: DataFrame, needle: str, haystacks: DataFrame, haystack: str
) -> DataFrame:
    """Distinct ``needle`` texts that occur inside at least one ``haystack`` text.

    A join on LIKE compares every pair. Instead each haystack yields its substrings of the
    lengths that needles really have, and those are matched by equality. Work grows with the
    texts' lengths, not with the number of pairs.
    """
    wanted = needles.select(F.col(needle).alias("_text")).filter("_text is not null")
    # One row per distinct length: bounded by the longest id.
    lengths = wanted.select(F.length("_text").alias("_length")).distinct()
    sized = (
        haystacks.select(F.col(haystack).alias("_hay"))
        .filter("_hay is not null")
        .select("_hay", F.explode(F.sequence(F.lit(0), F.length("_hay"))).alias("_length"))
        .join(lengths, "_length", "left_semi")
    )
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("_hay") - F.col("_length") + 1))
    pieces = sized.select(
        F.explode(
            F.array_distinct(
                F.transform(starts, lambda start: F.substring("_hay", start, F.col("_length")))
            )
        ).alias("_text")
    )
    # Pieces are the side that is made distinct before its shuffle, so common ones are sent once a task.
    return having(wanted.distinct(), pieces, ["_text"]).toDF(needle)


def zero_filled(counts: DataFrame, key: str, count: str, expected: list[str]) -> DataFrame:
    """``counts`` with a zero row for each expected key that is absent; other keys are kept.

    The expected keys are a short list the caller wrote down; they are added as zero rows and
    summed, which needs no join.
    """
    names = F.explode(F.array(*[F.lit(name) for name in expected]))
    session = counts.sparkSession
    zeros = session.range(1, numPartitions=1).select(
        names.alias(key), F.lit(0).cast("bigint").alias(count)
    )
    return (
        counts.select(key, F.col(count).cast("bigint").alias(count))
        .unionByName(zeros)
        .groupBy(key)
        .agg(F.sum(count).alias(count))
    )


def not_yet_processed(events: DataFrame, history: DataFrame) -> DataFrame:
    """Events whose (event_type, event_id) is not in the history table.

    The id alone is no key: one id travels through several event types of the same order.
    """
    return lacking(events, history, EVENT_KEY)
