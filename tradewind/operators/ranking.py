"""Top-k, ranks and shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest(df: DataFrame, ts: str, n: int | None, ties: list[str] = ()) -> DataFrame:
    """The ``n`` latest rows, latest first; ``None`` sorts them all.

    ``ties`` makes the cut at ``n`` deterministic among rows of the same time.
    """
    ordered = df.orderBy(F.col(ts).desc(), *ties)
    return ordered if n is None else ordered.limit(n)


def highest(df: DataFrame, by: str, n: int, ties: list[str] = ()) -> DataFrame:
    """The ``n`` rows with the largest ``by``, largest first."""
    return df.orderBy(F.col(by).desc(), *ties).limit(n)


def numbered_highest(
    df: DataFrame, by: str, n: int, ties: list[str], out: str = "rank"
) -> DataFrame:
    """``highest`` with a row number. The unpartitioned window sees only the ``n`` rows."""
    order = Window.orderBy(F.col(by).desc(), *ties)
    return highest(df, by, n, ties).withColumn(out, F.row_number().over(order))


def dense_top(df: DataFrame, within: list[str], by: str, n: int, out: str) -> DataFrame:
    """Rows whose ``by`` is among the ``n`` highest distinct values of their group, with the rank.

    Ties share a rank and are all kept, so a group can return more than ``n`` rows. Spark turns
    the filter on the rank into a group limit that each task applies before the shuffle, so a
    hot group sends only its leading rows.
    """
    order = Window.partitionBy(*within).orderBy(F.col(by).desc_nulls_first())
    return df.withColumn(out, F.dense_rank().over(order)).filter(F.col(out) <= n)


def latest_value(ts: str, value: str) -> Column:
    """Aggregate: the value of the latest row."""
    return F.max_by(value, ts)


def share_of_total(counts: DataFrame, count: str, out: str) -> DataFrame:
    """Percentage of the total for each row of an already aggregated table.

    The total is a scalar subquery, so the rows stay where they are, however many categories there are.
    """
    from tradewind.functions.scalars import percent

    return counts.withColumn(out, percent(F.col(count), counts.agg(F.sum(count)).scalar()))


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key, the first in ``order``.

    The rank filter becomes a group limit: each task keeps one row per key before the shuffle,
    so a key with a third of the rows sends at most one row per task.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).filter("_position = 1").drop("_position")
