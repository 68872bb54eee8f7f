"""Two-column (metric, count) reports made of labelled counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stacked(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def total_and_breakdown(df: DataFrame, key: str, total: str, prefix: str) -> DataFrame:
    """A row with the total and one ``<prefix><key>`` row per key.

    The total is added up from the per-key counts, so both share one scan and one shuffle. It is
    there, as zero, for an empty table too.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("count"))
    overall = counts.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("count"))
    each = counts.select(
        F.concat(F.lit(prefix), F.coalesce(F.col(key), F.lit(""))).alias("metric"), "count"
    )
    return overall.select(F.lit(total).alias("metric"), "count").unionByName(each)


def labelled_counts(df: DataFrame, **conditions: Column) -> DataFrame:
    """One (metric, count) row per condition, all counted in a single pass over ``df``.

    The metric is the keyword; pass ``**{"text with spaces": condition}`` for free text.
    """
    counted = df.agg(*[F.count_if(condition).alias(name) for name, condition in conditions.items()])
    rows = [
        F.struct(F.lit(name).alias("metric"), F.col(f"`{name}`").alias("count"))
        for name in conditions
    ]
    return counted.select(F.explode(F.array(*rows)).alias("row")).select("row.*")
