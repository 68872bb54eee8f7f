"""Telling hot keys from usual ones, so that each gets the plan that suits it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.session import stored

# The list of hot keys is broadcast up to this many; beyond, it is joined by shuffling.
BROADCAST_KEYS = 10_000


def split_hot(
    df: DataFrame, keys: list[str], hot_above: int
) -> tuple[DataFrame, DataFrame | None]:
    """``df`` without its hot keys, and the rows of the hot keys, or ``None`` if there are none.

    Counting reads only the key columns and combines before its shuffle. There can be at most
    ``rows / hot_above`` hot keys; only that list is stored and joined back, and only their
    number comes to the driver.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    hot = stored(counts.filter(F.col("_rows") > hot_above).select(*keys))
    number = hot.count()
    if number == 0:
        return df, None
    listed = F.broadcast(hot) if number <= BROADCAST_KEYS else hot
    renamed = listed.toDF(*[f"_hot_{key}" for key in keys])
    same = [F.col(key).eqNullSafe(F.col(f"_hot_{key}")) for key in keys]
    return df.join(renamed, same, "left_anti"), df.join(renamed, same, "left_semi")
