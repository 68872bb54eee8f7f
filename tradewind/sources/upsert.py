"""A Parquet table by key: a batch replaces the rows of its keys and leaves all others.

The table is partitioned by a column that the key decides (the day of a time in the key, a hash of an
id), so a row's earlier version can only lie in its own partition. Only the partitions a batch touches
are read, merged and replaced, whatever the number of batches before, and readers read a plain table.

The merged partitions are first written under ``_staged``, which readers skip, and then moved into place
one by one. If the driver dies in between, the next call finishes the moves: all rows, old ones too, are
in the staged folder by then. One writer at a time.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators.joins import newest_rows
from tradewind.sources.files import Folder

STAGED = "_staged"
_NEW = "_is_new"


def merged(old: DataFrame, new: DataFrame, keys: list[str], newest_by: str | None = None) -> DataFrame:
    """All rows of ``old`` whose key ``new`` lacks, and of the other keys only the newest rows.

    Without ``newest_by`` those are the rows of ``new``; with it, the rows with the largest value there
    (nulls are oldest), and those of ``new`` if both have it. All rows that tie stay. Nulls in a key equal each other.
    """
    both = old.withColumn(_NEW, F.lit(0)).unionByName(new.withColumn(_NEW, F.lit(1)))
    age = F.struct(F.col(newest_by), F.col(_NEW)) if newest_by else F.struct(_NEW)
    return newest_rows(both, keys, age).drop(_NEW)


def upsert(
    batch: DataFrame, path: str, keys: list[str], partition: str, newest_by: str | None = None
) -> None:
    """Merge ``batch`` into the table at ``path``; see ``merged``. Doing it again changes nothing.

    ``partition`` is a column of ``batch`` that is the same for all rows of a key. The distinct values a
    batch has there pass through the driver, so that the scan of the table is pruned by them.
    """
    spark = batch.sparkSession
    recover(spark, path)
    table, staged = Folder(spark, path), Folder(spark, f"{path}/{STAGED}/{uuid4().hex}")
    touched = [row[0] for row in batch.select(partition).distinct().collect()]
    rows = batch
    if any(not name.startswith(("_", ".")) for name in table.names()):
        old = spark.read.schema(batch.schema).parquet(path).where(_one_of(F.col(partition), touched))
        rows = merged(old.select(batch.columns), batch, keys, newest_by)
    rows.hint("rebalance", partition).write.partitionBy(partition).parquet(staged.path)
    _publish(table, staged)


def _one_of(column: Column, values: list) -> Column:
    found = column.isin([v for v in values if v is not None])
    return found | column.isNull() if None in values else found


def _publish(table: Folder, staged: Folder) -> None:
    for name in staged.names():
        if not name.startswith(("_", ".")):
            table.take(staged, name)
    staged.remove()


def recover(spark: SparkSession, path: str) -> None:
    """Finish what a writer that died had written in full, and remove what it had not."""
    table, begun = Folder(spark, path), Folder(spark, f"{path}/{STAGED}")
    for name in begun.names():
        staged = Folder(spark, f"{begun.path}/{name}")
        if staged.has("_SUCCESS"):
            _publish(table, staged)
        else:
            staged.remove()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
