"""Writing results so that a replayed batch never duplicates and never erases.

Rows are always written by the executors. Stream results go to one folder per batch: a batch
that runs again after a failure overwrites its own folder. ``read_current`` then keeps, per
key, all rows of the latest batch that has the key. A catalog table that supports MERGE is updated in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.operators.joins import newest_rows
from tradewind.schemas import DEAD_LETTER_TOPIC
from tradewind.sources.files import Folder

RUN, BATCH = "run", "batch_id"


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None) -> None:
    """Parquet files; ``files`` limits their number, which also limits the writing tasks."""
    (df if files is None else df.coalesce(files)).write.mode(mode).parquet(path)


def write_snapshot(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    """Replace a table. With ``partition_by`` only the partitions present in ``df`` are replaced.

    Rows are first brought together by partition, so that not every task writes a file into
    every partition; AQE splits a partition that is too large for one file.
    """
    if not partition_by:
        df.write.mode("overwrite").parquet(path)
        return
    gathered = df.hint("rebalance", *partition_by)
    writer = gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_jdbc(df: DataFrame, connection: dict[str, str], table: str, mode: str, tasks: int = 16) -> None:
    """Append to or replace a database table over at most ``tasks`` connections.

    A replaced table is truncated, not dropped, so its columns, keys and grants stay.
    """
    (
        df.write.format("jdbc")
        .options(**connection)
        .option("dbtable", table)
        .option("numPartitions", str(tasks))
        .option("truncate", "true")
        .option("batchsize", "10000")
        .mode(mode)
        .save()
    )


def write_batch(df: DataFrame, path: str, batch_id: int, run: str = "r0", merged: bool = True) -> None:
    """Store one micro-batch of a run; storing the same batch again replaces it.

    Batch ids begin at 0 with each new checkpoint, so ``run`` keeps the batches of a later checkpoint apart
    and in order (``files.run_token``). Rebalancing merges the batch's many small state partitions into files
    of a sensible size. Without ``merged``, tasks store their rows as they are, and a folder without rows is removed.
    """
    folder = f"{path}/{RUN}={run}/{BATCH}={batch_id}"
    if merged:
        df.hint("rebalance").write.mode("overwrite").parquet(folder)
        return
    df.write.mode("overwrite").parquet(folder)
    if not df.sparkSession.read.schema(df.schema).parquet(folder).take(1):
        Folder(df.sparkSession, folder).remove()


def read_current(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The stored rows with, per key, only those of the latest batch of the latest run that has the key.

    All rows that share a key within that batch stay; nulls in a key equal each other. For a table that is
    read often, ``upsert`` keeps the current rows only.
    """
    stored = spark.read.option("basePath", path).parquet(path)
    return newest_rows(stored, keys, F.struct(RUN, BATCH)).drop(RUN, BATCH)


def merge_source(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df``, which fails when it is computed if several of its rows share a key; nulls equal each other."""
    several = F.count("*").over(Window.partitionBy(*keys)) > 1
    message = F.concat(F.lit("several rows to merge share the key "), F.to_json(F.struct(*keys)))
    # The filter holds the check, so that no choice of columns drops it.
    return df.withColumn("_several", several).filter(F.when(F.col("_several"), F.raise_error(message).cast("boolean")).otherwise(True)).drop("_several")


def merge_into(df: DataFrame, table: str, keys: list[str]) -> None:
    """Update or insert by key in a catalog table whose format supports row-level MERGE.

    Keys are compared null-safe. Rows that are alike in all columns are one row. Several different rows with
    one key are an error: a table by key can hold only one.
    """
    source = merge_source(df.distinct(), keys).alias("source")
    same_row = [F.col(f"source.{key}").eqNullSafe(F.col(f"{table}.{key}")) for key in keys]
    condition = same_row[0]
    for part in same_row[1:]:
        condition = condition & part
    (
        source.mergeInto(table, condition)
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )


def to_topic(df: DataFrame, topic: str | None = None, key: str | None = None) -> DataFrame:
    """Rows as Kafka records: the row as JSON text, routed to ``topic`` or to its own column.

    ``key`` keeps the records of one entity in order on one partition.
    """
    target = F.lit(topic) if topic else F.col("topic")
    payload = [column for column in df.columns if column != "topic" or topic]
    record = [target.alias("topic"), F.to_json(F.struct(*payload)).alias("value")]
    if key:
        record.insert(1, F.col(key).cast("string").alias("key"))
    return df.select(*record)


def publish(records: DataFrame, servers: str) -> None:
    """Send records (topic, value and optionally key) to Kafka, from the executors."""
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def to_dead_letter_topic(letters: DataFrame) -> DataFrame:
    return to_topic(letters, DEAD_LETTER_TOPIC)
