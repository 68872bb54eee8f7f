"""Starting a streaming job: sink, trigger, checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from tradewind.schemas import RESULT_KEYS, conform
from tradewind.session import durable_folder, forget_shuffles
from tradewind.sources.files import run_token
from tradewind.sources.sinks import merge_into, write_batch
from tradewind.sources.upsert import upsert

Sink = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class BatchFolderSink:
    """One folder per run and batch; ``start_job`` names the run after its checkpoint."""

    path: str
    table: str | None = None
    run: str = "r0"
    merged: bool = True

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        write_batch(conform(batch, self.table) if self.table else batch, self.path, batch_id, self.run, self.merged)


def batch_folder_sink(path: str, table: str | None = None, merged: bool = True) -> Sink:
    """A sink with one folder per batch, stored with the declared types of ``table`` if named.

    Without ``merged``, batches are neither kept nor shuffled for it: each task's rows go to a file of their own, which
    is for large batches.
    """
    return BatchFolderSink(path, table, merged=merged)


def upsert_sink(
    path: str,
    keys: list[str],
    partition: str,
    table: str | None = None,
    newest_by: str | None = None,
    by: Column | None = None,
) -> Sink:
    """A sink that keeps a Parquet table by key; see ``upsert``.

    ``by`` computes the column ``partition`` from the key, if the rows do not have it.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = conform(batch, table) if table else batch
        upsert(rows if by is None else rows.withColumn(partition, by), path, keys, partition, newest_by)

    return store


def merge_sink(table: str, keys: list[str] | None = None) -> Sink:
    """A sink that updates or inserts by key in a catalog table that supports MERGE."""
    name = table.rsplit(".", 1)[-1]

    def store(batch: DataFrame, batch_id: int) -> None:
        merge_into(conform(batch, name), table, keys or RESULT_KEYS[name])

    return store


def start_job(
    results: DataFrame,
    sink: Sink,
    name: str,
    trigger: str | None = "10 seconds",
    output_mode: str = "append",
    checkpoint: str | None = None,
    settings: Mapping[str, str] = {},
) -> StreamingQuery:
    """Start writing ``results`` batch by batch through ``sink``.

    ``trigger`` is the time between batches; ``None`` processes what is there now and stops.
    Append mode emits a window once, after the watermark has closed it. The checkpoint lies in
    the shared folder, so the job continues where it was after any machine is lost. The batch is
    kept for the emptiness check and the write, so its plan runs once. A folder sink that does not merge writes it
    at once, removes what is empty and deletes what the batch has shuffled. ``settings`` are session settings of this query alone.
    """

    spark = results.sparkSession
    folder = checkpoint or f"{durable_folder(spark)}/streams/{name}"
    at_once = isinstance(sink, BatchFolderSink) and not sink.merged
    if isinstance(sink, BatchFolderSink):
        sink = replace(sink, run=run_token(spark, folder))

    def deliver(batch: DataFrame, batch_id: int) -> None:
        if at_once:
            try:
                sink(batch, batch_id)
            finally:
                forget_shuffles(batch)
            return
        batch.persist()
        try:
            if not batch.isEmpty():
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    writer = (
        results.writeStream.queryName(name)
        .foreachBatch(deliver)
        .outputMode(output_mode)
        .option("checkpointLocation", folder)
    )
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    usual = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        return writer.start()  # with a copy of the settings
    finally:
        for key, value in usual.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
