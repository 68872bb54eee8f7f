"""Publishing pending outbox rows once, also if the publisher dies between sending and marking them.

A batch of pending rows is stored before anything is sent, so that what is sent and what is marked are the
same rows. It lies under ``pending`` until it has been sent, and moving it to ``published`` is the mark: the
published batches are the ledger. A publisher that finds a batch under ``pending`` sends that one again, under
the same name, before it takes new rows; a sink that replaces what it has under a name then holds every record
once. Rows in the ledger are never pending again, whether or not the outbox table has been updated yet.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.timing import Instant
from tradewind.operators.joins import having, lacking
from tradewind.plans.orders import publish_outbox
from tradewind.sources.files import Folder

# Sends the records (topic, key, value) under a name; doing it again must replace the first time.
Send = Callable[[DataFrame, str], None]


def publish_pending(outbox: DataFrame, folder: str, send: Send, as_of: Instant, key: str = "id") -> DataFrame:
    """Send what is pending in ``outbox`` and return its rows marked as published, to be merged by ``key``.

    One publisher at a time. No pending rows: nothing is sent. ``key`` must not be null. Published batches can be
    removed once their rows have been merged into the outbox.
    """
    spark = outbox.sparkSession
    waiting, ledger = Folder(spark, f"{folder}/pending"), Folder(spark, f"{folder}/published")
    for name in waiting.names():
        if Folder(spark, f"{waiting.path}/{name}").has("_SUCCESS"):
            _send(waiting, ledger, name, send)
        else:
            waiting.remove(name)
    pending = outbox.filter(F.col("published") == "N")
    names = ledger.names()
    if names:
        done = spark.read.schema(outbox.schema).parquet(*[f"{ledger.path}/{name}" for name in names])
        pending = lacking(pending, done, [key])
    name = uuid4().hex
    pending.write.parquet(f"{waiting.path}/{name}")
    if not spark.read.schema(outbox.schema).parquet(f"{waiting.path}/{name}").isEmpty():
        _send(waiting, ledger, name, send)
    else:
        waiting.remove(name)
    sent = ledger.names()
    if not sent:
        return publish_outbox(outbox.limit(0), as_of)[1]
    rows = spark.read.schema(outbox.schema).parquet(*[f"{ledger.path}/{name}" for name in sent])
    return publish_outbox(having(outbox, rows, [key]), as_of)[1]


def _send(waiting: Folder, ledger: Folder, name: str, send: Send) -> None:
    rows = waiting.spark.read.parquet(f"{waiting.path}/{name}")
    records, _ = publish_outbox(rows, "1970-01-01")
    send(records, name)
    ledger.take(waiting, name)
