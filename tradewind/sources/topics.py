"""Reading event topics, and turning their envelope into typed rows.

A topic arrives as the envelope ``key, value, topic, partition, offset, timestamp``. The Kafka
reader needs the connector on the class path; the file reader delivers the same envelope from
Parquet files and is what tests and backfills use.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.scalars import from_epoch_seconds, parse_json, parse_time
from tradewind.schemas import DEAD_LETTER_TOPIC, ENVELOPE, pick, schema_for
from tradewind.sources.files import Folder


#: For each topic, the next offset to read of each partition.
Offsets = dict[str, dict[int, int]]


def source_options(
    servers: str, max_per_trigger: int | None = None, fail_on_data_loss: bool = False
) -> dict[str, str]:
    """Kafka options: start at the earliest record, survive expired records, limit the rate.

    The rate limit is per micro-batch over all partitions. With ``fail_on_data_loss`` a stream stops
    when records expired before it read them.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "startingOffsets": "earliest",
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_topics(spark: SparkSession, topics: list[str], options: dict[str, str]) -> DataFrame:
    """Streaming envelope of several Kafka topics."""
    return (
        spark.readStream.format("kafka")
        .options(**options)
        .option("subscribe", ",".join(topics))
        .load()
    )


def read_topic(spark: SparkSession, topic: str, options: dict[str, str]) -> DataFrame:
    return read_topics(spark, [topic], options)


def scan_topics(
    spark: SparkSession,
    topics: list[str],
    servers: str,
    fail_on_data_loss: bool = True,
    start: Offsets | None = None,
) -> DataFrame:
    """Everything now in the topics, as a batch, one task per Kafka partition range.

    With ``start`` only the records from there on; it must then name all partitions of the topics.
    Records that vanish meanwhile are an error, unless ``fail_on_data_loss`` is off.
    """
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", json.dumps(start) if start else "earliest")
        .option("endingOffsets", "latest")
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .load()
    )


def _of_topics(envelope: DataFrame, topics: list[str] | None) -> DataFrame:
    return envelope if topics is None else envelope.filter(F.col("topic").isin(topics))


def stream_files(
    spark: SparkSession,
    path: str,
    topics: list[str] | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming envelope from a folder of Parquet files."""
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _of_topics(reader.parquet(path), topics)


def scan_files(spark: SparkSession, path: str, topics: list[str] | None = None) -> DataFrame:
    """Batch envelope from a folder of Parquet files; the topic filter reaches the scan."""
    return _of_topics(spark.read.schema(ENVELOPE).parquet(path), topics)


def decode(envelope: DataFrame, event_type: str, fields: list[str] | None = None) -> DataFrame:
    """Payload columns of one event type plus ``event_timestamp``.

    ``fields`` limits the parsing to what the caller needs. The event time is read from the
    payload; the envelope's own time is when the broker took the record in.
    """
    wanted = fields if fields is None or "timestamp" in fields else [*fields, "timestamp"]
    schema = pick(schema_for(event_type), wanted)
    to_time = from_epoch_seconds if event_type == DEAD_LETTER_TOPIC else parse_time
    return (
        envelope.filter(F.col("topic") == event_type)
        .select(parse_json("value", schema).alias("event"))
        .select("event.*")
        .withColumn("event_timestamp", to_time("timestamp"))
        .drop("timestamp")
    )


def topic_depth(envelope: DataFrame) -> DataFrame:
    """Records and lowest / next offset of each topic partition."""
    return envelope.groupBy("topic", "partition").agg(
        F.count("*").alias("messages"),
        F.min("offset").alias("low_offset"),
        (F.max("offset") + 1).alias("high_offset"),
    )


def next_offsets(envelope: DataFrame) -> Offsets:
    """The offsets after the last record of each topic partition: a row for each, whatever the records."""
    found: Offsets = {}
    for row in topic_depth(envelope).collect():
        found.setdefault(row["topic"], {})[row["partition"]] = row["high_offset"]
    return found


def between(envelope: DataFrame, start: Offsets | None = None, end: Offsets | None = None) -> DataFrame:
    """The records from ``start`` (included) to ``end`` (excluded) of each partition; both reach the scan.

    A partition that ``start`` lacks is read from its beginning. With an ``end``, a partition that it lacks is not
    read at all. Offsets are per partition, so the condition has a term for each of them.
    """
    rows = envelope
    if start:
        before = F.lit(False)
        for topic, parts in start.items():
            for part, offset in parts.items():
                before = before | _in(topic, part) & (F.col("offset") < offset)
        rows = rows.filter(~before)
    if end is not None:
        inside = F.lit(False)
        for topic, parts in end.items():
            for part, offset in parts.items():
                inside = inside | _in(topic, part) & (F.col("offset") < offset)
        rows = rows.filter(inside)
    return rows


def _in(topic: str, part: int) -> Column:
    return (F.col("topic") == topic) & (F.col("partition") == part)


class Progress:
    """Which records a repeated scan has read, kept as a small file in a folder.

    ``take`` gives what is new; ``done`` records that it was used. Without ``done``, after a crash for
    instance, the next scan gives the same records, and those that came since.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.folder, self.taken = Folder(spark, folder), None

    def offsets(self) -> Offsets:
        """Where the next scan starts."""
        read = json.loads(self.folder.read("offsets.json") or "{}")
        return {topic: {int(part): offset for part, offset in parts.items()} for topic, parts in read.items()}

    def take(self, envelope: DataFrame) -> DataFrame:
        """The records of ``envelope`` that no scan has used; later arrivals are not among them."""
        start = self.offsets()
        new = between(envelope, start)
        ends = next_offsets(new)
        self.taken = {topic: {**start.get(topic, {}), **ends.get(topic, {})} for topic in {*start, *ends}}
        return between(new, None, ends)

    def done(self) -> None:
        if self.taken is not None:
            self.folder.write("offsets.json", json.dumps(self.taken))
