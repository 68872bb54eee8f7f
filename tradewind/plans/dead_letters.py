"""Dead letters: splitting bad records off, counting, banding and replaying them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.scalars import label, parse_time, preview, service_of
from tradewind.functions.timing import Instant, within_last
from tradewind.operators.joins import lacking, zero_filled
from tradewind.operators.ranking import highest
from tradewind.session import stored

# ---- fixed values ---------------------------------------------------------------------------
SERVICES = ["cart", "order", "payment", "inventory", "notification"]
REPLAY_THRESHOLD = 50
MAX_RETRIES = 3
NOT_PARSED, NOT_VALID = "JSONDecodeError", "ValidationError"
UNDER_THRESHOLD = "DLQ count under threshold"
OVER_THRESHOLD = "DLQ count over threshold"
UNHEALTHY = "System health check failed"
# Up to how many messages each band reaches; more than the last is critical.
BANDS = ((0, "HEALTHY"), (5, "MINOR"), (50, "MODERATE"))
TOP_BAND = "CRITICAL"
# ---------------------------------------------------------------------------------------------

_CORRUPT = "_corrupt"


#: What a rejected record tells about itself, if it can be read at all.
_IDENTITY = ("event_id", "event_type", "correlation_id")


def judged(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Each row of ``raw`` with its ``value`` as text, the parsed ``event``, error_type and error_reason.

    Records that are no JSON object of this schema, records without a field the schema requires, and records
    whose ``timestamp`` is no time have an error; the others have nulls there. ``event`` also holds the ids
    that a dead letter names, so that a record is parsed once.
    """
    others = [column for column in raw.columns if column != "value"]
    extra = [T.StructField(name, T.StringType()) for name in _IDENTITY if name not in schema.names]
    text = F.col("value").cast("string")
    parsed = raw.select(
        *others,
        text.alias("value"),
        F.from_json(
            text,
            T.StructType([*schema.fields, *extra, T.StructField(_CORRUPT, T.StringType())]),
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT},
        ).alias("event"),
    )
    required = [field.name for field in schema if not field.nullable]
    missing = F.filter(
        F.array(*[F.when(F.col(f"event.{name}").isNull(), F.lit(name)) for name in required]),
        lambda name: name.isNotNull(),
    )
    unreadable = F.col("event").isNull() | F.col(f"event.{_CORRUPT}").isNotNull()
    bad_time = (
        parse_time(F.col("event.timestamp").cast("string")).isNull()
        if "timestamp" in schema.names
        else F.lit(False)
    )
    reason = (
        F.when(unreadable, F.lit("not a JSON object of this schema"))
        .when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ", ")))
        .when(bad_time, F.lit("timestamp is not a time"))
    )
    kind = (
        F.when(unreadable, F.lit(NOT_PARSED))
        .when(F.col("error_reason").isNotNull(), F.lit(NOT_VALID))
    )
    return parsed.withColumn("error_reason", reason).withColumn("error_type", kind)


def split_valid(
    raw: DataFrame, schema: T.StructType, counts: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """Parse ``value`` and split the rows into valid and rejected ones; see ``judged``.

    The other columns of ``raw`` stay with both; rejected rows keep their text and get ``error_type``,
    ``error_reason`` and the ids they name. ``raw`` is read and parsed once, into a stored table that both
    results read; in a stream, call this on each micro-batch. ``counts`` receives the numbers of ``valid`` and
    ``rejected`` rows on the way.
    """
    others = [column for column in raw.columns if column != "value"]
    rows = judged(raw, schema)
    is_valid = F.col("error_reason").isNull()
    if counts is not None:
        rows = rows.observe(counts, F.count_if(is_valid).alias("valid"), F.count_if(~is_valid).alias("rejected"))
    rows = stored(rows)
    valid = rows.filter(is_valid).select(*others, *[F.col(f"event.{name}").alias(name) for name in schema.names])
    rejected = rows.filter(~is_valid).select(
        *others,
        "value",
        "error_type",
        "error_reason",
        *[F.col(f"event.{name}").cast("string").alias(name) for name in _IDENTITY],
    )
    return valid, rejected


def to_dlq(rejected: DataFrame, retries: int = MAX_RETRIES) -> DataFrame:
    """Dead-letter records from rejected rows that still have their ``topic`` and ``timestamp``."""
    return rejected.select(
        F.col("topic").alias("original_topic"),
        F.col("event_type").alias("original_event_type"),
        "event_id",
        "correlation_id",
        "error_reason",
        "error_type",
        F.lit(retries).alias("retry_count"),
        F.col("value").alias("payload"),
        (F.unix_micros("timestamp") / F.lit(1e6)).alias("timestamp"),
    )


def dlq_by_service(dlq: DataFrame, services: list[str] = SERVICES) -> DataFrame:
    """Dead letters per owning service; the known services are listed even without any."""
    counts = dlq.groupBy(service_of("original_topic").alias("service")).agg(
        F.count("*").alias("messages")
    )
    return zero_filled(counts, "service", "messages", services)


def dlq_view(dlq: DataFrame) -> DataFrame:
    """What an operator needs to see of each dead letter, with its place in the topic.

    The whole reason is there; ``reason_preview`` is for a one-line listing.
    """
    return dlq.select(
        label("event_id", "unknown").alias("event_id"),
        label("original_topic", "unknown").alias("original_topic"),
        label("error_type", "unknown").alias("error_type"),
        label("error_reason", "unknown").alias("error_reason"),
        preview(label("error_reason", "unknown")).alias("reason_preview"),
        F.coalesce("retry_count", F.lit(0)).alias("retry_count"),
        "partition",
        "offset",
    )


def dlq_top_errors(dlq: DataFrame, as_of: Instant, n: int = 10, span: str = "1 hour") -> DataFrame:
    """The most frequent (service, error type) pairs of the last hour."""
    recent = dlq.filter(within_last("event_timestamp", as_of, span))
    counted = recent.groupBy(service_of("original_topic").alias("service"), "error_type").agg(
        F.count("*").alias("errors")
    )
    return highest(counted, "errors", n, ["service", "error_type"])


def dlq_band(counts: DataFrame, count: str = "messages") -> DataFrame:
    """How serious a count of dead letters is."""
    band = F.lit(TOP_BAND)
    for limit, name in reversed(BANDS):
        band = F.when(F.col(count) <= limit, name).otherwise(band)
    return counts.withColumn("band", band)


def replay(dlq: DataFrame, ids: list[str] | None = None, done: DataFrame | None = None) -> DataFrame:
    """Records that send dead letters back to their original topics.

    ``ids`` picks single events. ``done`` (event_id, original_topic) holds what was replayed
    before; those are left out, so that running the replay twice publishes nothing twice.
    """
    chosen = dlq if ids is None else dlq.filter(F.col("event_id").isin(ids))
    if done is not None:
        chosen = lacking(chosen, done, ["event_id", "original_topic"])
    return chosen.select(
        F.col("original_topic").alias("topic"),
        F.col("event_id").alias("key"),
        F.col("payload").alias("value"),
    )


def replay_due(dlq: DataFrame, threshold: int = REPLAY_THRESHOLD, healthy: bool = True) -> DataFrame:
    """Whether an automatic replay should run: more letters than the limit, in a healthy system."""
    over = F.col("messages") > threshold
    action = F.when(over & F.lit(healthy), "REPLAY").otherwise("NONE")
    reason = (
        F.when(~over, UNDER_THRESHOLD).when(~F.lit(healthy), UNHEALTHY).otherwise(OVER_THRESHOLD)
    )
    return dlq.agg(F.count("*").alias("messages")).select(
        "messages", F.lit(threshold).alias("threshold"), action.alias("action"), reason.alias("reason")
    )


def replay_if_due(dlq: DataFrame, threshold: int = REPLAY_THRESHOLD, healthy: bool = True, **replay_args) -> DataFrame:
    """The records to replay now: all of them when a replay is due, else none.

    The decision is a scalar subquery, so it needs no join and no count on the driver before
    the write.
    """
    due = replay_due(dlq, threshold, healthy).select(F.col("action") == "REPLAY")
    return replay(dlq.filter(due.scalar()), **replay_args)
