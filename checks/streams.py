"""The jobs run as streams over the events table, to the end of what is there.

A stream only emits what the watermark has closed, so each statement leaves out the windows
that are still open when the input ends.
"""

from __future__ import annotations

import time
from uuid import uuid4

from checks.event_state import CARTS, CARTS_AS_OF, GREEDY
from checks.inputs import Inputs, scaled_alerts
from checks.jobs import with_details
from checks.registry import query
from checks.relations import money
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tradewind.operators.dedup import dedup_events
from tradewind.plans import jobs, orders
from tradewind.session import durable_folder, stored
from tradewind.sources.sinks import read_current
from tradewind.sources.upsert import read_table
from tradewind.sources.files import Folder
from tradewind.streaming.progress import ProgressLog, read_progress
from tradewind.streaming.order_state import order_status_changes
from tradewind.streaming.reservations import SETTINGS, reserve_as_they_come
from tradewind.streaming.runner import batch_folder_sink, start_job, upsert_sink
from tradewind.streaming.stateful import cart_changes


def run_to_end(t: Inputs, results: DataFrame, name: str, keys: list[str], mode: str = "append") -> DataFrame:
    """Run a stream over all available input through the durable sink; return what it stored."""
    folder = f"{durable_folder(t.spark)}/runs/{name}-{uuid4().hex}"
    started = start_job(
        results,
        batch_folder_sink(f"{folder}/out"),
        f"{name}-{uuid4().hex}",
        trigger=None,
        output_mode=mode,
        checkpoint=f"{folder}/checkpoint",
    )
    started.awaitTermination()
    if started.exception() is not None:
        raise started.exception()
    return read_current(t.spark, f"{folder}/out", keys)


@query(
    "t_stream_revenue_by_minute",
    f"""
    SELECT date_trunc('minute', ts) AS window_start,
           date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
           {money("amount")} AS total_revenue, COUNT(*) AS order_count,
           {money("amount")} / COUNT(*) AS avg_order_value
    FROM payments_made
    WHERE date_trunc('minute', ts) + INTERVAL 1 MINUTE
          <= (SELECT MAX(ts) - INTERVAL 10 SECONDS FROM payments_made)
    GROUP BY 1, 2""",
)
def revenue(t: Inputs):
    paid = t.of_type(t.event_stream, "purchase")
    return run_to_end(t, jobs.revenue_by_window(paid), "revenue", ["window_start"])


@query(
    "t_stream_fraud_alerts",
    """
    SELECT alert_id, alert_timestamp, user_id, alert_type, severity,
           orders_seen AS order_frequency, largest AS max_amount, payments_seen AS failed_count
    FROM alerts
    WHERE alert_timestamp + INTERVAL 1 DAY
          <= (SELECT MAX(ts) - INTERVAL 10 SECONDS FROM events
              WHERE event_type IN ('click', 'purchase'))""",
)
def fraud(t: Inputs):
    paid, ordered = t.of_type(t.event_stream, "purchase"), t.of_type(t.event_stream, "click")
    return with_details(run_to_end(t, scaled_alerts(paid, ordered), "fraud", ["alert_id"]))


@query(
    "t_stream_cart_abandonment",
    """
    SELECT c.user_id, c.product_id, c.ts AS item_added_time FROM clicks c
    WHERE NOT EXISTS (SELECT 1 FROM payments_made p WHERE p.user_id = c.user_id
                      AND p.ts >= c.ts AND p.ts <= c.ts + INTERVAL 12 HOURS)
      AND c.ts + INTERVAL 13 HOURS <= (SELECT least((SELECT MAX(ts) FROM clicks),
                                                    (SELECT MAX(ts) FROM payments_made)))""",
)
def abandonment(t: Inputs):
    added, paid = t.of_type(t.event_stream, "click"), t.of_type(t.event_stream, "purchase")
    found = jobs.cart_abandonment(added, paid, "12 hours", "1 hour")
    return run_to_end(t, found, "carts", ["user_id", "product_id", "item_added_time"])


@query(
    "t_stream_topic_throughput",
    """
    SELECT date_trunc('hour', ts) AS window_start,
           date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type AS topic,
           'throughput' AS metric_name, COUNT(*) AS metric_value, 20 AS threshold,
           CASE WHEN COUNT(*) > 15 THEN 'HEALTHY' WHEN COUNT(*) > 8 THEN 'WARNING'
                ELSE 'CRITICAL' END AS status
    FROM events
    WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR
          <= (SELECT MAX(ts) - INTERVAL 10 SECONDS FROM events)
    GROUP BY 1, 2, 3""",
)
def throughput(t: Inputs):
    health = jobs.topic_throughput_health(t.as_envelope(t.event_stream), "1 hour", topics=None)
    return run_to_end(t, health, "throughput", ["topic", "window_start"]).drop("services_checked")


@query(
    "t_stream_dedup_events",
    """
    SELECT event_type, CAST(event_id AS VARCHAR) AS event_id, ts AS event_timestamp FROM events""",
)
def dedup(t: Inputs):
    once = t.event_stream.select(
        "event_type", F.col("event_id").cast("string").alias("event_id"), F.col("ts").alias("event_timestamp")
    )
    repeated = once.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return run_to_end(t, dedup_events(repeated), "dedup", ["event_type", "event_id"])


# The furthest status of each order in the log and the last time it was reported.
STATUS = """
    SELECT order_id, status, MAX(updated_at) AS updated_at FROM (
      SELECT order_id, updated_at, status, step, MAX(step) OVER (PARTITION BY order_id) AS furthest FROM (
        SELECT props AS order_id, ts AS updated_at,
               CASE event_type WHEN 'purchase' THEN 2 WHEN 'click' THEN 1 ELSE 0 END AS step,
               CASE event_type WHEN 'purchase' THEN 'PAID' WHEN 'click' THEN 'RESERVATION_CONFIRMED'
                               ELSE 'PENDING' END AS status
        FROM events WHERE event_type IN ('signup', 'click', 'purchase')) e) f
    WHERE step = furthest GROUP BY order_id, status"""


def status_log(events: DataFrame) -> DataFrame:
    kind = (
        F.when(F.col("event_type") == "signup", "order.created")
        .when(F.col("event_type") == "click", "inventory.reserved")
        .when(F.col("event_type") == "purchase", "payment.processed")
    )
    return events.select(
        kind.alias("event_type"), F.col("props").alias("order_id"), F.col("ts").alias("event_timestamp")
    ).filter("event_type is not null")


@query("t_stream_order_status", STATUS)
def status(t: Inputs):
    return run_to_end(t, orders.order_status(status_log(t.event_stream)), "status", ["order_id"], "update")


@query("s10_upsert_across_runs", STATUS)
def upserts(t: Inputs):
    """Two streams with a checkpoint each keep one table; then a batch of the first comes once more."""
    folder = f"{durable_folder(t.spark)}/runs/upsert-{uuid4().hex}"
    sink = upsert_sink(f"{folder}/table", ["order_id"], "bucket", newest_by="progress", by=F.pmod(F.xxhash64("order_id"), F.lit(8)))
    progress = F.struct(orders.step_of(F.col("status")), "updated_at").alias("progress")
    early = t.event_stream.filter("event_type <> 'purchase'")
    for run, source in enumerate((early, t.event_stream)):
        found = orders.order_status(status_log(source)).select("*", progress)
        started = start_job(found, sink, f"upsert-{uuid4().hex}", None, "update", f"{folder}/checkpoint-{run}")
        started.awaitTermination()
        if started.exception() is not None:
            raise started.exception()
    stale = orders.order_status(status_log(t.events.filter("event_type = 'signup'"))).select("*", progress)
    sink(stale, 0)
    return read_table(t.spark, f"{folder}/table").select("order_id", "status", "updated_at")


@query("t_stream_order_machine", STATUS)
def machine(t: Inputs):
    """A table of orders opens the state; the stream then brings what happened since."""
    known = stored(orders.order_status(status_log(t.events.filter("event_type = 'signup'"))))
    later = status_log(t.event_stream.filter("event_type <> 'signup'"))
    folder = f"{durable_folder(t.spark)}/runs/machine-{uuid4().hex}"
    table = upsert_sink(f"{folder}/table", ["order_id"], "bucket", by=F.pmod(F.xxhash64("order_id"), F.lit(8)))
    table(known, 0)
    started = start_job(order_status_changes(later, known), table, f"machine-{uuid4().hex}", None, "update", f"{folder}/checkpoint")
    started.awaitTermination()
    if started.exception() is not None:
        raise started.exception()
    return read_table(t.spark, f"{folder}/table").drop("bucket")


@query(
    "t_stream_current_carts",
    f"""{CARTS}
    SELECT user_id, product_id, quantity, price, quantity * price AS item_total, last_update
    FROM carts""",
)
def current_carts(t: Inputs):
    """Every change of a cart replaces it in a table; carts that are empty or run out are left out."""
    until = t.event_stream.filter(F.col("ts") <= F.lit(CARTS_AS_OF).cast("timestamp"))
    folder = f"{durable_folder(t.spark)}/runs/carts-{uuid4().hex}"
    table = upsert_sink(f"{folder}/table", ["user_id"], "bucket", by=F.pmod(F.xxhash64("user_id"), F.lit(8)))
    started = start_job(cart_changes(t.as_cart_log(until)), table, f"carts-{uuid4().hex}", None, "update", f"{folder}/checkpoint")
    started.awaitTermination()
    if started.exception() is not None:
        raise started.exception()
    living = F.col("last_update") + F.expr("INTERVAL 24 HOURS") > F.lit(CARTS_AS_OF).cast("timestamp")
    return read_table(t.spark, f"{folder}/table").filter(F.col("product_id").isNotNull() & living).drop("bucket")


@query(
    "t_stream_reserve_greedy",
    f"""SELECT product_id, id, amount, event_timestamp, quantity, accepted FROM ({GREEDY}) g
    WHERE event_timestamp <= (SELECT MAX(created_at) - INTERVAL 800 DAYS FROM lines)""",
)
def reservations(t: Inputs):
    """Requests come in four parts whose times overlap by a year, with a restart after two of them."""
    folder = f"{durable_folder(t.spark)}/runs/reserve-{uuid4().hex}"
    requests = t.lines.select(
        "product_id", "id", "amount", F.col("created_at").alias("event_timestamp"), "quantity"
    )
    year = F.year("event_timestamp") - 1992 + F.pmod(F.xxhash64("id"), F.lit(2))
    parts = requests.withColumn("part", F.least(F.lit(3), F.floor(year / 2)).cast("int"))
    files = 1
    for part in range(4):
        parts.filter(F.col("part") == part).drop("part").write.option("compression", "zstd").parquet(f"{folder}/in/part={part}")
        # A part is a trigger's worth, however many files its tasks have written.
        files = max(files, len(t.spark.read.schema(requests.schema).parquet(f"{folder}/in/part={part}").inputFiles()))
        if part in (1, 3):
            # What a batch has read is deleted when the next one begins, and the rest in the end.
            reader = t.spark.readStream.schema(requests.schema).option("maxFilesPerTrigger", files).option("cleanSource", "delete")
            source = reader.parquet(f"{folder}/in/part=*")
            decided = reserve_as_they_come(source, t.products, ("id", "amount"), "800 days")
            sink, name = batch_folder_sink(f"{folder}/out", merged=False), f"reserve-{uuid4().hex}"
            started = start_job(decided, sink, name, None, "append", f"{folder}/checkpoint", SETTINGS)
            started.awaitTermination()
            if started.exception() is not None:
                raise started.exception()
            Folder(t.spark, f"{folder}/in").remove()
    return t.spark.read.parquet(f"{folder}/out").drop("run", "batch_id").withColumn("quantity", F.col("quantity").cast("int"))


@query(
    "t_stream_late_rows",
    """
    SELECT COUNT(*) AS input_rows, COUNT(*) FILTER (WHERE NOT late) AS accepted_rows, COUNT(*) FILTER (WHERE late) AS dropped_rows
    FROM (SELECT ts < TIMESTAMP '2024-01-10' AND user_id % 10 = 0 AS late FROM events)""",
)
def late_rows(t: Inputs):
    """Three files; the last one holds rows of a time that the watermark has passed by then."""
    folder, name = f"{durable_folder(t.spark)}/runs/late-{uuid4().hex}", f"late-{uuid4().hex}"
    late = (F.col("ts") < F.lit("2024-01-10").cast("timestamp")) & (F.col("user_id") % 10 == 0)
    first = F.col("ts") < F.lit("2024-01-15").cast("timestamp")
    for part in (~late & first, ~late & ~first, late):
        t.events.filter(part).repartition(1).write.mode("append").parquet(f"{folder}/in")
    source = t.spark.readStream.schema(t.table_schema("events")).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    once = dedup_events(source.select("event_type", F.col("event_id").cast("string").alias("event_id"), F.col("ts").alias("event_timestamp")))
    log = ProgressLog(t.spark, name, f"{folder}/progress")
    t.spark.streams.addListener(log)
    try:
        started = start_job(once, batch_folder_sink(f"{folder}/out"), name, None, "append", f"{folder}/checkpoint")
        started.awaitTermination()
        # Listeners are told asynchronously.
        for _ in range(100):
            if Folder(t.spark, f"{folder}/progress").has(f"{started.lastProgress.batchId}.json"):
                break
            time.sleep(0.1)
    finally:
        t.spark.streams.removeListener(log)
    found = read_progress(t.spark, f"{folder}/progress")
    return found.agg(*[F.sum(c).alias(c) for c in ("input_rows", "accepted_rows", "dropped_rows")])
