"""Schemas, topic and table adapters, sinks, dead letters."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tradewind.functions import scalars
from tradewind.plans import alerting, dead_letters, notifications, orders, samples, stock
from tradewind.schemas import RESULT_KEYS, TABLE_NAMES, TOPICS, conform, schema_for, table_schema
from tradewind.sources import sinks, tables, topics

NOON = datetime(2024, 3, 5, 12)


def test_registry_covers_all_topics_and_tables(spark):
    assert len(TOPICS) == 15 and len(TABLE_NAMES) == 11
    for topic in TOPICS:
        assert "event_id" in schema_for(topic).names
    assert schema_for("no.such.event").names == ["event_id", "event_type", "timestamp", "correlation_id"]
    assert schema_for("payment.processed")["amount"].dataType.simpleString() == "double"
    assert table_schema("revenue_metrics")["total_revenue"].dataType.simpleString() == "decimal(12,2)"
    for table, keys in RESULT_KEYS.items():
        assert set(keys) <= set(table_schema(table).names)


def test_kafka_options():
    options = topics.source_options("broker:9092", 5000)
    assert options == {
        "kafka.bootstrap.servers": "broker:9092",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "5000",
    }


def test_jdbc_options():
    assert tables.jdbc_options("jdbc:postgresql://h/db", "u", "p")["driver"] == "org.postgresql.Driver"
    split = tables.jdbc_reader_options("orders", "id", "0", "1000", 8)
    assert split["numPartitions"] == "8" and split["partitionColumn"] == "id"
    assert "numPartitions" not in tables.jdbc_reader_options("orders")


def envelope(spark, *values, topic="payment.processed"):
    records = [(v.encode(), topic, 0, i, NOON) for i, v in enumerate(values)]
    return spark.createDataFrame(records, "value binary, topic string, partition int, offset long, timestamp timestamp")


def test_decode_reads_offsets_ignores_extras_and_survives_garbage(spark):
    found = topics.decode(
        envelope(
            spark,
            '{"amount": 1.5, "timestamp": "2024-03-05T04:00:00.25-08:00", "extra": 1}',
            '{"amount": 2.5, "timestamp": "soon"}',
            "garbage",
        ),
        "payment.processed",
        ["amount", "user_id"],
    )
    assert found.columns == ["amount", "user_id", "event_timestamp"]
    times = sorted((r.amount is None, r.amount, r.event_timestamp) for r in found.collect())
    assert times[0][2] == datetime(2024, 3, 5, 12, 0, 0, 250000)
    assert times[1][2] is None and times[2][1] is None


def test_dead_letter_time_is_in_seconds(spark):
    letter = '{"original_topic": "cart.x", "timestamp": 1709640000.5, "payload": {"a": 1}}'
    (row,) = topics.decode(envelope(spark, letter, topic="dlq.events"), "dlq.events").collect()
    assert row.event_timestamp == datetime(2024, 3, 5, 12, 0, 0, 500000)
    assert json.loads(row.payload) == {"a": 1}


def test_topic_depth(spark, rows):
    assert rows(topics.topic_depth(envelope(spark, "a", "b", "c"))) == [("payment.processed", 0, 3, 0, 3)]


def test_split_valid_gives_reasons_and_keeps_everything(spark):
    schema = schema_for("payment.failed")
    good = {"event_id": "1", "event_type": "payment.failed", "timestamp": "2024-03-05T12:00:00Z", "correlation_id": "c", "order_id": "o", "user_id": "u", "reason": "r"}
    raw = envelope(
        spark,
        json.dumps(good),
        json.dumps({**good, "reason": None, "user_id": None}),
        json.dumps({**good, "timestamp": "soon"}),
        '{"event_id": "1", ',
        "[1, 2]",
        topic="payment.failed",
    )
    valid, rejected = dead_letters.split_valid(raw.withColumnRenamed("timestamp", "received"), schema)
    assert [r.order_id for r in valid.collect()] == ["o"]
    reasons = {r.offset: (r.error_type, r.error_reason) for r in rejected.collect()}
    assert reasons[1] == ("ValidationError", "missing user_id, reason")
    assert reasons[2] == ("ValidationError", "timestamp is not a time")
    assert reasons[3][0] == reasons[4][0] == "JSONDecodeError"
    letters = dead_letters.to_dlq(rejected.withColumnRenamed("received", "timestamp")).collect()
    assert {r.original_topic for r in letters} == {"payment.failed"} and letters[0].retry_count == 3
    assert sorted((r.event_id, r.original_event_type, r.correlation_id) for r in letters if r.event_id) == [("1", "payment.failed", "c")] * 2


def test_split_valid_parses_once(spark):
    plan = dead_letters.judged(envelope(spark, "{}"), schema_for("payment.failed"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1 and "get_json_object" not in plan


def test_published_events_are_valid(spark):
    """What this library publishes passes its own validation."""
    paid = spark.createDataFrame(
        [("o1", "u", None, "PAID", datetime(2024, 3, 5)), ("o2", "u", "c", "PAID", datetime(2024, 3, 5))],
        "order_id string, user_id string, correlation_id string, status string, updated_at timestamp",
    )
    shipped = orders.fulfilment_candidates(paid, "2024-03-06 00:00:00")
    told = shipped.select("*", *[F.lit(None).cast("string").alias(name) for name in ("product_id", "cancellation_source", "reason")])
    mailed = notifications.notifications(told, "admin@example.com")
    for events, topic in ((shipped, "order.fulfilled"), (mailed, "notification.send")):
        records = events.select(F.lit(topic).alias("topic"), F.to_json(F.struct("*")).alias("value"))
        valid, rejected = dead_letters.split_valid(records, schema_for(topic))
        assert (valid.count(), rejected.count()) == (2, 0)


def test_replay_leaves_out_what_was_replayed(spark, rows):
    letters = spark.createDataFrame(
        [("1", "order.created", "{}"), ("2", "order.created", "{}"), ("1", "cart.item_added", "{}")],
        "event_id string, original_topic string, payload string",
    )
    done = spark.createDataFrame([("1", "order.created")], "event_id string, original_topic string")
    assert rows(dead_letters.replay(letters, ["1"], done)) == [("cart.item_added", "1", "{}")]
    assert dead_letters.replay_if_due(letters, threshold=3).count() == 0
    assert dead_letters.replay_if_due(letters, threshold=2).count() == 3
    assert dead_letters.replay_if_due(letters, threshold=2, healthy=False).count() == 0


@pytest.mark.parametrize("count, band", [(0, "HEALTHY"), (1, "MINOR"), (5, "MINOR"), (6, "MODERATE"), (50, "MODERATE"), (51, "CRITICAL")])
def test_dead_letter_bands(spark, count, band):
    counted = spark.createDataFrame([("cart", count)], "service string, messages long")
    assert dead_letters.dlq_band(counted).first().band == band


def test_services_without_dead_letters_are_listed(spark, rows):
    letters = spark.createDataFrame([("cart.x",), ("cart.y",), ("nodot",), (None,)], "original_topic string")
    assert rows(dead_letters.dlq_by_service(letters)) == [
        ("cart", 2), ("inventory", 0), ("notification", 0), ("order", 0), ("payment", 0), ("unknown", 2),
    ]


def test_snapshot_replaces_only_the_partitions_it_has(spark, tmp_path, rows):
    path = str(tmp_path / "table")
    sinks.write_snapshot(spark.createDataFrame([(1, "a"), (2, "b")], "v int, day string"), path, ["day"])
    sinks.write_snapshot(spark.createDataFrame([(9, "b")], "v int, day string"), path, ["day"])
    assert rows(spark.read.parquet(path)) == [(1, "a"), (9, "b")]
    sinks.append(spark.createDataFrame([(3,)], "v int"), f"{path}/day=a")
    assert spark.read.parquet(path).count() == 3


def test_staging_in_one_file(spark, tmp_path):
    path = tmp_path / "stage"
    sinks.write_parquet(spark.range(100), str(path), files=1)
    assert len(list(path.glob("part-*"))) == 1


def test_records_for_a_topic(spark):
    rows_in = spark.createDataFrame([("order.created", "o1", 5.0)], "topic string, order_id string, amount double")
    (record,) = sinks.to_topic(rows_in, key="order_id").collect()
    assert (record.topic, record.key, json.loads(record.value)) == ("order.created", "o1", {"order_id": "o1", "amount": 5.0})
    (record,) = sinks.to_dead_letter_topic(rows_in.drop("topic")).collect()
    assert record.topic == "dlq.events"


def test_conform_fills_and_casts(spark):
    found = conform(spark.createDataFrame([("o", "3")], "order_id string, total_amount string"), "orders")
    row = found.first()
    assert row.total_amount == 3.0 and row.created_at is None and found.columns == table_schema("orders").names


@pytest.mark.parametrize(
    "path, template",
    [
        ("/cart/user_001/items", "/cart/{user_id}/items"),
        ("/order/12345", "/order/{id}"),
        ("/order/12345/67/items", "/order/{id}/{id}/items"),
        ("/payment/txn_abc123/status", "/payment/{reference_id}/status"),
        ("/products/prod_001", "/products/prod_001"),
    ],
)
def test_endpoint_template(spark, path, template):
    frame = spark.createDataFrame([(path,)], "path string")
    assert frame.select(scalars.endpoint_template("path")).first()[0] == template


def test_labels_services_and_ids(spark):
    frame = spark.createDataFrame([("high", "cart.x"), ("", "nodot"), (None, None)], "s string, t string")
    got = [tuple(r) for r in frame.select(scalars.label("s", "UNKNOWN", upper=True), scalars.service_of("t")).collect()]
    assert got == [("HIGH", "cart"), ("UNKNOWN", "unknown"), ("UNKNOWN", "unknown")]
    one = spark.range(1).select(
        scalars.tracking_number(F.lit("ORD-ABCDEF123456")),
        scalars.derived_id("PAY-", F.lit("k")),
        scalars.percent(F.lit(1), F.lit(8)),
        scalars.percent(F.lit(1), F.lit(0)),
        scalars.whole_hours_since(F.lit("2024-01-01 10:30:00").cast("timestamp"), "2024-01-01 12:00:00"),
    ).first()
    assert one[0] == "TRK-EF123456" and one[1].startswith("PAY-") and len(one[1]) == 16
    assert one[2] == 12.5 and one[3] is None and one[4] == 2


def test_cancellation_mail_depends_on_the_cause(spark):
    events = spark.createDataFrame(
        [("1", "order.cancelled", "u", "o", None, c) for c in ("payment_failed", "inventory_depleted", None)]
        + [("2", "inventory.low", None, None, "p", None), ("3", "order.created", "u", "o", None, None)],
        "event_id string, event_type string, user_id string, order_id string, product_id string, cancellation_source string",
    )
    for absent in ("correlation_id", "tracking_number", "reason"):
        events = events.withColumn(absent, F.lit(None).cast("string"))
    found = notifications.notifications(events, "admin@example.com").collect()
    assert sorted((r.subject, r.recipient_email, r.user_id) for r in found) == [
        ("Low Stock Alert: Product #p", "admin@example.com", "unknown"),
        ("Order Cancelled #o", "u@example.com", "u"),
        ("Order Cancelled - Out of Stock #o", "u@example.com", "u"),
        ("Order Cancelled - Payment Failed #o", "u@example.com", "u"),
    ]


def sample_rows(spark, values, metric="m", start=0):
    rows_in = [(datetime(2024, 1, 1, 0, start + i), metric, {"b": "2", "a": "1"}, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows_in, "ts timestamp, metric string, labels map<string,string>, value double")


def test_counter_restart_counts_the_new_value(spark):
    grown = samples.increase(sample_rows(spark, [10, 15, 3, 4]), "1 hour")
    assert grown.first().increase == 5 + 3 + 1


def test_rate_at_the_edges_of_the_range(spark, rows):
    # Growth at 00:05 belongs to the range that ends then, not to the next one.
    counted = sample_rows(spark, [0, 1, 2, 3, 4, 64])
    found = samples.rate(counted, "5 minutes", ["a"])
    assert rows(found.select("a", "ts", "rate")) == [("1", datetime(2024, 1, 1, 0, 5), 64 / 300)]


@pytest.mark.parametrize(
    "values, q, expected",
    [
        ([0.05] * 10, 0.5, 0.05),
        ([0.3] * 9 + [7.0], 0.5, 0.1 + 0.4 * 5 / 9),
        ([99.0] * 3, 0.95, 10.0),
    ],
)
def test_histogram_quantile(spark, values, q, expected):
    frame = spark.createDataFrame([(v,) for v in values], "seconds double")
    histogram = samples.buckets(frame, "seconds", samples.PROCESSING_BOUNDS)
    assert samples.histogram_quantile(histogram, q).first().quantile == pytest.approx(expected)


def test_mean_latency(spark):
    both = sample_rows(spark, [0, 10, 30], "sum").unionByName(sample_rows(spark, [0, 4, 8], "count"))
    assert samples.mean_latency(both, "sum", "count", "1 hour").first().mean_latency == 30 / 8


def test_alert_rules(spark):
    values = spark.createDataFrame(
        [("fraud_alerts_per_hour", 10.0), ("cart_abandonment_rate", 60.1), ("revenue_vs_average", 0.79), ("dlq_messages", 75.0)],
        "kpi string, value double",
    )
    firing = {r.alert for r in alerting.evaluate_alerts(values).collect() if r.firing}
    assert firing == {"high_cart_abandonment", "revenue_anomaly", "dead_letters"}


def test_refill_plan(spark, rows):
    products = spark.createDataFrame([("a", 19, 1), ("b", 20, 1)], "product_id string, stock int, version int")
    plan = stock.refill_plan(products, NOON)
    assert rows(plan.drop("updated_at")) == [("a", 19, 69, 2, 50)]
    assert rows(stock.refill_summary(plan)) == [(1, 50, 1)]


def test_outbox_is_published_and_marked(spark):
    outbox = spark.createDataFrame(
        [("1", "o", "order.created", "{}", "N"), ("2", "o", "order.created", "{}", "Y")],
        "id string, order_id string, event_type string, event_data string, published string",
    )
    records, marked = orders.publish_outbox(outbox, NOON)
    assert [(r.topic, r.key, r.value) for r in records.collect()] == [("order.created", "o", "{}")]
    assert [(r.id, r.published, r.published_at) for r in marked.collect()] == [("1", "Y", NOON)]


def test_offset_ranges(spark, tmp_path, rows):
    df = envelope(spark, *"abcdef")
    ranged = topics.between(df, {"payment.processed": {0: 2}, "other": {0: 99}}, {"payment.processed": {0: 5}})
    assert [r.offset for r in ranged.orderBy("offset").collect()] == [2, 3, 4]
    assert topics.between(df, None, {}).count() == 0 and topics.between(df, {}, None).count() == 6
    plan = topics.between(df, {"payment.processed": {0: 2}})
    plan.write.parquet(str(tmp_path / "in"))
    scan = topics.between(topics.scan_files(spark, str(tmp_path / "in")), {"payment.processed": {0: 3}})
    assert "PushedFilters: []" not in scan._jdf.queryExecution().executedPlan().toString() and scan.count() == 3


def test_progress_survives_a_crash(spark, tmp_path):
    def new():
        return topics.Progress(spark, str(tmp_path / "progress"))

    assert [r.offset for r in new().take(envelope(spark, "a", "b")).collect()] == [0, 1]
    first = new()
    taken = first.take(envelope(spark, "a", "b"))
    first.done()
    assert taken.count() == 2 and new().offsets() == {"payment.processed": {0: 2}}
    second = new()
    assert [r.offset for r in second.take(envelope(spark, "a", "b", "c")).collect()] == [2]
    second.done()
    third = new()
    assert third.take(envelope(spark, "a", "b", "c")).count() == 0
    third.done()
    assert new().offsets() == {"payment.processed": {0: 3}}


def test_outbox_without_pending_rows(spark, tmp_path):
    from tradewind.sources.outbox import publish_pending

    outbox = spark.createDataFrame([("1", "o", "t", "{}", "Y")], "id string, order_id string, event_type string, event_data string, published string")
    sent = []
    marked = publish_pending(outbox, str(tmp_path), lambda records, name: sent.append(name), "2024-01-01")
    assert marked.count() == 0 and sent == []
    waiting = outbox.withColumn("published", F.lit("N"))
    for _ in range(2):
        marked = publish_pending(waiting, str(tmp_path), lambda records, name: sent.append(records.count()), "2024-01-01")
        assert [(r.id, r.published) for r in marked.collect()] == [("1", "Y")]
    assert sent == [1]


def test_as_of_values_at_limits_and_ties(spark, rows):
    from tradewind.operators.slices import as_of_values

    at = lambda m: datetime(2024, 1, 1, 12, m)
    points = spark.createDataFrame([("a", at(0)), ("a", at(10)), ("a", at(40)), ("b", at(10)), (None, at(10)), ("a", None)], "k string, ts timestamp")
    told = spark.createDataFrame(
        [("a", at(10), 1, 1.0), ("a", at(10), 2, 2.0), ("a", at(9), 9, 9.0), ("a", None, 3, 3.0), (None, at(1), 4, 4.0), ("c", at(1), 5, None)],
        "k string, ts timestamp, n int, v double")
    for width in ("1 minute", "1 day"):
        found = as_of_values(points, told, ["k"], "ts", ["v"], "30 minutes", ["n"], width=width)
        assert rows(found) == sorted([("a", at(0), None, None), ("a", at(10), at(10), 2.0), ("a", at(40), at(10), 2.0), ("b", at(10), None, None),
                                      (None, at(10), at(1), 4.0), ("a", None, None, None)], key=repr)
        stale = as_of_values(points, told, ["k"], "ts", ["v"], "29 minutes", ["n"], width=width).filter("k = 'a' and minute(ts) = 40")
        assert [r.as_of_v for r in stale.collect()] == [None]
