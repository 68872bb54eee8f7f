"""Jobs as streams: equal to the batch, restartable, late data dropped, replays harmless."""

import json
from datetime import datetime, timedelta, timezone

import pytest

from tradewind.operators.dedup import dedup_events
from tradewind.plans import jobs
from tradewind.schemas import RESULT_KEYS
from tradewind.sources.sinks import merge_source, read_current, write_batch
from tradewind.sources.files import Folder, run_token
from tradewind.sources.topics import decode, scan_files, stream_files
from tradewind.sources.upsert import read_table, upsert
from tradewind.streaming.runner import batch_folder_sink, start_job

NOON = datetime(2024, 3, 5, 12)
ENVELOPE = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"


class Topic:
    """A folder of envelope files; each call of ``send`` adds one file."""

    def __init__(self, spark, path):
        self.spark, self.path, self.offset = spark, str(path), 0

    def send(self, *events):
        records = []
        for topic, at, payload in events:
            stamp = at.replace(tzinfo=timezone.utc).astimezone(timezone(timedelta(hours=-8)))
            value = json.dumps({"event_id": str(self.offset), "timestamp": stamp.isoformat(), **payload})
            records.append((None, value.encode(), topic, 0, self.offset, at))
            self.offset += 1
        self.spark.createDataFrame(records, ENVELOPE).coalesce(1).write.mode("append").parquet(self.path)

    def payment(self, at, amount=10.0, user="u"):
        return ("payment.processed", at, {"user_id": user, "order_id": "o", "amount": amount})

    def order(self, at, amount=10.0, user="u"):
        return ("order.created", at, {"user_id": user, "order_id": "o", "total_amount": amount})

    def added(self, at, user="u", product="p"):
        return ("cart.item_added", at, {"user_id": user, "product_id": product})

    def checkout(self, at, user="u"):
        return ("cart.checkout_initiated", at, {"user_id": user})


@pytest.fixture()
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


def run(results, tmp_path, table=None, mode="append", name="job"):
    query = start_job(
        results,
        batch_folder_sink(str(tmp_path / "out"), table),
        name,
        trigger=None,
        output_mode=mode,
        checkpoint=str(tmp_path / "checkpoint"),
    )
    query.awaitTermination(120)
    assert query.exception() is None


def seconds(n):
    return timedelta(seconds=n)


def revenue(source):
    return jobs.revenue_by_window(decode(source, "payment.processed", ["amount"]))


def test_revenue_stream_equals_batch_over_many_files(spark, topic, tmp_path, rows):
    for step in range(5):
        topic.send(*[topic.payment(NOON + seconds(step * 40 + i * 7), 1.1 * i) for i in range(5)])
    topic.send(topic.payment(NOON + timedelta(hours=1)))
    run(revenue(stream_files(spark, topic.path, max_files_per_trigger=1)), tmp_path)
    stored = read_current(spark, str(tmp_path / "out"), ["window_start"])
    closed = revenue(scan_files(spark, topic.path)).filter(f"window_end <= timestamp '{NOON + timedelta(minutes=30)}'")
    assert rows(stored) == rows(closed) and stored.count() == 4


def test_late_payment_is_dropped(spark, topic, tmp_path, rows):
    topic.send(topic.payment(NOON, 1.0))
    # The batch that moves the watermark on still takes late rows; the batches after it do not.
    topic.send(topic.payment(NOON + timedelta(minutes=10), 2.0))
    topic.send(topic.payment(NOON + timedelta(minutes=10, seconds=1), 2.0))
    topic.send(topic.payment(NOON + seconds(5), 50.0))
    topic.send(topic.payment(NOON + timedelta(hours=1), 3.0))
    run(revenue(stream_files(spark, topic.path, max_files_per_trigger=1)), tmp_path)
    stored = read_current(spark, str(tmp_path / "out"), ["window_start"])
    assert [(r[0], r[2]) for r in rows(stored)] == [(NOON, 1.0), (NOON + timedelta(minutes=10), 4.0)]


def test_restart_continues_from_the_checkpoint(spark, topic, tmp_path, rows):
    topic.send(topic.payment(NOON, 1.0))
    run(revenue(stream_files(spark, topic.path)), tmp_path)
    topic.send(topic.payment(NOON + seconds(30), 2.0))
    topic.send(topic.payment(NOON + timedelta(hours=1), 3.0))
    run(revenue(stream_files(spark, topic.path)), tmp_path)
    stored = read_current(spark, str(tmp_path / "out"), ["window_start"])
    assert [(r[0], r[2], r[3]) for r in rows(stored)] == [(NOON, 3.0, 2)]
    run(revenue(stream_files(spark, topic.path)), tmp_path)
    again = read_current(spark, str(tmp_path / "out"), ["window_start"])
    assert rows(again) == rows(stored)


def test_result_table_types_and_stamp(spark, topic, tmp_path):
    topic.send(topic.payment(NOON, 0.005), topic.payment(NOON, 0.005), topic.payment(NOON + timedelta(hours=1)))
    run(revenue(stream_files(spark, topic.path)), tmp_path, "revenue_metrics")
    (row,) = read_current(spark, str(tmp_path / "out"), RESULT_KEYS["revenue_metrics"]).collect()
    assert str(row.total_revenue) == "0.01" and row.order_count == 2
    assert row.created_at is not None


def test_fraud_stream_equals_batch(spark, topic, tmp_path, rows):
    events = []
    for minute in range(12):
        at = NOON + timedelta(minutes=minute)
        events.append(topic.order(at, 400.0 * minute, user=f"u{minute % 2}"))
        events.append(topic.payment(at + seconds(5), 10.0, user=f"u{minute % 3}"))
    topic.send(*events[:10])
    topic.send(*events[10:])
    end = NOON + timedelta(hours=2)
    topic.send(topic.payment(end, 1.0, "z"), topic.order(end, 1.0, "z"))

    def alerts(source):
        paid = decode(source, "payment.processed", ["amount", "user_id"])
        ordered = decode(source, "order.created", ["total_amount", "user_id"])
        return jobs.fraud_alerts(paid, ordered)

    run(alerts(stream_files(spark, topic.path, max_files_per_trigger=1)), tmp_path)
    stored = read_current(spark, str(tmp_path / "out"), ["alert_id"]).select("alert_id", "alert_type", "severity", "details")
    batch = alerts(scan_files(spark, topic.path)).select("alert_id", "alert_type", "severity", "details")
    assert rows(stored) == rows(batch) and stored.count() > 10


def abandoned(source):
    return jobs.cart_abandonment(
        decode(source, "cart.item_added", ["user_id", "product_id"]),
        decode(source, "cart.checkout_initiated", ["user_id"]),
    )


@pytest.mark.parametrize("minutes, emitted", [(59, False), (61, True)])
def test_abandoned_item_is_known_after_an_hour(spark, topic, tmp_path, minutes, emitted):
    later = NOON + timedelta(minutes=minutes)
    topic.send(topic.added(NOON))
    topic.send(topic.added(later, user="x"), topic.checkout(later, user="y"))
    run(abandoned(stream_files(spark, topic.path, max_files_per_trigger=1)), tmp_path)
    stored = (tmp_path / "out").exists() and read_current(spark, str(tmp_path / "out"), ["user_id", "product_id"]).collect()
    assert [r.user_id for r in stored or []] == (["u"] if emitted else [])


def test_cart_stream_equals_batch(spark, topic, tmp_path, rows):
    half_hour = timedelta(minutes=30)
    topic.send(topic.added(NOON), topic.added(NOON, "v"), topic.added(NOON + seconds(1), "w", "q"))
    topic.send(topic.checkout(NOON + half_hour), topic.checkout(NOON + half_hour + timedelta(microseconds=1000), "v"))
    end = NOON + timedelta(hours=5)
    topic.send(topic.added(end, "x"), topic.checkout(end, "y"))
    run(abandoned(stream_files(spark, topic.path, max_files_per_trigger=1)), tmp_path)
    stored = read_current(spark, str(tmp_path / "out"), ["user_id", "product_id", "item_added_time"])
    batch = abandoned(scan_files(spark, topic.path)).filter("user_id <> 'x'")
    assert rows(stored) == rows(batch)
    assert [r[0] for r in rows(stored)] == ["v", "w"]


def test_throughput_uses_the_broker_time(spark, topic, tmp_path, rows):
    topic.send(*[topic.payment(NOON + seconds(i)) for i in range(16)], topic.order(NOON))
    topic.send(topic.payment(NOON + timedelta(hours=1)))
    health = jobs.topic_throughput_health(stream_files(spark, topic.path, max_files_per_trigger=1))
    run(health, tmp_path, "operational_metrics")
    stored = read_current(spark, str(tmp_path / "out"), RESULT_KEYS["operational_metrics"])
    assert sorted((r.topic, int(r.metric_value), r.status) for r in stored.collect()) == [
        ("order.created", 1, "CRITICAL"),
        ("payment.processed", 16, "HEALTHY"),
    ]


def test_dedup_stream_drops_a_repeat_within_the_delay(spark, topic, tmp_path):
    def events(source):
        typed = source.selectExpr("topic as event_type", "'same' as event_id", "timestamp as event_timestamp")
        return dedup_events(typed)

    topic.send(topic.payment(NOON), topic.order(NOON))
    topic.send(topic.payment(NOON + seconds(1)))
    run(events(stream_files(spark, topic.path, max_files_per_trigger=1)), tmp_path)
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.event_type for r in stored.collect()) == ["order.created", "payment.processed"]


def test_replayed_batch_replaces_itself(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    write_batch(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), path, 0)
    write_batch(spark.createDataFrame([("a", 2)], "k string, v int"), path, 1)
    write_batch(spark.createDataFrame([("a", 3)], "k string, v int"), path, 1)
    assert rows(read_current(spark, path, ["k"])) == [("a", 3), ("b", 1)]


def test_a_small_batch_is_one_file(spark, tmp_path):
    write_batch(spark.range(100).repartition(20), str(tmp_path / "out"), 0)
    assert len(list((tmp_path / "out" / "run=r0" / "batch_id=0").glob("part-*"))) == 1


def test_empty_batches_write_nothing(spark, topic, tmp_path):
    topic.send(topic.payment(NOON))
    run(revenue(stream_files(spark, topic.path)), tmp_path)
    assert not (tmp_path / "out").exists()


def test_all_rows_of_the_latest_batch_stay(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    write_batch(spark.createDataFrame([("a", 1), ("b", 1), ("b", 1), (None, 1), (None, 2)], "k string, v int"), path, 0)
    write_batch(spark.createDataFrame([("a", 2), ("a", 3), (None, 3), (None, 4)], "k string, v int"), path, 1)
    assert rows(read_current(spark, path, ["k"])) == sorted([("a", 2), ("a", 3), ("b", 1), ("b", 1), (None, 3), (None, 4)], key=repr)


def test_merge_refuses_rows_that_share_a_key(spark, rows):
    df = spark.createDataFrame([("a", 1), (None, 1), ("b", 2)], "k string, v int")
    assert rows(merge_source(df, ["k"])) == rows(df)
    for more in ("a", None):
        with pytest.raises(Exception, match="share the key"):
            merge_source(df.union(spark.createDataFrame([(more, 5)], "k string, v int")), ["k"]).count()


def test_a_later_run_wins_whatever_its_batch_ids(spark, topic, tmp_path, rows):
    topic.send(topic.payment(NOON, 1.0), topic.payment(NOON + timedelta(hours=1)))
    topic.send(topic.payment(NOON + timedelta(hours=2)))
    run(revenue(stream_files(spark, topic.path, max_files_per_trigger=1)), tmp_path)
    topic.send(topic.payment(NOON, 5.0), topic.payment(NOON + timedelta(hours=3)))
    query = start_job(revenue(stream_files(spark, topic.path)), batch_folder_sink(str(tmp_path / "out")), "again",
                      trigger=None, checkpoint=str(tmp_path / "second"))
    query.awaitTermination(120)
    stored = read_current(spark, str(tmp_path / "out"), ["window_start"])
    assert [(r[0], r[2]) for r in rows(stored)] == [(NOON, 6.0), (NOON + timedelta(hours=1), 10.0), (NOON + timedelta(hours=2), 10.0)]
    first, second = (run_token(spark, str(tmp_path / name)) for name in ("checkpoint", "second"))
    assert first < second and run_token(spark, str(tmp_path / "checkpoint")) == first


UPSERTED = "k string, v int, at int, day string"


def test_upsert_replaces_the_rows_of_its_keys(spark, tmp_path, rows):
    path = str(tmp_path / "table")

    def put(*values, **how):
        upsert(spark.createDataFrame(values, UPSERTED), path, ["k"], "day", **how)

    put(("a", 1, 1, "mon"), ("b", 1, 1, "mon"), (None, 1, 1, None), ("c", 1, 1, "tue"))
    untouched = Folder(spark, f"{path}/day=tue").names()
    put(("a", 2, 2, "mon"), ("a", 3, 2, "mon"), (None, 2, 2, None))
    want = sorted([("a", 2, 2, "mon"), ("a", 3, 2, "mon"), ("b", 1, 1, "mon"), (None, 2, 2, None), ("c", 1, 1, "tue")], key=repr)
    assert rows(read_table(spark, path)) == want
    assert Folder(spark, f"{path}/day=tue").names() == untouched
    put(("a", 2, 2, "mon"), ("a", 3, 2, "mon"), (None, 2, 2, None))
    assert rows(read_table(spark, path)) == want
    put(("a", 0, 1, "mon"), ("b", 9, 1, "mon"), ("d", 1, None, "wed"), newest_by="at")
    want = sorted([*(r for r in want if r[0] != "b"), ("b", 9, 1, "mon"), ("d", 1, None, "wed")], key=repr)
    assert rows(read_table(spark, path)) == want
    put(newest_by="at")
    assert rows(read_table(spark, path)) == want


def test_upsert_reads_only_the_partitions_it_touches(spark, tmp_path):
    path = str(tmp_path / "table")
    upsert(spark.range(100).selectExpr("id k", "id % 10 day"), path, ["k"], "day")
    names = {day: Folder(spark, f"{path}/day={day}").names() for day in range(10)}
    upsert(spark.range(1).selectExpr("id + 3 k", "id + 3 day"), path, ["k"], "day")
    changed = [day for day in range(10) if Folder(spark, f"{path}/day={day}").names() != names[day]]
    assert changed == [3] and read_table(spark, path).count() == 100


@pytest.mark.parametrize("complete", [True, False])
def test_upsert_finishes_what_a_dead_writer_began(spark, tmp_path, rows, complete):
    path = str(tmp_path / "table")
    upsert(spark.createDataFrame([("a", 1, 1, "mon"), ("b", 1, 1, "tue")], UPSERTED), path, ["k"], "day")
    staged = spark.createDataFrame([("a", 2, 2, "mon"), ("b", 2, 2, "tue")], UPSERTED)
    staged.write.partitionBy("day").parquet(f"{path}/_staged/x")
    if not complete:
        Folder(spark, f"{path}/_staged/x").remove("_SUCCESS")
    else:
        # It died after removing one partition, before moving the new one there.
        Folder(spark, path).remove("day=mon")
    upsert(spark.createDataFrame([("c", 1, 1, "wed")], UPSERTED), path, ["k"], "day")
    value = 2 if complete else 1
    assert rows(read_table(spark, path)) == [("a", value, value, "mon"), ("b", value, value, "tue"), ("c", 1, 1, "wed")]
    assert Folder(spark, f"{path}/_staged").names() == []


def test_alike_rows_merge_as_one(spark):
    adds = spark.createDataFrame([("u", "p", 1), ("u", "p", 1), ("v", "p", 1)], "user_id string, product_id string, at int")
    assert merge_source(adds.distinct(), ["user_id", "product_id", "at"]).count() == 2
