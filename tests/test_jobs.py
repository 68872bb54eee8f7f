"""Limits and ties of the five jobs."""

import json
from datetime import datetime, timedelta

import pytest

from tradewind.plans import jobs

NOON = datetime(2024, 3, 5, 12)
PAYMENT = "user_id string, amount double, event_timestamp timestamp"
ORDER = "user_id string, total_amount double, event_timestamp timestamp"


def alerts_at_noon(spark, orders=(), payments=(), **options):
    """Alerts of the window that starts at noon, for events all within its first minute."""
    paid = spark.createDataFrame([("u", float(a), NOON + timedelta(seconds=i)) for i, a in enumerate(payments)], PAYMENT)
    ordered = spark.createDataFrame([("u", float(a), NOON + timedelta(seconds=i)) for i, a in enumerate(orders)], ORDER)
    found = jobs.fraud_alerts(paid, ordered, **options)
    return [row for row in found.collect() if row.alert_timestamp == NOON]


@pytest.mark.parametrize(
    "orders, payments, expected",
    [
        ([1] * 3, [], None),
        ([1] * 4, [], ("UNUSUAL_ORDER_FREQUENCY", "HIGH")),
        ([1] * 5, [], ("UNUSUAL_ORDER_FREQUENCY", "HIGH")),
        ([1] * 6, [], ("UNUSUAL_ORDER_FREQUENCY", "CRITICAL")),
        ([1000], [], None),
        ([1000.01], [], ("HIGH_ORDER_VALUE", "HIGH")),
        ([], [1000.01], ("HIGH_ORDER_VALUE", "HIGH")),
        ([5000], [], ("HIGH_ORDER_VALUE", "HIGH")),
        ([5000.01], [], ("HIGH_ORDER_VALUE", "CRITICAL")),
        ([], [1] * 2, None),
        ([], [1] * 3, ("MULTIPLE_PAYMENT_EVENTS", "MEDIUM")),
        ([], [1] * 5, ("MULTIPLE_PAYMENT_EVENTS", "MEDIUM")),
        ([], [1] * 6, ("MULTIPLE_PAYMENT_EVENTS", "CRITICAL")),
        ([1] * 4, [6000], ("UNUSUAL_ORDER_FREQUENCY", "CRITICAL")),
    ],
)
def test_fraud_limits_are_exclusive(spark, orders, payments, expected):
    found = alerts_at_noon(spark, orders, payments)
    assert [(a.alert_type, a.severity) for a in found] == ([expected] if expected else [])


def test_fraud_details_leave_out_absent_payments(spark):
    (alert,) = alerts_at_noon(spark, orders=[1] * 4)
    assert alert.alert_id == f"u_{int((NOON - datetime(1970, 1, 1)).total_seconds())}"
    assert "failed_count" not in json.loads(alert.details)
    (alert,) = alerts_at_noon(spark, orders=[1] * 4, zero_fill=True)
    assert json.loads(alert.details)["failed_count"] == 0


def test_fraud_event_counts_in_five_windows(spark):
    paid = spark.createDataFrame([("u", 2000.0, NOON)], PAYMENT)
    found = jobs.fraud_alerts(paid, spark.createDataFrame([], ORDER))
    starts = sorted(row.alert_timestamp for row in found.collect())
    assert starts == [NOON - timedelta(minutes=m) for m in (4, 3, 2, 1, 0)]


def test_revenue_of_a_window(spark, rows):
    paid = spark.createDataFrame(
        [("a", 10.1, NOON), ("b", 20.2, NOON + timedelta(seconds=59.999)), ("c", 5.0, NOON + timedelta(minutes=1)), ("d", None, NOON)],
        PAYMENT,
    )
    minute = timedelta(minutes=1)
    assert rows(jobs.revenue_by_window(paid)) == [
        (NOON, NOON + minute, 30.3, 3, 15.15),
        (NOON + minute, NOON + 2 * minute, 5.0, 1, 5.0),
    ]


@pytest.mark.parametrize(
    "delay, abandoned",
    [
        (timedelta(0), False),
        (timedelta(minutes=30), False),
        (timedelta(minutes=30, microseconds=1), True),
        (timedelta(microseconds=-1), True),
    ],
)
@pytest.mark.parametrize("start", [NOON, NOON + timedelta(minutes=17, seconds=3), NOON - timedelta(microseconds=1)])
def test_checkout_within_thirty_minutes(spark, delay, abandoned, start):
    items = spark.createDataFrame([("u", "p", start)], "user_id string, product_id string, event_timestamp timestamp")
    done = spark.createDataFrame([("u", start + delay)], "user_id string, event_timestamp timestamp")
    assert jobs.cart_abandonment(items, done).count() == int(abandoned)


def test_each_added_item_is_judged_on_its_own(spark, rows):
    hour = timedelta(hours=1)
    items = spark.createDataFrame(
        [("u", "p", NOON), ("u", "p", NOON + hour), ("v", "q", NOON), (None, "r", NOON)],
        "user_id string, product_id string, event_timestamp timestamp",
    )
    done = spark.createDataFrame(
        [("u", NOON + hour), (None, NOON)], "user_id string, event_timestamp timestamp"
    )
    found = rows(jobs.cart_abandonment(items, done))
    assert found == sorted([("u", "p", NOON), ("v", "q", NOON), (None, "r", NOON)], key=repr)


def orders_with(spark, units):
    lines = [
        (f"o{i}", "FULFILLED", NOON, json.dumps([{"product_id": product, "quantity": quantity, "item_total": quantity * 2.5}]))
        for i, (product, quantity) in enumerate(units)
    ]
    return spark.createDataFrame(lines, "order_id string, status string, created_at timestamp, items string")


def test_rank_ties_keep_more_than_ten(spark):
    units = [(f"p{i:02}", 20 - i) for i in range(10)] + [("tied", 11), ("below", 10)]
    found = jobs.inventory_velocity(orders_with(spark, units)).collect()
    assert len(found) == 11
    assert sorted(r.velocity_rank for r in found)[-2:] == [10, 10]
    assert "below" not in {r.product_id for r in found}


def test_velocity_of_orders_with_several_items(spark, rows):
    items = json.dumps(
        [{"product_id": "a", "quantity": 2, "price": 5.0, "item_total": 10.0}, {"product_id": "b", "quantity": 1, "item_total": 3.0}]
    )
    frame = spark.createDataFrame(
        [("o1", "FULFILLED", NOON, items), ("o2", "FULFILLED", NOON + timedelta(minutes=59), items), ("o3", "PAID", NOON, items)],
        "order_id string, status string, created_at timestamp, items string",
    )
    later = NOON + timedelta(hours=1)
    assert rows(jobs.inventory_velocity(frame)) == [(NOON, later, "a", 4, 20.0, 1), (NOON, later, "b", 2, 6.0, 2)]


@pytest.mark.parametrize("events, status", [(8, "CRITICAL"), (9, "WARNING"), (15, "WARNING"), (16, "HEALTHY")])
def test_throughput_limits(spark, events, status):
    envelope = spark.createDataFrame(
        [("order.created", NOON + timedelta(seconds=i)) for i in range(events)] + [("dlq.events", NOON)],
        "topic string, timestamp timestamp",
    )
    (row,) = jobs.topic_throughput_health(envelope).collect()
    assert (row.metric_value, row.status, row.threshold) == (events, status, 20)
    assert json.loads(row.services_checked) == {"topic_monitored": "order.created", "events_processed": events}
