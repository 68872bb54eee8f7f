"""Order log, stock and hot-key operators on small logs with known answers."""

import random
from datetime import datetime, timedelta

import pytest

from tradewind.operators.slices import previous_row, running_sum
from tradewind.plans import orders, stock

START = datetime(2024, 1, 1)
EVENT = "event_id string, event_type string, order_id string, event_timestamp timestamp"


def log_of(spark, *events):
    """Events of one order, a second apart."""
    return spark.createDataFrame(
        [(str(i), kind, "o", START + timedelta(seconds=i)) for i, kind in enumerate(events)], EVENT
    )


HAPPY = ("order.created", "inventory.reserved", "payment.processed", "order.fulfilled")


@pytest.mark.parametrize(
    "events, status",
    [
        (HAPPY[:1], "PENDING"),
        (HAPPY[:2], "RESERVATION_CONFIRMED"),
        (HAPPY[:3], "PAID"),
        (HAPPY, "FULFILLED"),
        (tuple(reversed(HAPPY)), "FULFILLED"),
        (HAPPY + ("payment.processed",), "FULFILLED"),
        (("order.created", "inventory.depleted"), "CANCELLED"),
        (("order.created", "inventory.reserved", "payment.failed"), "CANCELLED"),
    ],
)
def test_status_does_not_depend_on_arrival(spark, events, status):
    (row,) = orders.order_status(log_of(spark, *events)).collect()
    assert row.status == status


def test_clean_lifecycles_have_no_violation(spark):
    assert orders.lifecycle_violations(log_of(spark, *HAPPY)).count() == 0
    cancelled = log_of(spark, "order.created", "inventory.reserved", "payment.failed", "order.cancelled")
    assert orders.lifecycle_violations(cancelled).count() == 0


def test_backward_and_unexpected_statuses_are_found(spark):
    backward = orders.lifecycle_violations(log_of(spark, *HAPPY[:3], "inventory.reserved")).collect()
    assert [(r.prev_status, r.status, r.violation) for r in backward] == [
        ("PAID", "RESERVATION_CONFIRMED", "REGRESSION")
    ]
    revived = orders.lifecycle_violations(log_of(spark, "order.created", "order.cancelled", "order.fulfilled"))
    assert [r.violation for r in revived.collect()] == ["REGRESSION"]
    strict = orders.lifecycle_violations(
        log_of(spark, "order.created", "order.cancelled"), expected=("PENDING", "PAID")
    )
    assert [r.violation for r in strict.collect()] == ["UNEXPECTED"]


def test_partial_reservation_of_a_depleted_order_leaks(spark, rows):
    cancelled = spark.createDataFrame(
        [("a", "inventory_depleted"), ("a", "inventory_depleted"), ("b", "payment_failed")],
        "order_id string, cancellation_source string",
    )
    held = spark.createDataFrame(
        [("a", "p1", 2), ("a", "p2", 1), ("b", "p1", 5), ("c", "p1", 7)],
        "order_id string, product_id string, quantity int",
    )
    assert rows(orders.leaked_reservations(cancelled, held)) == [("a", "p1", 2), ("a", "p2", 1)]
    assert rows(orders.stock_to_release(cancelled, held)) == [("p1", 5)]


def test_first_payment_wins(spark):
    payments = spark.createDataFrame(
        [("o", "second", START + timedelta(seconds=1)), ("o", "first", START)],
        "order_id string, payment_id string, created_at timestamp",
    )
    assert [r.payment_id for r in orders.first_payment(payments).collect()] == ["first"]


REQUEST = "product_id string, order_id string, event_timestamp timestamp, quantity int"
PRODUCT = "product_id string, stock int"


def walk(stocks, requests):
    left, granted = dict(stocks), {}
    for product, order, at, quantity in sorted(requests, key=lambda r: (r[2], r[1])):
        granted[order] = 0 < quantity <= left.get(product, 0)
        if granted[order]:
            left[product] -= quantity
    return granted


@pytest.mark.parametrize("hot_above", [0, 60, 10_000])
@pytest.mark.parametrize("seed", range(3))
def test_greedy_reservation_matches_a_plain_walk(spark, seed, hot_above):
    rng = random.Random(seed)
    stocks = [(f"p{i}", rng.choice([0, 1, 7, 8, 100, 1000])) for i in range(8)]
    requests = []
    for i in range(500):
        # The first product takes a third of all requests; one product is unknown.
        product = "p0" if rng.random() < 0.33 else f"p{rng.randrange(9)}"
        quantity = rng.choice([0, 1, 1, 2, 3, 5, 8, 30, 127, 128, 900])
        requests.append((product, f"o{i:04}", START + timedelta(minutes=rng.randrange(90)), quantity))
    stocks[0] = ("p0", 255)
    found = stock.reserve_greedy(
        spark.createDataFrame(stocks, PRODUCT),
        spark.createDataFrame(requests, REQUEST),
        width="10 minutes",
        hot_above=hot_above,
    )
    assert found.columns == ["product_id", "order_id", "event_timestamp", "quantity", "accepted"]
    assert {r.order_id: r.accepted for r in found.collect()} == walk(stocks, requests)


def test_two_orders_for_the_whole_stock(spark):
    requests = [("p", "a", START, 10), ("p", "b", START, 10)]
    for hot_above in (0, 100):
        found = stock.reserve_greedy(
            spark.createDataFrame([("p", 10)], PRODUCT),
            spark.createDataFrame(requests, REQUEST),
            hot_above=hot_above,
        )
        assert sorted((r.order_id, r.accepted) for r in found.collect()) == [("a", True), ("b", False)]


def test_fractional_quantities_are_refused(spark):
    requests = spark.createDataFrame([("p", "a", START, 0.5)], REQUEST.replace("int", "double"))
    with pytest.raises(TypeError):
        stock.reserve_greedy(spark.createDataFrame([("p", 2)], PRODUCT), requests)


def test_more_than_the_stock_is_not_granted(spark):
    found = stock.reserve_greedy(
        spark.createDataFrame([("p", 100)], PRODUCT),
        spark.createDataFrame([("p", "a", START, 120), ("p", "b", START + timedelta(1), 30)], REQUEST),
    )
    assert sorted((r.order_id, r.accepted) for r in found.collect()) == [("a", False), ("b", True)]


def ledger_log(seed, size=400):
    rng = random.Random(seed)
    rows = []
    for i in range(size):
        key = "hot" if rng.random() < 0.34 else rng.choice("abc")
        rows.append((key, i, START + timedelta(minutes=rng.randrange(600)), rng.randrange(-5, 6)))
    return rows


@pytest.mark.parametrize("width", ["10 minutes", "1 hour", "30 days"])
def test_running_sum_and_previous_row(spark, width):
    log = ledger_log(len(width)) + [(key, -i, None, 3 * i) for key in ("hot", "a", "b") for i in (1, 2)]
    frame = spark.createDataFrame(log, "k string, id int, ts timestamp, v long")
    opening = spark.createDataFrame([("hot", 100), ("a", 10)], "k string, v long")
    balance, before, expected = {"hot": 100, "a": 10}, {}, []
    for key, i, ts, value in sorted(log, key=lambda r: (r[0], r[2] or datetime.min, r[1])):
        balance[key] = balance.get(key, 0) + value
        expected.append((key, i, balance[key], before.get(key)))
        before[key] = value

    summed = running_sum(frame, ["k"], "ts", "v", "total", ["id"], opening, width)
    assert sorted((r.k, r.id, r.total) for r in summed.collect()) == sorted(e[:3] for e in expected)
    lagged = previous_row(frame, ["k"], "ts", ["v"], ["id"], width=width)
    got = sorted((r.k, r.id, r.prev_v) for r in lagged.collect())
    assert got == sorted((k, i, prev) for k, i, _, prev in expected)


def test_low_stock_alert_after_a_reservation(spark):
    products = spark.createDataFrame([("p", 20)], PRODUCT)
    moves = spark.createDataFrame(
        [("p", "1", "reserved", 10, START), ("p", "2", "reserved", 1, START + timedelta(1)), ("p", "3", "refilled", 50, START + timedelta(2))],
        "product_id string, move_id string, kind string, quantity int, event_timestamp timestamp",
    )
    ledger = stock.stock_ledger(products, moves)
    assert sorted((r.move_id, r.balance) for r in ledger.collect()) == [("1", 10), ("2", 9), ("3", 59)]
    assert [(r.product_id, r.current_stock) for r in stock.low_stock_alerts(ledger).collect()] == [("p", 9)]
