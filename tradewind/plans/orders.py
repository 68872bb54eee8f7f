"""The order log: status, lifecycle, durations, outbox and the stock of cancelled orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.scalars import derived_id, iso_text, tracking_number
from tradewind.functions.timing import Instant, instant, interval, seconds_between
from tradewind.operators.joins import having
from tradewind.operators.ranking import first_per_key

# ---- fixed values ---------------------------------------------------------------------------
# Status an event moves its order to, and how far along the order then is.
STATUS_OF_EVENT = {
    "order.created": "PENDING",
    "inventory.reserved": "RESERVATION_CONFIRMED",
    "order.reservation_confirmed": "RESERVATION_CONFIRMED",
    "payment.processed": "PAID",
    "order.confirmed": "PAID",
    "order.fulfilled": "FULFILLED",
    "inventory.depleted": "CANCELLED",
    "payment.failed": "CANCELLED",
    "order.cancelled": "CANCELLED",
}
STEP_OF_STATUS = {
    "PENDING": 0,
    "RESERVATION_CONFIRMED": 1,
    "PAID": 2,
    "FULFILLED": 3,
    "CANCELLED": 3,
}
FINAL_STEP = 3
# Saga step and outcome an event reports. A failed step is compensated by a cancellation.
OUTCOME_OF_EVENT = {
    "inventory.reserved": ("inventory", "success"),
    "inventory.depleted": ("inventory", "failed"),
    "payment.processed": ("payment", "success"),
    "payment.failed": ("payment", "failed"),
}
PAYMENT_FAILED, INVENTORY_DEPLETED = "payment_failed", "inventory_depleted"
# ---------------------------------------------------------------------------------------------


def _lookup(column: Column, table: dict) -> Column:
    pairs = [F.lit(part) for pair in table.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), column)


def status_of(event_type: Column) -> Column:
    return _lookup(event_type, STATUS_OF_EVENT)


def step_of(status: Column) -> Column:
    return _lookup(status, STEP_OF_STATUS)


def order_status(events: DataFrame) -> DataFrame:
    """Current status of each order and when it got there.

    The furthest step wins, then the later event, so events may arrive in any order and more
    than once. Per order only the last time of each status is kept, in plain columns, so the
    aggregate is a hash aggregate. It runs in a batch and as a stream in update mode.
    """
    status = status_of(F.col("event_type"))
    last_times = [
        F.max(F.when(F.col("status") == name, F.col("event_timestamp"))).alias(name)
        for name in STEP_OF_STATUS
    ]
    per_order = (
        events.select("order_id", "event_timestamp", status.alias("status"))
        .filter("status is not null")
        .groupBy("order_id")
        .agg(*last_times)
    )
    # Both final statuses together count as one step, at the later of their times.
    ended = F.greatest("FULFILLED", "CANCELLED")
    chosen = (
        F.when(F.col("FULFILLED") == ended, "FULFILLED")
        .when(F.col("CANCELLED") == ended, "CANCELLED")
        .when(F.col("PAID").isNotNull(), "PAID")
        .when(F.col("RESERVATION_CONFIRMED").isNotNull(), "RESERVATION_CONFIRMED")
        .otherwise("PENDING")
    )
    reached_at = F.coalesce(ended, "PAID", "RESERVATION_CONFIRMED", "PENDING")
    return per_order.select("order_id", chosen.alias("status"), reached_at.alias("updated_at"))


def lifecycle_violations(
    events: DataFrame,
    expected: tuple[str, ...] = tuple(STEP_OF_STATUS),
    ties: tuple[str, ...] = ("event_id",),
) -> DataFrame:
    """Events that took an order to an unexpected status, backwards, or out of a final one."""
    history = events.select(
        "order_id",
        "event_timestamp",
        *ties,
        status_of(F.col("event_type")).alias("status"),
    ).filter("status is not null")
    # An order has a handful of events, so a window over the order is enough.
    in_order = Window.partitionBy("order_id").orderBy("event_timestamp", *ties)
    compared = history.withColumn("prev_status", F.lag("status").over(in_order))
    step, before = step_of(F.col("status")), step_of(F.col("prev_status"))
    left_final = (before == FINAL_STEP) & (F.col("status") != F.col("prev_status"))
    violation = F.when(~F.col("status").isin(list(expected)), "UNEXPECTED").when(
        (step < before) | left_final, "REGRESSION"
    )
    return (
        compared.withColumn("violation", violation)
        .filter("violation is not null")
        .select("order_id", "event_timestamp", "prev_status", "status", "violation")
    )


def order_durations(events: DataFrame) -> DataFrame:
    """Seconds from an order's creation to its first payment, for orders that have both."""

    def first_time(event_type: str) -> Column:
        return F.min(F.when(F.col("event_type") == event_type, F.col("event_timestamp")))

    return (
        events.filter(F.col("event_type").isin("order.created", "payment.processed"))
        .groupBy("order_id")
        .agg(
            first_time("order.created").alias("created_at"),
            first_time("payment.processed").alias("paid_at"),
        )
        .filter("created_at is not null and paid_at is not null")
        .withColumn("duration_seconds", seconds_between("created_at", "paid_at"))
    )


def saga_outcomes(events: DataFrame) -> DataFrame:
    """How often each saga step succeeded or failed, and how many compensations followed."""
    steps = {event: step for event, (step, _) in OUTCOME_OF_EVENT.items()}
    outcomes = {event: outcome for event, (_, outcome) in OUTCOME_OF_EVENT.items()}
    kind = F.col("event_type")
    return (
        events.filter(kind.isin(list(OUTCOME_OF_EVENT)))
        .groupBy(_lookup(kind, steps).alias("step"), _lookup(kind, outcomes).alias("status"))
        .agg(F.count("*").alias("count"))
        .withColumn("compensations", F.when(F.col("status") == "failed", F.col("count")).otherwise(0))
    )


def first_payment(payments: DataFrame, ties: tuple[str, ...] = ("payment_id",)) -> DataFrame:
    """One payment per order: the first one counts, repeats are dropped."""
    return first_per_key(payments, ["order_id"], ["created_at", *ties])


def _reserved_by_cancelled(cancelled: DataFrame, reservations: DataFrame, source: str) -> DataFrame:
    # A semi join, so that an order cancelled twice does not count its stock twice.
    chosen = cancelled.filter(F.col("cancellation_source") == source)
    return having(reservations, chosen, ["order_id"])


def stock_to_release(cancelled: DataFrame, reservations: DataFrame) -> DataFrame:
    """Units per product to put back because the payment of their order failed."""
    held = _reserved_by_cancelled(cancelled, reservations, PAYMENT_FAILED)
    return held.groupBy("product_id").agg(F.sum("quantity").alias("quantity"))


def leaked_reservations(cancelled: DataFrame, reservations: DataFrame) -> DataFrame:
    """Reservations nobody will release.

    An order with several items keeps what it reserved before the item that was out of stock,
    and its cancellation releases nothing.
    """
    held = _reserved_by_cancelled(cancelled, reservations, INVENTORY_DEPLETED)
    return held.groupBy("order_id", "product_id").agg(F.sum("quantity").alias("quantity"))


def publish_outbox(outbox: DataFrame, as_of: Instant) -> tuple[DataFrame, DataFrame]:
    """Records to publish for the pending outbox rows, and those rows marked as published."""
    pending = outbox.filter(F.col("published") == "N")
    records = pending.select(
        F.col("event_type").alias("topic"),
        F.col("order_id").alias("key"),
        F.col("event_data").alias("value"),
    )
    marked = pending.withColumn("published", F.lit("Y")).withColumn("published_at", instant(as_of))
    return records, marked


def fulfilment_candidates(
    orders: DataFrame, as_of: Instant, delay: str = "5 seconds", n: int = 10
) -> DataFrame:
    """Fulfilment events for the ``n`` orders that have been paid longest, at least ``delay`` ago.

    An event carries the correlation id of its order; an order without one gets an id derived from its own.
    """
    ripe = (F.col("status") == "PAID") & (F.col("updated_at") <= instant(as_of) - interval(delay))
    chosen = orders.filter(ripe).orderBy("updated_at", "order_id").limit(n)
    return chosen.select(
        derived_id("EVT-", F.lit("order.fulfilled"), "order_id").alias("event_id"),
        F.lit("order.fulfilled").alias("event_type"),
        F.coalesce("correlation_id", derived_id("COR-", "order_id")).alias("correlation_id"),
        iso_text(instant(as_of)).alias("timestamp"),
        "order_id",
        "user_id",
        tracking_number("order_id").alias("tracking_number"),
        iso_text(instant(as_of)).alias("shipped_at"),
    )
