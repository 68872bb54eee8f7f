"""The five analytics jobs. Each takes typed events and serves both batch and streaming.

In a batch a watermark has no effect. In a stream, a window is emitted once the watermark has
passed its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.money import money_avg, money_sum
from tradewind.functions.scalars import epoch_key, json_of, parse_json
from tradewind.functions.timing import interval
from tradewind.operators.joins import unmatched_within
from tradewind.operators.ranking import dense_top
from tradewind.schemas import ITEM_ARRAY, JOURNEY_TOPICS

EVENT_TIME = "event_timestamp"

# ---- fixed values: names the result tables hold ---------------------------------------------
MANY_ORDERS, HIGH_AMOUNT = "UNUSUAL_ORDER_FREQUENCY", "HIGH_ORDER_VALUE"
MANY_PAYMENTS = "MULTIPLE_PAYMENT_EVENTS"
CRITICAL, HIGH, MEDIUM = "CRITICAL", "HIGH", "MEDIUM"
HEALTHY, WARNING = "HEALTHY", "WARNING"
THROUGHPUT = "throughput"
# ---------------------------------------------------------------------------------------------


def revenue_by_window(
    payments: DataFrame, window: str = "1 minute", watermark: str = "10 seconds"
) -> DataFrame:
    """Revenue, payment count and mean payment of each tumbling window that has payments."""
    span = F.window(EVENT_TIME, window).alias("span")
    per_window = (
        payments.withWatermark(EVENT_TIME, watermark)
        .groupBy(span)
        .agg(
            money_sum("amount").alias("total_revenue"),
            F.count("*").alias("order_count"),
            money_avg("amount").alias("avg_order_value"),
        )
    )
    bounds = [F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end")]
    return per_window.select(*bounds, "total_revenue", "order_count", "avg_order_value")


def fraud_alerts(
    payments: DataFrame,
    orders: DataFrame,
    window: str = "5 minutes",
    slide: str = "1 minute",
    watermark: str = "10 seconds",
    max_orders: int = 3,
    max_amount: float = 1000,
    max_payments: int = 2,
    critical_orders: int = 5,
    critical_amount: float = 5000,
    critical_payments: int = 5,
    zero_fill: bool = False,
) -> DataFrame:
    """Users who order or pay suspiciously often, or suspiciously much, in a sliding window.

    All limits are exclusive. The largest amount is taken over orders and payments alike. In a
    window without payments the payment count is null, not zero, and is then missing from the
    details; ``zero_fill`` makes it zero.
    """
    activity = payments.select(
        "user_id", "amount", EVENT_TIME, F.lit(True).alias("is_payment")
    ).unionByName(
        orders.select(
            "user_id",
            F.col("total_amount").alias("amount"),
            EVENT_TIME,
            F.lit(False).alias("is_payment"),
        )
    )
    payment_count = F.sum(F.when(F.col("is_payment"), 1))
    if zero_fill:
        payment_count = F.coalesce(payment_count, F.lit(0))
    per_user = (
        activity.withWatermark(EVENT_TIME, watermark)
        .groupBy("user_id", F.window(EVENT_TIME, window, slide).alias("span"))
        .agg(
            F.count_if(~F.col("is_payment")).alias("orders"),
            F.max("amount").alias("largest"),
            payment_count.alias("payments"),
        )
    )

    orders_seen, largest, payments_seen = F.col("orders"), F.col("largest"), F.col("payments")
    too_many_orders = orders_seen > max_orders
    too_much = largest > max_amount
    too_many_payments = payments_seen > max_payments
    critical = (
        (orders_seen > critical_orders)
        | (largest > critical_amount)
        | (payments_seen > critical_payments)
    )
    # The first rule that holds names the alert.
    alert_type = (
        F.when(too_many_orders, MANY_ORDERS)
        .when(too_much, HIGH_AMOUNT)
        .when(too_many_payments, MANY_PAYMENTS)
    )
    severity = (
        F.when(critical, CRITICAL).when(too_many_orders | too_much, HIGH).otherwise(MEDIUM)
    )
    details = json_of(
        order_frequency=orders_seen,
        max_amount=largest,
        failed_count=payments_seen,
        window_start=F.col("span.start"),
        window_end=F.col("span.end"),
    )
    return per_user.filter(too_many_orders | too_much | too_many_payments).select(
        epoch_key("user_id", "span.start").alias("alert_id"),
        F.col("span.start").alias("alert_timestamp"),
        "user_id",
        F.lit(None).cast("string").alias("order_id"),
        alert_type.alias("alert_type"),
        severity.alias("severity"),
        details.alias("details"),
    )


def cart_abandonment(
    items: DataFrame,
    checkouts: DataFrame,
    within: str = "30 minutes",
    watermark: str = "30 minutes",
) -> DataFrame:
    """Items added to a cart without a checkout by the same user in the time ``within``.

    One row per added item. A checkout at the very end of the time still counts. A stream can
    only tell once the slower of both streams is ``within`` + ``watermark`` past the item.
    """
    added = items.select(
        "user_id", "product_id", F.col(EVENT_TIME).alias("item_added_time")
    )
    done = checkouts.select("user_id", F.col(EVENT_TIME).alias("checkout_time"))
    if not items.isStreaming:
        return unmatched_within(added, done, "user_id", "item_added_time", "checkout_time", within)

    buyers = done.withColumnRenamed("user_id", "buyer").withWatermark("checkout_time", watermark)
    in_time = F.col("checkout_time").between(
        F.col("item_added_time"), F.col("item_added_time") + interval(within)
    )
    return (
        added.withWatermark("item_added_time", watermark)
        .join(buyers, (F.col("user_id") == F.col("buyer")) & in_time, "leftOuter")
        .filter(F.col("buyer").isNull())
        .select(*added.columns)
    )


def inventory_velocity(
    orders: DataFrame, unit: str = "hour", status: str = "FULFILLED", top: int = 10
) -> DataFrame:
    """The best-selling products of each calendar unit, from the items of fulfilled orders.

    Orders hold their items as JSON text. Units are ranked densely: products with equal units
    share a rank, and all products up to rank ``top`` are returned.
    """
    sold = (
        orders.filter(F.col("status") == status)
        .select(
            F.date_trunc(unit, "created_at").alias("window_start"),
            F.explode(parse_json("items", ITEM_ARRAY)).alias("item"),
        )
        .groupBy("window_start", F.col("item.product_id").alias("product_id"))
        .agg(
            F.sum("item.quantity").alias("units_sold"),
            money_sum("item.item_total").alias("revenue"),
        )
    )
    window_end = F.col("window_start") + F.expr(f"INTERVAL 1 {unit}")
    ranked = dense_top(sold, ["window_start"], "units_sold", top, "velocity_rank")
    return ranked.select(
        "window_start",
        window_end.alias("window_end"),
        "product_id",
        "units_sold",
        "revenue",
        "velocity_rank",
    )


def topic_throughput_health(
    envelope: DataFrame,
    window: str = "1 minute",
    watermark: str = "10 seconds",
    threshold: int = 20,
    healthy_above: int = 15,
    warning_above: int = 8,
    topics: tuple[str, ...] | None = JOURNEY_TOPICS,
) -> DataFrame:
    """Records per topic and window, by the broker's time, and whether that is enough.

    A topic that is silent for a whole window has no row for it.
    """
    wanted = envelope if topics is None else envelope.filter(F.col("topic").isin(list(topics)))
    counted = (
        wanted.withWatermark("timestamp", watermark)
        .groupBy("topic", F.window("timestamp", window).alias("span"))
        .agg(F.count("*").alias("events"))
    )
    status = (
        F.when(F.col("events") > healthy_above, HEALTHY)
        .when(F.col("events") > warning_above, WARNING)
        .otherwise(CRITICAL)
    )
    return counted.select(
        F.col("span.start").alias("window_start"),
        F.col("span.end").alias("window_end"),
        "topic",
        F.lit(THROUGHPUT).alias("metric_name"),
        F.col("events").alias("metric_value"),
        F.lit(threshold).alias("threshold"),
        status.alias("status"),
        json_of(topic_monitored=F.col("topic"), events_processed=F.col("events")).alias(
            "services_checked"
        ),
    )
