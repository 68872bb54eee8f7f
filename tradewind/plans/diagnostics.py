"""Diagnostic reports over the operational and the result tables.

Listings take ``n``, the number of newest rows to show. Where the time alone does not order the
rows, a key breaks the tie, so that the same rows are shown on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.money import money_avg, money_sum
from tradewind.functions.scalars import seconds_since, whole_hours_since
from tradewind.functions.timing import Instant
from tradewind.operators.joins import contained_in, lacking
from tradewind.operators.ranking import highest, newest, share_of_total
from tradewind.operators.reports import labelled_counts, stacked, total_and_breakdown


# ---- fixed values: status names, and labels of the (metric, count) reports --------------------
FULFILLED, SUCCESS, FAILED = "FULFILLED", "SUCCESS", "FAILED"
EVENTS_TOTAL, EVENTS_EACH = "Total processed events", "Events - "
ORDERS_TOTAL, ORDERS_EACH = "Total orders", "Orders - "
PAYMENTS_TOTAL, PAYMENTS_EACH = "Total payments", "Payments - "
FULFILLED_ORDERS = "FULFILLED orders"
SUCCESSFUL_PAYMENTS, ALL_PAYMENTS = "Successful payments", "All payments"
FULFILMENTS_PROCESSED = "order.fulfilled events processed"
PAYMENTS_PROCESSED = "payment.processed events processed"
ACTUAL_FULFILLED, ACTUAL_SUCCESS = "Actual FULFILLED orders", "Actual SUCCESS payments"
# ---------------------------------------------------------------------------------------------


def _counted(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("count"))


# ---- orders ---------------------------------------------------------------------------------


def recent_orders(orders: DataFrame, n: int = 20) -> DataFrame:
    shown = ["id", "user_id", "total_amount", "status", "created_at", "updated_at"]
    return newest(orders.select(shown), "created_at", n, ["id"])


def orders_by_status(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy("status")
        .agg(
            F.count("*").alias("count"),
            money_sum("total_amount").alias("total_revenue"),
            money_avg("total_amount").alias("avg_amount"),
        )
        .orderBy(F.col("count").desc(), "status")
    )


def orders_by_hour(orders: DataFrame, n: int = 24) -> DataFrame:
    """The newest ``n`` hours that have orders."""
    per_hour = orders.groupBy(F.date_trunc("hour", "created_at").alias("hour")).agg(
        F.count("*").alias("order_count"),
        money_sum("total_amount").alias("revenue"),
        money_avg("total_amount").alias("avg_order_value"),
    )
    return newest(per_hour, "hour", n)


def user_orders(orders: DataFrame, user_id) -> DataFrame:
    """One user's orders, newest first."""
    mine = orders.filter(F.col("user_id") == user_id)
    return newest(
        mine.select("order_id", "user_id", "status", "total_amount", "created_at"),
        "created_at",
        None,
        ["order_id"],
    )


def user_order_count(orders: DataFrame, user_id) -> DataFrame:
    return orders.filter(F.col("user_id") == user_id).agg(F.count("*").alias("count"))


def status_spans(orders: DataFrame) -> DataFrame:
    """For each order and status: how many rows, and the first and last change."""
    return orders.groupBy("order_id", "status").agg(
        F.count("*").alias("changes"),
        F.min("updated_at").alias("first_change"),
        F.max("updated_at").alias("last_change"),
    )


# ---- payments -------------------------------------------------------------------------------

_PAYMENT_LISTING = ["id", "order_id", "amount", "method", "status", "created_at"]


def recent_payments(payments: DataFrame, n: int = 20) -> DataFrame:
    return newest(payments.select(_PAYMENT_LISTING), "created_at", n, ["id"])


def failed_payments(payments: DataFrame, n: int = 20) -> DataFrame:
    return recent_payments(payments.filter(F.col("status") == FAILED), n)


def payment_distribution(payments: DataFrame) -> DataFrame:
    per_status = payments.groupBy("status").agg(
        F.count("*").alias("count"), money_sum("amount").alias("total_amount")
    )
    return share_of_total(per_status, "count", "percentage").orderBy(F.col("count").desc(), "status")


def duplicate_payments(payments: DataFrame) -> DataFrame:
    """Orders with more than one payment."""
    return _counted(payments, "order_id").filter(F.col("count") > 1)


# ---- result tables --------------------------------------------------------------------------


def revenue_trend(revenue: DataFrame, n: int | None = 10) -> DataFrame:
    """Revenue windows, newest first; ``n=None`` gives the whole trend."""
    shown = ["window_start", "window_end", "order_count", "total_revenue", "avg_order_value"]
    return newest(revenue.select(shown), "window_start", n)


def recent_alerts(alerts: DataFrame, severity: str | None = None, n: int = 20) -> DataFrame:
    wanted = alerts if severity is None else alerts.filter(F.col("severity") == severity)
    return newest(wanted, "alert_timestamp", n, ["alert_id"])


def alert_type_severity(alerts: DataFrame) -> DataFrame:
    """Alerts per type, and the share of them that is of severity HIGH."""
    is_high = F.when(F.col("severity") == "HIGH", 1).otherwise(0)
    return (
        alerts.groupBy("alert_type")
        .agg(F.count("*").alias("count"), F.avg(is_high).alias("high_severity_ratio"))
        .orderBy(F.col("count").desc(), "alert_type")
    )


def abandoned_with_product(
    abandoned: DataFrame, products: DataFrame, as_of: Instant, n: int = 20
) -> DataFrame:
    """The newest abandoned items with name, price and age in hours."""
    shown = products.select("product_id", F.col("name").alias("product_name"), "price")
    joined = abandoned.select("user_id", "product_id", "item_added_time").join(shown, "product_id")
    aged = joined.withColumn("hours_since_added", whole_hours_since("item_added_time", as_of))
    return newest(aged, "item_added_time", n, ["user_id", "product_id"])


def most_abandoned_products(abandoned: DataFrame, products: DataFrame, n: int = 20) -> DataFrame:
    """Products by how often they were abandoned.

    A product id is unique among the products, so the items are counted before the join and a
    product with very many of them crosses the join as one row.
    """
    counted = abandoned.groupBy("product_id").agg(
        F.count("*").alias("times_abandoned"),
        F.count_distinct("user_id").alias("unique_users"),
    )
    shown = products.select(
        "product_id",
        F.col("name").alias("product_name"),
        F.col("price").alias("avg_product_price"),
    )
    return highest(counted.join(shown, "product_id"), "times_abandoned", n, ["product_id"])


def most_abandoning_users(abandoned: DataFrame, n: int = 20) -> DataFrame:
    per_user = abandoned.groupBy("user_id").agg(
        F.count("*").alias("total_abandoned_items"),
        F.count_distinct("product_id").alias("unique_products"),
        F.max("item_added_time").alias("last_abandoned"),
    )
    return highest(per_user, "total_abandoned_items", n, ["user_id"])


def recent_velocity(velocity: DataFrame, n: int = 20) -> DataFrame:
    shown = ["product_id", "window_start", "window_end", "units_sold", "revenue", "velocity_rank"]
    return newest(velocity.select(shown), "window_end", n, ["velocity_rank", "product_id"])


def top_sellers(velocity: DataFrame, n: int = 20) -> DataFrame:
    per_product = velocity.groupBy("product_id").agg(
        F.sum("units_sold").alias("total_units"),
        F.count("*").alias("time_windows"),
        F.avg("units_sold").alias("avg_units_per_window"),
    )
    return highest(per_product, "total_units", n, ["product_id"])


def recent_ops(ops: DataFrame, n: int = 20) -> DataFrame:
    shown = ["topic", "metric_name", "metric_value", "status", "window_start"]
    return newest(ops.select(shown), "window_start", n, ["topic", "metric_name"])


def ops_stats(ops: DataFrame) -> DataFrame:
    return (
        ops.groupBy("status", "metric_name")
        .agg(
            F.avg("metric_value").alias("avg_value"),
            F.max("metric_value").alias("max_value"),
            F.min("metric_value").alias("min_value"),
            F.count("*").alias("measurements"),
        )
        .orderBy("status", "metric_name")
    )


def ops_hourly(ops: DataFrame, n: int = 24) -> DataFrame:
    per_hour = ops.groupBy(
        F.date_trunc("hour", "window_start").alias("hour"), "metric_name"
    ).agg(F.avg("metric_value").alias("avg_value"), F.max("metric_value").alias("max_value"))
    return newest(per_hour, "hour", n, ["metric_name"])


# The column that tells how recent each result table is.
FRESHNESS_COLUMNS = {
    "revenue_metrics": "window_end",
    "fraud_alerts": "alert_timestamp",
    "cart_abandonment": "detected_at",
    "inventory_velocity": "window_end",
    "operational_metrics": "window_start",
}


def freshness(tables: dict[str, DataFrame], as_of: Instant) -> DataFrame:
    """Newest time and its age in seconds for each table, stalest first."""
    newest_times = [
        tables[name].agg(F.max(column).alias("last_update")).select(
            F.lit(name).alias("table_name"), "last_update"
        )
        for name, column in FRESHNESS_COLUMNS.items()
        if name in tables
    ]
    return (
        stacked(newest_times)
        .withColumn("age_seconds", seconds_since("last_update", as_of))
        .orderBy(F.col("age_seconds").desc_nulls_first(), "table_name")
    )


# ---- products and stock ---------------------------------------------------------------------


def product_list(products: DataFrame) -> DataFrame:
    shown = products.select("id", "name", "price", "stock", "created_at")
    return newest(shown, "created_at", None, ["id"])


def low_stock(products: DataFrame, below: int = 10) -> DataFrame:
    return (
        products.filter(F.col("stock") < below)
        .select("id", "name", "price", "stock")
        .orderBy("stock", "id")
    )


def recent_reservations(reservations: DataFrame, n: int = 20) -> DataFrame:
    shown = ["id", "order_id", "product_id", "quantity", "created_at"]
    return newest(reservations.select(shown), "created_at", n, ["id"])


def reservation_stats(reservations: DataFrame) -> DataFrame:
    return (
        reservations.groupBy("product_id")
        .agg(
            F.count("*").alias("total_reservations"),
            F.sum("quantity").alias("total_reserved"),
            F.avg("quantity").alias("avg_reserved"),
        )
        .orderBy(F.col("total_reserved").desc(), "product_id")
    )


def pending_reservations(reservations: DataFrame) -> DataFrame:
    return (
        reservations.groupBy("product_id")
        .agg(F.count("*").alias("count"), F.sum("quantity").alias("total_quantity"))
        .orderBy(F.col("count").desc(), "product_id")
    )


# ---- processed events and outbox ------------------------------------------------------------


def processed_by_type(processed: DataFrame) -> DataFrame:
    return _counted(processed, "event_type").orderBy(F.col("count").desc(), "event_type")


def event_report(processed: DataFrame) -> DataFrame:
    return total_and_breakdown(processed, "event_type", EVENTS_TOTAL, EVENTS_EACH)


def recent_processed(processed: DataFrame, n: int = 20) -> DataFrame:
    shown = ["id", "event_id", "event_type", "processed_at"]
    return newest(processed.select(shown), "processed_at", n, ["id"])


def pending_outbox(outbox: DataFrame) -> DataFrame:
    return outbox.filter(F.col("published") == "N").agg(F.count("*").alias("pending_events"))


def duplicate_events(processed: DataFrame, by_type: bool = False) -> DataFrame:
    """Event ids recorded more than once.

    One id passes through several event types of an order, which is no fault; ``by_type``
    counts per (event_type, event_id) instead.
    """
    keys = ["event_type", "event_id"] if by_type else ["event_id"]
    return _counted(processed, *keys).filter(F.col("count") > 1)


# ---- consistency between tables -------------------------------------------------------------


def status_report(orders: DataFrame, payments: DataFrame) -> DataFrame:
    return stacked(
        [
            total_and_breakdown(orders, "status", ORDERS_TOTAL, ORDERS_EACH),
            total_and_breakdown(payments, "status", PAYMENTS_TOTAL, PAYMENTS_EACH),
        ]
    )


def fulfilled_vs_paid(orders: DataFrame, payments: DataFrame) -> DataFrame:
    paid = {SUCCESSFUL_PAYMENTS: F.col("status") == SUCCESS, ALL_PAYMENTS: F.lit(True)}
    fulfilled = {FULFILLED_ORDERS: F.col("status") == FULFILLED}
    return stacked([labelled_counts(orders, **fulfilled), labelled_counts(payments, **paid)])


def fulfilled_without_payment(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Fulfilled orders nobody paid for, newest first."""
    fulfilled = orders.filter(F.col("status") == FULFILLED)
    unpaid = lacking(fulfilled, payments, ["order_id"])
    return unpaid.select(
        "order_id", "user_id", "total_amount", "created_at", F.lit(None).cast("string").alias("payment_id")
    ).orderBy(F.col("created_at").desc(), "order_id")


def paid_without_fulfilment(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Successful payments whose order is missing or not fulfilled, newest first."""
    known = orders.select("order_id", F.col("status").alias("order_status"), F.lit(True).alias("known"))
    joined = payments.filter(F.col("status") == SUCCESS).join(known, "order_id", "left")
    unfulfilled = F.col("known").isNull() | (F.col("order_status") != FULFILLED)
    return (
        joined.filter(unfulfilled)
        .select("payment_id", "order_id", "status", "created_at", "order_status")
        .orderBy(F.col("created_at").desc(), "payment_id")
    )


def fulfilment_event_report(
    processed: DataFrame, orders: DataFrame, payments: DataFrame
) -> DataFrame:
    events = {
        FULFILMENTS_PROCESSED: F.col("event_type") == "order.fulfilled",
        PAYMENTS_PROCESSED: F.col("event_type") == "payment.processed",
    }
    return stacked(
        [
            labelled_counts(processed, **events),
            labelled_counts(orders, **{ACTUAL_FULFILLED: F.col("status") == FULFILLED}),
            labelled_counts(payments, **{ACTUAL_SUCCESS: F.col("status") == SUCCESS}),
        ]
    )


def events_matching_orders(
    processed: DataFrame, orders: DataFrame, event_type: str = "order.fulfilled"
) -> DataFrame:
    """Distinct events of a type, and how many of their ids occur inside an order id."""
    wanted = processed.filter(F.col("event_type") == event_type).select("event_id")
    all_ids = wanted.distinct().select(F.col("event_id"), F.lit(False).alias("matched"))
    matched = contained_in(wanted, "event_id", orders, "order_id").withColumn("matched", F.lit(True))
    return all_ids.unionByName(matched).agg(
        F.count_if(~F.col("matched") & F.col("event_id").isNotNull()).alias("total_fulfilled_events"),
        F.count_if(F.col("matched")).alias("events_with_matching_orders"),
    )
