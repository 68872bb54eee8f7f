"""The diagnostic reports."""

from checks.inputs import AS_OF, Inputs
from checks.registry import query
from checks.relations import money
from pyspark.sql import functions as F
from tradewind.plans import diagnostics as d


def money_avg(column: str) -> str:
    return f"{money(column)} / COUNT(*)"


@query(
    "q1_recent_orders",
    """
    SELECT id, user_id, total_amount, status, created_at, updated_at FROM shop_orders
    ORDER BY created_at DESC, id LIMIT 20""",
)
def q1(t: Inputs):
    return d.recent_orders(t.orders)


@query(
    "q2_orders_by_status",
    f"""
    SELECT status, COUNT(*) AS count, {money("total_amount")} AS total_revenue,
           {money_avg("total_amount")} AS avg_amount
    FROM shop_orders GROUP BY status""",
)
def q2(t: Inputs):
    return d.orders_by_status(t.orders)


@query(
    "q3_orders_by_hour",
    f"""
    SELECT date_trunc('hour', created_at) AS hour, COUNT(*) AS order_count,
           {money("total_amount")} AS revenue, {money_avg("total_amount")} AS avg_order_value
    FROM shop_orders GROUP BY 1 ORDER BY hour DESC LIMIT 24""",
)
def q3(t: Inputs):
    return d.orders_by_hour(t.orders)


@query(
    "q4_recent_payments",
    """
    SELECT id, order_id, amount, method, status, created_at FROM payments
    ORDER BY created_at DESC, id LIMIT 20""",
)
def q4(t: Inputs):
    return d.recent_payments(t.payments)


@query(
    "q5_payment_distribution",
    f"""
    SELECT status, COUNT(*) AS count, {money("amount")} AS total_amount,
           ROUND(100.0 * COUNT(*) / SUM(COUNT(*)) OVER (), 2) AS percentage
    FROM payments GROUP BY status""",
)
def q5(t: Inputs):
    return d.payment_distribution(t.payments)


@query(
    "q6_failed_payments",
    """
    SELECT id, order_id, amount, method, status, created_at FROM payments
    WHERE status = 'FAILED' ORDER BY created_at DESC, id LIMIT 20""",
)
def q6(t: Inputs):
    return d.failed_payments(t.payments)


TREND = "SELECT window_start, window_end, order_count, total_revenue, avg_order_value FROM revenue"


@query("q7_recent_revenue", f"{TREND} ORDER BY window_start DESC LIMIT 10")
def q7(t: Inputs):
    return d.revenue_trend(t.revenue)


@query("q7_revenue_trend", TREND)
def q7_full(t: Inputs):
    return d.revenue_trend(t.revenue, None)


ALERTS = "SELECT alert_id, alert_timestamp, user_id, alert_type, severity FROM alerts"


def _listed(alerts):
    return alerts.select("alert_id", "alert_timestamp", "user_id", "alert_type", "severity")


@query("q8_recent_alerts", f"{ALERTS} ORDER BY alert_timestamp DESC, alert_id LIMIT 20")
def q8(t: Inputs):
    return _listed(d.recent_alerts(t.alerts))


@query(
    "q8_recent_high_alerts",
    f"{ALERTS} WHERE severity = 'HIGH' ORDER BY alert_timestamp DESC, alert_id LIMIT 20",
)
def q8_high(t: Inputs):
    return _listed(d.recent_alerts(t.alerts, "HIGH"))


@query(
    "q9_alert_type_severity",
    """
    SELECT alert_type, COUNT(*) AS count,
           SUM(CASE WHEN severity = 'HIGH' THEN 1 ELSE 0 END)::DOUBLE / COUNT(*)
             AS high_severity_ratio
    FROM alerts GROUP BY alert_type""",
)
def q9(t: Inputs):
    return d.alert_type_severity(t.alerts)


@query(
    "q10_abandoned_with_product",
    f"""
    SELECT a.user_id, a.product_id, a.item_added_time, p.name AS product_name, p.price,
           CAST(ROUND((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(a.item_added_time)) / 3.6e9)
                AS INTEGER) AS hours_since_added
    FROM abandoned a JOIN products p ON a.product_id = p.product_id
    ORDER BY a.item_added_time DESC, a.user_id, a.product_id LIMIT 20""",
)
def q10(t: Inputs):
    return d.abandoned_with_product(t.abandoned, t.products, AS_OF)


@query(
    "q11_most_abandoned_products",
    """
    SELECT a.product_id, p.name AS product_name, COUNT(*) AS times_abandoned,
           MAX(p.price) AS avg_product_price, COUNT(DISTINCT a.user_id) AS unique_users
    FROM abandoned a JOIN products p ON a.product_id = p.product_id
    GROUP BY a.product_id, p.name ORDER BY times_abandoned DESC, a.product_id LIMIT 20""",
)
def q11(t: Inputs):
    return d.most_abandoned_products(t.abandoned, t.products)


@query(
    "q12_most_abandoning_users",
    """
    SELECT user_id, COUNT(*) AS total_abandoned_items,
           COUNT(DISTINCT product_id) AS unique_products, MAX(item_added_time) AS last_abandoned
    FROM abandoned GROUP BY user_id ORDER BY total_abandoned_items DESC, user_id LIMIT 20""",
)
def q12(t: Inputs):
    return d.most_abandoning_users(t.abandoned)


@query(
    "q13_recent_velocity",
    """
    SELECT product_id, window_start, window_end, units_sold, revenue, velocity_rank FROM velocity
    ORDER BY window_end DESC, velocity_rank, product_id LIMIT 20""",
)
def q13(t: Inputs):
    return d.recent_velocity(t.velocity)


@query(
    "q14_top_sellers",
    """
    SELECT product_id, CAST(SUM(units_sold) AS BIGINT) AS total_units, COUNT(*) AS time_windows,
           SUM(units_sold)::DOUBLE / COUNT(*) AS avg_units_per_window
    FROM velocity GROUP BY product_id ORDER BY total_units DESC, product_id LIMIT 20""",
)
def q14(t: Inputs):
    return d.top_sellers(t.velocity)


@query("q15_product_list", "SELECT id, name, price, stock, created_at FROM products")
def q15(t: Inputs):
    return d.product_list(t.products)


@query("q15_low_stock", "SELECT id, name, price, stock FROM products WHERE stock < 10")
def q15_low(t: Inputs):
    return d.low_stock(t.products)


@query("q16_processed_by_type", "SELECT event_type, COUNT(*) AS count FROM processed GROUP BY 1")
def q16(t: Inputs):
    return d.processed_by_type(t.processed)


@query(
    "q17_event_report",
    """
    SELECT 'Total processed events' AS metric, COUNT(*) AS count FROM processed
    UNION ALL SELECT 'Events - ' || event_type, COUNT(*) FROM processed GROUP BY event_type""",
)
def q17(t: Inputs):
    return d.event_report(t.processed)


@query(
    "q18_recent_processed",
    """
    SELECT id, event_id, event_type, processed_at FROM processed
    ORDER BY processed_at DESC, id LIMIT 20""",
)
def q18(t: Inputs):
    return d.recent_processed(t.processed)


@query("q19_pending_outbox", "SELECT COUNT(*) AS pending_events FROM outbox WHERE published = 'N'")
def q19(t: Inputs):
    return d.pending_outbox(t.outbox)


@query(
    "q20_recent_reservations",
    """
    SELECT id, order_id, product_id, quantity, created_at FROM reservations
    ORDER BY created_at DESC, id LIMIT 20""",
)
def q20(t: Inputs):
    return d.recent_reservations(t.reservations)


@query(
    "q21_reservation_stats",
    """
    SELECT product_id, COUNT(*) AS total_reservations, CAST(SUM(quantity) AS BIGINT) AS total_reserved,
           SUM(quantity)::DOUBLE / COUNT(*) AS avg_reserved
    FROM reservations GROUP BY product_id""",
)
def q21(t: Inputs):
    return d.reservation_stats(t.reservations)


@query(
    "q21_pending_reservations",
    """
    SELECT product_id, COUNT(*) AS count, CAST(SUM(quantity) AS BIGINT) AS total_quantity
    FROM reservations GROUP BY product_id""",
)
def q21_pending(t: Inputs):
    return d.pending_reservations(t.reservations)


@query(
    "q22_recent_ops",
    """
    SELECT topic, metric_name, metric_value, status, window_start FROM ops
    ORDER BY window_start DESC, topic, metric_name LIMIT 20""",
)
def q22(t: Inputs):
    return d.recent_ops(t.ops)


@query(
    "q23_ops_stats",
    """
    SELECT status, metric_name, SUM(metric_value)::DOUBLE / COUNT(*) AS avg_value,
           MAX(metric_value) AS max_value, MIN(metric_value) AS min_value, COUNT(*) AS measurements
    FROM ops GROUP BY status, metric_name""",
)
def q23(t: Inputs):
    return d.ops_stats(t.ops)


@query(
    "q24_ops_hourly",
    """
    SELECT date_trunc('hour', window_start) AS hour, metric_name,
           SUM(metric_value)::DOUBLE / COUNT(*) AS avg_value, MAX(metric_value) AS max_value
    FROM ops GROUP BY 1, 2 ORDER BY hour DESC, metric_name LIMIT 24""",
)
def q24(t: Inputs):
    return d.ops_hourly(t.ops)


def _age(name: str, column: str) -> str:
    return f"""
        SELECT '{name}' AS table_name, MAX({column}) AS last_update,
               (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(MAX({column}))) / 1e6 AS age_seconds"""


@query(
    "q25_freshness",
    f"""
    {_age("revenue_metrics", "window_end")} FROM revenue
    UNION ALL {_age("fraud_alerts", "alert_timestamp")} FROM alerts
    UNION ALL {_age("cart_abandonment", "detected_at")} FROM abandoned
    UNION ALL {_age("inventory_velocity", "window_end")} FROM velocity
    UNION ALL {_age("operational_metrics", "window_start")} FROM ops""",
)
def q25(t: Inputs):
    tables = {
        "revenue_metrics": t.revenue,
        "fraud_alerts": t.alerts,
        "cart_abandonment": t.abandoned,
        "inventory_velocity": t.velocity,
        "operational_metrics": t.ops,
    }
    return d.freshness(tables, AS_OF)


@query(
    "q26_status_report",
    """
    SELECT 'Total orders' AS metric, COUNT(*) AS count FROM shop_orders
    UNION ALL SELECT 'Orders - ' || status, COUNT(*) FROM shop_orders GROUP BY status
    UNION ALL SELECT 'Total payments', COUNT(*) FROM payments
    UNION ALL SELECT 'Payments - ' || status, COUNT(*) FROM payments GROUP BY status""",
)
def q26(t: Inputs):
    return d.status_report(t.orders, t.payments)


@query(
    "q27_fulfilled_vs_paid",
    """
    SELECT 'FULFILLED orders' AS metric, COUNT(*) AS count FROM shop_orders
    WHERE status = 'FULFILLED'
    UNION ALL SELECT 'Successful payments', COUNT(*) FROM payments WHERE status = 'SUCCESS'
    UNION ALL SELECT 'All payments', COUNT(*) FROM payments""",
)
def q27(t: Inputs):
    return d.fulfilled_vs_paid(t.orders, t.payments)


@query(
    "q28_fulfilled_without_payment",
    """
    SELECT o.order_id, o.user_id, o.total_amount, o.created_at
    FROM shop_orders o LEFT JOIN payments p ON o.order_id = p.order_id
    WHERE o.status = 'FULFILLED' AND p.id IS NULL""",
)
def q28(t: Inputs):
    return d.fulfilled_without_payment(t.orders, t.payments).drop("payment_id")


@query(
    "q29_paid_without_fulfilment",
    """
    SELECT p.payment_id, p.order_id, p.status, p.created_at, o.status AS order_status
    FROM payments p LEFT JOIN shop_orders o ON p.order_id = o.order_id
    WHERE p.status = 'SUCCESS' AND (o.id IS NULL OR o.status <> 'FULFILLED')""",
)
def q29(t: Inputs):
    return d.paid_without_fulfilment(t.payments, t.orders)


@query(
    "q30_fulfilment_event_report",
    """
    SELECT 'order.fulfilled events processed' AS metric, COUNT(*) AS count
    FROM order_log WHERE event_type = 'order.fulfilled'
    UNION ALL SELECT 'payment.processed events processed', COUNT(*)
    FROM order_log WHERE event_type = 'payment.processed'
    UNION ALL SELECT 'Actual FULFILLED orders', COUNT(*) FROM shop_orders WHERE status = 'FULFILLED'
    UNION ALL SELECT 'Actual SUCCESS payments', COUNT(*) FROM payments WHERE status = 'SUCCESS'""",
)
def q30(t: Inputs):
    return d.fulfilment_event_report(t.order_log, t.orders, t.payments)


@query(
    "q31_events_matching_orders",
    """
    SELECT COUNT(DISTINCT e.event_id) AS total_fulfilled_events,
           COUNT(DISTINCT CASE WHEN o.id IS NOT NULL THEN e.event_id END)
             AS events_with_matching_orders
    FROM processed e LEFT JOIN shop_orders o ON o.order_id LIKE '%' || e.event_id || '%'
    WHERE e.event_type = 'purchase'""",
)
def q31(t: Inputs):
    return d.events_matching_orders(t.processed, t.orders, "purchase")


@query(
    "q32_duplicate_payments",
    "SELECT order_id, COUNT(*) AS count FROM payments GROUP BY order_id HAVING COUNT(*) > 1",
)
def q32(t: Inputs):
    return d.duplicate_payments(t.payments)


@query(
    "q33_duplicate_events",
    "SELECT event_id, COUNT(*) AS count FROM deliveries GROUP BY event_id HAVING COUNT(*) > 1",
)
def q33(t: Inputs):
    return d.duplicate_events(t.deliveries)


@query(
    "q33_duplicate_events_by_type",
    """
    SELECT event_type, event_id, COUNT(*) AS count FROM order_log
    GROUP BY event_type, event_id HAVING COUNT(*) > 1
    UNION ALL
    SELECT event_type, event_id, COUNT(*) FROM deliveries
    GROUP BY event_type, event_id HAVING COUNT(*) > 1""",
)
def q33_by_type(t: Inputs):
    saga = d.duplicate_events(t.order_log, by_type=True)
    return saga.unionByName(d.duplicate_events(t.deliveries, by_type=True))


@query(
    "q34_status_spans",
    """
    SELECT order_id, status, COUNT(*) AS changes, MIN(ts) AS first_change, MAX(ts) AS last_change
    FROM status_log GROUP BY order_id, status""",
)
def q34(t: Inputs):
    from tradewind.plans.orders import status_of

    log = t.order_log.select(
        "order_id", status_of(F.col("event_type")).alias("status"), F.col("event_timestamp").alias("updated_at")
    )
    return d.status_spans(log)


@query(
    "q35_user_orders",
    """
    SELECT o.order_id, o.user_id, o.status, o.total_amount, o.created_at FROM shop_orders o
    WHERE o.user_id = (SELECT MAX(user_id) FROM shop_orders)""",
)
def q35(t: Inputs):
    somebody = t.orders.agg(F.max("user_id").alias("somebody"))
    return d.user_orders(t.orders, somebody.scalar())


@query(
    "q35_user_order_count",
    """
    SELECT COUNT(*) AS count FROM shop_orders
    WHERE user_id = (SELECT MAX(user_id) FROM shop_orders)""",
)
def q35_count(t: Inputs):
    return d.user_order_count(t.orders, t.orders.agg(F.max("user_id").alias("somebody")).scalar())
