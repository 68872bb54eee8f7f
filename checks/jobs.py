"""The five jobs in a batch."""

from pyspark.sql import functions as F

from checks.inputs import Inputs
from checks.registry import query
from checks.relations import money
from tradewind.plans import jobs


def _revenue_sql(unit: str) -> str:
    return f"""
        SELECT date_trunc('{unit}', ts) AS window_start,
               date_trunc('{unit}', ts) + INTERVAL 1 {unit} AS window_end,
               {money("amount")} AS total_revenue, COUNT(*) AS order_count,
               {money("amount")} / COUNT(*) AS avg_order_value
        FROM payments_made GROUP BY 1, 2"""


@query("c1_revenue_by_minute", _revenue_sql("minute"))
def revenue_by_minute(t: Inputs):
    return jobs.revenue_by_window(t.payments_made)


@query("c1_revenue_by_hour", _revenue_sql("hour"))
def revenue_by_hour(t: Inputs):
    return jobs.revenue_by_window(t.payments_made, "1 hour")


def with_details(alerts):
    """The alert with its details read back from their JSON text."""

    def detail(name, kind):
        return F.get_json_object("details", f"$.{name}").cast(kind).alias(name)

    return alerts.select(
        "alert_id",
        "alert_timestamp",
        "user_id",
        "alert_type",
        "severity",
        detail("order_frequency", "bigint"),
        detail("max_amount", "double"),
        detail("failed_count", "bigint"),
    )


@query(
    "c2_fraud_alerts",
    """
    SELECT alert_id, alert_timestamp, user_id, alert_type, severity,
           orders_seen AS order_frequency, largest AS max_amount, payments_seen AS failed_count
    FROM alerts""",
)
def fraud(t: Inputs):
    return with_details(t.alerts)


@query(
    "c2_fraud_alerts_default_limits",
    """
    SELECT user_id || '_' || CAST(epoch(w) AS BIGINT) AS alert_id, w AS alert_timestamp, user_id,
           CASE WHEN n_orders > 3 THEN 'UNUSUAL_ORDER_FREQUENCY'
                WHEN largest > 1000 THEN 'HIGH_ORDER_VALUE'
                ELSE 'MULTIPLE_PAYMENT_EVENTS' END AS alert_type,
           CASE WHEN n_orders > 5 OR largest > 5000 OR COALESCE(n_payments, 0) > 5 THEN 'CRITICAL'
                WHEN n_orders > 3 OR largest > 1000 THEN 'HIGH' ELSE 'MEDIUM' END AS severity
    FROM (
      SELECT user_id, w, COUNT(*) FILTER (WHERE kind = 'o') AS n_orders, MAX(amount) AS largest,
             COUNT(*) FILTER (WHERE kind = 'p') AS n_payments
      FROM (SELECT user_id, amount * 10 AS amount, kind,
                   time_bucket(INTERVAL 1 MINUTE, ts, TIMESTAMP '1970-01-01') - to_minutes(back) AS w
            FROM (SELECT *, 'p' AS kind FROM payments_made
                  UNION ALL SELECT user_id, amount, ts, 'o' FROM clicks) e, range(0, 5) AS b(back)) x
      GROUP BY user_id, w) g
    WHERE n_orders > 3 OR largest > 1000 OR n_payments > 2""",
)
def fraud_defaults(t: Inputs):
    # Amounts are taken tenfold, in another currency so to say, so that some exceed the limits.
    def tenfold(events, column):
        return events.withColumn(column, F.col(column) * 10)

    alerts = jobs.fraud_alerts(tenfold(t.payments_made, "amount"), tenfold(t.clicks, "total_amount"))
    return alerts.select("alert_id", "alert_timestamp", "user_id", "alert_type", "severity")


def _abandoned_sql(within: str) -> str:
    return f"""
        SELECT c.user_id, c.product_id, c.ts AS item_added_time FROM clicks c
        WHERE NOT EXISTS (SELECT 1 FROM payments_made p WHERE p.user_id = c.user_id
                          AND p.ts >= c.ts AND p.ts <= c.ts + INTERVAL {within})"""


@query("c3_cart_abandonment", _abandoned_sql("30 MINUTES"))
def abandonment(t: Inputs):
    return jobs.cart_abandonment(t.clicks, t.payments_made)


@query("c3_cart_abandonment_12h", _abandoned_sql("12 HOURS"))
def abandonment_12h(t: Inputs):
    return jobs.cart_abandonment(t.clicks, t.payments_made, "12 hours")


@query(
    "c4_inventory_velocity_by_month",
    f"""
    SELECT * FROM (
      SELECT *, DENSE_RANK() OVER (PARTITION BY window_start ORDER BY units_sold DESC)
                  AS velocity_rank
      FROM (
        SELECT date_trunc('month', o.created_at) AS window_start,
               date_trunc('month', o.created_at) + INTERVAL 1 MONTH AS window_end,
               l.product_id, CAST(SUM(l.quantity) AS BIGINT) AS units_sold, {money("l.amount")} AS revenue
        FROM shop_orders o JOIN lines l ON o.order_id = l.order_id
        WHERE o.status = 'FULFILLED' GROUP BY 1, 2, 3
      ) sold
    ) ranked
    WHERE velocity_rank <= 10""",
)
def velocity_by_month(t: Inputs):
    return jobs.inventory_velocity(t.orders_with_items, "month")


@query(
    "c4_inventory_velocity_by_hour",
    f"""
    SELECT * FROM (
      SELECT *, DENSE_RANK() OVER (PARTITION BY window_start ORDER BY units_sold DESC)
                  AS velocity_rank
      FROM (
        SELECT date_trunc('hour', o.created_at) AS window_start,
               date_trunc('hour', o.created_at) + INTERVAL 1 HOUR AS window_end,
               l.product_id, CAST(SUM(l.quantity) AS BIGINT) AS units_sold, {money("l.amount")} AS revenue
        FROM shop_orders o JOIN lines l ON o.order_id = l.order_id
        WHERE o.status = 'FULFILLED' GROUP BY 1, 2, 3
      ) sold
    ) ranked
    WHERE velocity_rank <= 10""",
)
def velocity_by_hour(t: Inputs):
    return jobs.inventory_velocity(t.orders_with_items)


@query(
    "c5_topic_throughput_health",
    """
    SELECT date_trunc('day', ts) AS window_start,
           date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, event_type AS topic,
           'throughput' AS metric_name, COUNT(*) AS metric_value, 70 AS threshold,
           CASE WHEN COUNT(*) > 70 THEN 'HEALTHY' WHEN COUNT(*) > 60 THEN 'WARNING'
                ELSE 'CRITICAL' END AS status,
           event_type AS topic_monitored, COUNT(*) AS events_processed
    FROM events GROUP BY 1, 2, 3""",
)
def throughput(t: Inputs):
    health = jobs.topic_throughput_health(
        t.envelope, "1 day", threshold=70, healthy_above=70, warning_above=60, topics=None
    )
    return health.select(
        "*",
        F.get_json_object("services_checked", "$.topic_monitored").alias("topic_monitored"),
        F.get_json_object("services_checked", "$.events_processed").cast("bigint").alias("events_processed"),
    ).drop("services_checked")
