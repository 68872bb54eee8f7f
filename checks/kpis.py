"""The KPIs over the result tables."""

from uuid import uuid4

from checks.inputs import ALERTS_AS_OF, AS_OF, ORDERS_AS_OF, Inputs
from checks.registry import query
from checks.relations import money
from pyspark.sql import functions as F
from tradewind.plans import alerting, dead_letters, kpis
from tradewind.plans.kpi_report import report
from tradewind.session import durable_folder
from tradewind.sources.sinks import write_snapshot
from tradewind.streaming.runner import batch_folder_sink, upsert_sink

DAY_AGO = f"TIMESTAMP '{AS_OF}' - INTERVAL 24 HOURS"
ALERTS_DAY_AGO = f"TIMESTAMP '{ALERTS_AS_OF}' - INTERVAL 24 HOURS"
HOUR_AGO = f"TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR"


@query(
    "k1_revenue_24h",
    f"""
    SELECT COALESCE({money("total_revenue")}, 0) AS total_revenue,
           CAST(COALESCE(SUM(order_count), 0) AS BIGINT) AS order_count,
           ROUND(COALESCE(AVG(avg_order_value), 0), 6) AS mean_of_window_means
    FROM revenue WHERE window_start > {DAY_AGO}""",
)
def revenue_24h(t: Inputs):
    kpi = kpis.revenue_24h(t.revenue, AS_OF)
    return kpi.withColumn("mean_of_window_means", F.round("mean_of_window_means", 6))


@query(
    "k2_latest_revenue",
    """
    SELECT COALESCE(total_revenue, 0) AS revenue_per_minute
    FROM revenue ORDER BY window_start DESC LIMIT 1""",
)
def latest(t: Inputs):
    return kpis.latest_revenue(t.revenue)


@query(
    "k3_fraud_by_severity",
    f"""
    SELECT COALESCE(upper(severity), 'UNKNOWN') AS severity, COUNT(*) AS count
    FROM alerts WHERE alert_timestamp > {ALERTS_DAY_AGO} GROUP BY 1""",
)
def by_severity(t: Inputs):
    return kpis.fraud_by_severity(t.alerts, ALERTS_AS_OF)


@query(
    "k4_fraud_by_type",
    f"""
    SELECT COALESCE(alert_type, 'unknown') AS alert_type, COUNT(*) AS count
    FROM alerts WHERE alert_timestamp > {ALERTS_DAY_AGO} GROUP BY 1""",
)
def by_type(t: Inputs):
    return kpis.fraud_by_type(t.alerts, ALERTS_AS_OF)


@query(
    "k5_fraud_rate_per_hour",
    f"SELECT COUNT(*) / 24.0 AS alerts_per_hour FROM alerts WHERE alert_timestamp > {ALERTS_DAY_AGO}",
)
def fraud_rate(t: Inputs):
    return kpis.fraud_rate_per_hour(t.alerts, ALERTS_AS_OF)


ORDERS_DAY_AGO = f"TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL 24 HOURS"


@query(
    "k6_units_sold_24h",
    f"SELECT CAST(COALESCE(SUM(units_sold), 0) AS BIGINT) AS units_sold FROM velocity WHERE window_start > {ORDERS_DAY_AGO}",
)
def units(t: Inputs):
    return kpis.units_sold_24h(t.velocity, ORDERS_AS_OF)


def _top_sql(span: str) -> str:
    return f"""
        SELECT product_id, CAST(SUM(units_sold) AS BIGINT) AS units, {money("revenue")} AS revenue,
               ROW_NUMBER() OVER (ORDER BY SUM(units_sold) DESC, product_id) AS rank
        FROM velocity WHERE window_start > TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL {span}
        GROUP BY product_id ORDER BY units DESC, product_id LIMIT 10"""


@query("k7_top_products", _top_sql("24 HOURS"))
def top(t: Inputs):
    return kpis.top_products(t.velocity, ORDERS_AS_OF)


@query("k7_top_products_of_a_year", _top_sql("365 DAYS"))
def top_year(t: Inputs):
    return kpis.top_products(t.velocity, ORDERS_AS_OF, span="365 days")


@query(
    "k8_abandoned_24h",
    f"""
    SELECT COUNT(*) AS abandoned,
           CASE WHEN COUNT(*) > 0 THEN 100.0 ELSE 0.0 END::DOUBLE AS abandonment_rate,
           0.0::DOUBLE AS recovery_rate
    FROM abandoned WHERE detected_at > {DAY_AGO}""",
)
def abandoned(t: Inputs):
    return kpis.abandoned_24h(t.abandoned, AS_OF)


CART_RATES = f"""
    SELECT lost AS abandoned, added,
           COALESCE(lost * 100.0::DOUBLE / NULLIF(added, 0), 0) AS abandonment_rate,
           COALESCE((added - lost) * 100.0::DOUBLE / NULLIF(added, 0), 0) AS recovery_rate
    FROM (SELECT COUNT(*) AS lost FROM abandoned WHERE item_added_time > {DAY_AGO}) a,
         (SELECT COUNT(*) AS added FROM clicks WHERE ts > {DAY_AGO}) b"""


@query("k8_cart_rates", CART_RATES)
def rates(t: Inputs):
    return kpis.cart_rates(t.abandoned, t.clicks, AS_OF)


@query(
    "k9_health_pct",
    f"""
    SELECT COALESCE(COUNT(*) FILTER (WHERE status = 'HEALTHY') / NULLIF(COUNT(*), 0)::DOUBLE
                    * 100.0::DOUBLE, 0) AS health_pct
    FROM ops WHERE window_start > {HOUR_AGO}""",
)
def health(t: Inputs):
    return kpis.health_pct(t.ops, AS_OF)


@query(
    "k10_status_breakdown",
    f"""
    SELECT COALESCE(status, 'UNKNOWN') AS status, COUNT(*) AS count
    FROM ops WHERE window_start > {HOUR_AGO} GROUP BY 1""",
)
def breakdown(t: Inputs):
    return kpis.status_breakdown(t.ops, AS_OF)


@query(
    "k11_critical_count",
    f"""
    SELECT COUNT(*) AS critical_count FROM ops
    WHERE status = 'CRITICAL' AND window_start > {HOUR_AGO}""",
)
def critical(t: Inputs):
    return kpis.critical_count(t.ops, AS_OF)


@query(
    "m12_evaluate_alerts",
    f"""
    WITH values_now AS (
      SELECT 'fraud_alerts_per_hour' AS kpi, COUNT(*) / 24.0 AS value
      FROM alerts WHERE alert_timestamp > {DAY_AGO}
      UNION ALL SELECT 'cart_abandonment_rate', abandonment_rate FROM ({CART_RATES}) r
      UNION ALL SELECT 'dlq_messages', COUNT(*) FROM dead_letters
    )
    SELECT alert, r.kpi, CAST(value AS DOUBLE) AS value, CAST("limit" AS DOUBLE) AS "limit", severity,
           COALESCE(CASE WHEN above THEN value > "limit" ELSE value < "limit" END, FALSE) AS firing
    FROM (VALUES ('high_fraud_rate', 'fraud_alerts_per_hour', TRUE, 10.0, 'WARNING'),
                 ('high_cart_abandonment', 'cart_abandonment_rate', TRUE, 60.0, 'WARNING'),
                 ('revenue_anomaly', 'revenue_vs_average', FALSE, 0.8, 'WARNING'),
                 ('dead_letters', 'dlq_messages', TRUE, 50.0, 'WARNING'),
                 ('dead_letters_critical', 'dlq_messages', TRUE, 100.0, 'CRITICAL'))
         r(alert, kpi, above, "limit", severity)
    LEFT JOIN values_now v ON r.kpi = v.kpi""",
)
def alert_rules(t: Inputs):
    def value(df, column, kpi):
        return df.select(F.lit(kpi).alias("kpi"), F.col(column).cast("double").alias("value"))

    values = (
        value(kpis.fraud_rate_per_hour(t.alerts, AS_OF), "alerts_per_hour", "fraud_alerts_per_hour")
        .unionByName(
            value(kpis.cart_rates(t.abandoned, t.clicks, AS_OF), "abandonment_rate", "cart_abandonment_rate")
        )
        .unionByName(value(dead_letters.replay_due(t.dead_letters), "messages", "dlq_messages"))
    )
    return alerting.evaluate_alerts(values)


VS_AVERAGE = f"""
    SELECT MAX(CASE WHEN days_ago = 0 THEN day_revenue END)
             / (CAST(SUM(CAST(day_revenue AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*))
             AS revenue_vs_average
    FROM (SELECT (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(window_start)) // 86400000000
                   AS days_ago,
                 {money("total_revenue")} AS day_revenue
          FROM revenue
          WHERE window_start <= TIMESTAMP '{AS_OF}'
            AND window_start > TIMESTAMP '{AS_OF}' - INTERVAL 30 DAYS
          GROUP BY 1) d"""


@query("k1_revenue_vs_average", VS_AVERAGE)
def vs_average(t: Inputs):
    return kpis.revenue_vs_average(t.revenue, AS_OF)


SNAPSHOT = f"""
    WITH days AS (
      SELECT {money("total_revenue")} AS r, SUM(order_count) AS n, AVG(avg_order_value) AS a
      FROM revenue WHERE window_start > {DAY_AGO}),
    hours AS (
      SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE status = 'HEALTHY') AS healthy,
             COUNT(*) FILTER (WHERE status = 'CRITICAL') AS critical
      FROM ops WHERE window_start > {HOUR_AGO}),
    recent_alerts AS (SELECT * FROM alerts WHERE alert_timestamp > {DAY_AGO}),
    top AS (
      SELECT product_id, SUM(units_sold) AS units, {money("revenue")} AS revenue FROM velocity
      WHERE window_start > {DAY_AGO} GROUP BY 1 ORDER BY units DESC, product_id LIMIT 10),
    lost AS (SELECT COUNT(*) AS n FROM abandoned WHERE detected_at > {DAY_AGO})
    SELECT kpi, label, ROUND(CAST(value AS DOUBLE), 6) AS value FROM (
      SELECT 'revenue_total_24h' AS kpi, NULL AS label, COALESCE(r, 0) AS value FROM days
      UNION ALL SELECT 'order_count_24h', NULL, COALESCE(n, 0) FROM days
      UNION ALL SELECT 'avg_order_value', NULL, COALESCE(a, 0) FROM days
      UNION ALL SELECT 'revenue_per_minute', NULL, arg_max(total_revenue, window_start) FROM revenue
      UNION ALL SELECT 'revenue_vs_average', NULL, revenue_vs_average FROM ({VS_AVERAGE}) v
      UNION ALL SELECT 'fraud_alerts', severity, COUNT(*) FROM recent_alerts GROUP BY severity
      UNION ALL SELECT 'fraud_by_type', alert_type, COUNT(*) FROM recent_alerts GROUP BY alert_type
      UNION ALL SELECT 'fraud_alerts_per_hour', NULL, COUNT(*) / 24.0::DOUBLE FROM recent_alerts
      UNION ALL SELECT 'units_sold_24h', NULL, COALESCE(SUM(units_sold), 0) FROM velocity
                WHERE window_start > {DAY_AGO}
      UNION ALL SELECT 'top_product_units', product_id, units FROM top
      UNION ALL SELECT 'top_product_revenue', product_id, revenue FROM top
      UNION ALL SELECT 'cart_abandoned_24h', NULL, n FROM lost
      UNION ALL SELECT 'cart_abandonment_rate', NULL, CASE WHEN n > 0 THEN 100 ELSE 0 END FROM lost
      UNION ALL SELECT 'cart_recovery_rate', NULL, 0 FROM lost
      UNION ALL SELECT 'system_health_pct', NULL, CASE WHEN n = 0 THEN 0 ELSE healthy * 100.0::DOUBLE / n END FROM hours
      UNION ALL SELECT 'system_status', status, COUNT(*) FROM ops WHERE window_start > {HOUR_AGO}
                GROUP BY status
      UNION ALL SELECT 'critical_alerts', NULL, critical FROM hours) x"""


@query("k_snapshot", SNAPSHOT)
def kpi_snapshot(t: Inputs):
    found = kpis.snapshot(t.revenue, t.alerts, t.velocity, t.abandoned, t.ops, AS_OF)
    return found.withColumn("value", F.round("value", 6))


@query("k_report_from_sinks", SNAPSHOT)
def kpi_report(t: Inputs):
    """Result tables stored by the sinks of the jobs, some twice, some by upsert; the command's report over them."""
    folder = f"{durable_folder(t.spark)}/runs/report-{uuid4().hex}"
    stale = batch_folder_sink(f"{folder}/revenue_metrics")
    stale(t.revenue.withColumn("total_revenue", F.lit(-1.0)), 0)
    stale(t.revenue, 1)
    batch_folder_sink(f"{folder}/operational_metrics")(t.ops, 0)
    batch_folder_sink(f"{folder}/cart_abandonment")(t.abandoned, 0)
    alerts = upsert_sink(f"{folder}/fraud_alerts", ["alert_id"], "bucket", by=F.pmod(F.xxhash64("alert_id"), F.lit(4)))
    alerts(t.alerts.withColumn("severity", F.lit("old")), 0)
    alerts(t.alerts, 1)
    write_snapshot(t.velocity, f"{folder}/inventory_velocity")
    return report(t.spark, folder, AS_OF).withColumn("value", F.round("value", 6))
