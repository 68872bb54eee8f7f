"""Trailing-window KPIs over the result tables, each as of a given instant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.money import money_sum
from tradewind.functions.scalars import label
from tradewind.functions.timing import Instant, instant, micros, within_last
from tradewind.operators.ranking import latest_value, numbered_highest
from tradewind.operators.reports import stacked

DAY, HOUR = "24 hours", "1 hour"


def _or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


def _count_by(df: DataFrame, name: str, key: Column) -> DataFrame:
    return df.groupBy(key.alias(name)).agg(F.count("*").alias("count"))


def revenue_24h(revenue: DataFrame, as_of: Instant) -> DataFrame:
    """Revenue and orders of the last day, and the unweighted mean of the window means."""
    return revenue.filter(within_last("window_start", as_of, DAY)).agg(
        _or_zero(money_sum("total_revenue")).alias("total_revenue"),
        _or_zero(F.sum("order_count")).alias("order_count"),
        _or_zero(F.avg("avg_order_value")).alias("mean_of_window_means"),
    )


def revenue_vs_average(revenue: DataFrame, as_of: Instant, days: int = 30) -> DataFrame:
    """Revenue of the last day divided by the mean of the last ``days`` days that had any.

    Days are counted back from ``as_of``. Null without revenue in the last day.
    """
    age = F.unix_micros(instant(as_of)) - F.unix_micros("window_start")
    day = F.floor(age / F.lit(micros(DAY)))
    per_day = (
        revenue.filter((age >= 0) & (age < days * micros(DAY)))
        .groupBy(day.alias("days_ago"))
        .agg(money_sum("total_revenue").alias("day_revenue"))
    )
    last_day = F.max(F.when(F.col("days_ago") == 0, F.col("day_revenue")))
    mean = F.try_divide(money_sum("day_revenue"), F.count("day_revenue"))
    return per_day.agg(F.try_divide(last_day, mean).alias("revenue_vs_average"))


def latest_revenue(revenue: DataFrame) -> DataFrame:
    """Revenue of the newest window; no row if there is no window yet."""
    newest = revenue.agg(
        latest_value("window_start", "total_revenue").alias("total_revenue"),
        F.count("*").alias("windows"),
    )
    return newest.filter("windows > 0").select(
        F.coalesce("total_revenue", F.lit(0.0)).alias("revenue_per_minute")
    )


def fraud_by_severity(alerts: DataFrame, as_of: Instant) -> DataFrame:
    recent = alerts.filter(within_last("alert_timestamp", as_of, DAY))
    return _count_by(recent, "severity", label("severity", "UNKNOWN", upper=True))


def fraud_by_type(alerts: DataFrame, as_of: Instant) -> DataFrame:
    recent = alerts.filter(within_last("alert_timestamp", as_of, DAY))
    return _count_by(recent, "alert_type", label("alert_type", "unknown"))


def fraud_rate_per_hour(alerts: DataFrame, as_of: Instant) -> DataFrame:
    recent = alerts.filter(within_last("alert_timestamp", as_of, DAY))
    return recent.agg((F.count("*") / F.lit(24.0)).alias("alerts_per_hour"))


def units_sold_24h(velocity: DataFrame, as_of: Instant) -> DataFrame:
    recent = velocity.filter(within_last("window_start", as_of, DAY))
    return recent.agg(_or_zero(F.sum("units_sold")).alias("units_sold"))


def top_products(velocity: DataFrame, as_of: Instant, n: int = 10, span: str = DAY) -> DataFrame:
    """The ``n`` products with most units, with their revenue and row number."""
    per_product = (
        velocity.filter(within_last("window_start", as_of, span))
        .groupBy("product_id")
        .agg(F.sum("units_sold").alias("units"), money_sum("revenue").alias("revenue"))
    )
    return numbered_highest(per_product, "units", n, ["product_id"])


def abandoned_24h(abandoned: DataFrame, as_of: Instant) -> DataFrame:
    """Abandoned items of the last day, with the rates of a table that holds nothing else.

    Such a table can only say 100 % or, when empty, 0 %, and no recovery. ``cart_rates`` gives
    the real rates.
    """
    recent = abandoned.filter(within_last("detected_at", as_of, DAY))
    return recent.agg(F.count("*").alias("abandoned")).select(
        "abandoned",
        F.when(F.col("abandoned") > 0, 100.0).otherwise(0.0).alias("abandonment_rate"),
        F.lit(0.0).alias("recovery_rate"),
    )


def cart_rates(abandoned: DataFrame, adds: DataFrame, as_of: Instant, span: str = DAY) -> DataFrame:
    """Share of the added items that were abandoned and that were bought, in percent.

    Both inputs are counted by the time the item was added.
    """
    def counted(df: DataFrame, ts: str, abandons: int) -> DataFrame:
        return df.filter(within_last(ts, as_of, span)).select(F.lit(abandons).alias("is_abandon"))

    lost = F.count_if(F.col("is_abandon") == 1)
    added = F.count_if(F.col("is_abandon") == 0)
    return (
        counted(abandoned, "item_added_time", 1)
        .unionByName(counted(adds, "event_timestamp", 0))
        .agg(lost.alias("abandoned"), added.alias("added"))
        .select(
            "abandoned",
            "added",
            F.coalesce(F.try_divide(F.col("abandoned") * 100.0, F.col("added")), F.lit(0.0)).alias(
                "abandonment_rate"
            ),
            F.coalesce(
                F.try_divide((F.col("added") - F.col("abandoned")) * 100.0, F.col("added")),
                F.lit(0.0),
            ).alias("recovery_rate"),
        )
    )


def health_pct(ops: DataFrame, as_of: Instant, span: str = HOUR) -> DataFrame:
    """Percentage of healthy measurements; zero when nothing was measured."""
    recent = ops.filter(within_last("window_start", as_of, span))
    share = F.try_divide(F.count_if(F.col("status") == "HEALTHY"), F.count("*"))
    return recent.agg(F.coalesce(share * 100.0, F.lit(0.0)).alias("health_pct"))


def status_breakdown(ops: DataFrame, as_of: Instant, span: str = HOUR) -> DataFrame:
    recent = ops.filter(within_last("window_start", as_of, span))
    return _count_by(recent, "status", label("status", "UNKNOWN"))


def critical_count(ops: DataFrame, as_of: Instant, span: str = HOUR) -> DataFrame:
    recent = ops.filter((F.col("status") == "CRITICAL") & within_last("window_start", as_of, span))
    return recent.agg(F.count("*").alias("critical_count"))


def snapshot(
    revenue: DataFrame,
    alerts: DataFrame,
    velocity: DataFrame,
    abandoned: DataFrame,
    ops: DataFrame,
    as_of: Instant,
    n: int = 10,
) -> DataFrame:
    """All KPIs as of an instant in one table (kpi, label, value), ready to publish or to alert on.

    ``label`` tells apart the values of one KPI: a severity, a type, a status or a product.
    """

    def values(df: DataFrame, label_column: str | None, **columns: str) -> DataFrame:
        shown = F.col(label_column) if label_column else F.lit(None)
        rows = F.array(
            *[
                F.struct(
                    F.lit(kpi).alias("kpi"),
                    shown.cast("string").alias("label"),
                    F.col(column).cast("double").alias("value"),
                )
                for kpi, column in columns.items()
            ]
        )
        return df.select(F.explode(rows).alias("row")).select("row.*")

    parts = [
        values(
            revenue_24h(revenue, as_of),
            None,
            revenue_total_24h="total_revenue",
            order_count_24h="order_count",
            avg_order_value="mean_of_window_means",
        ),
        values(latest_revenue(revenue), None, revenue_per_minute="revenue_per_minute"),
        values(revenue_vs_average(revenue, as_of), None, revenue_vs_average="revenue_vs_average"),
        values(fraud_by_severity(alerts, as_of), "severity", fraud_alerts="count"),
        values(fraud_by_type(alerts, as_of), "alert_type", fraud_by_type="count"),
        values(fraud_rate_per_hour(alerts, as_of), None, fraud_alerts_per_hour="alerts_per_hour"),
        values(units_sold_24h(velocity, as_of), None, units_sold_24h="units_sold"),
        values(
            top_products(velocity, as_of, n),
            "product_id",
            top_product_units="units",
            top_product_revenue="revenue",
        ),
        values(
            abandoned_24h(abandoned, as_of),
            None,
            cart_abandoned_24h="abandoned",
            cart_abandonment_rate="abandonment_rate",
            cart_recovery_rate="recovery_rate",
        ),
        values(health_pct(ops, as_of), None, system_health_pct="health_pct"),
        values(status_breakdown(ops, as_of), "status", system_status="count"),
        values(critical_count(ops, as_of), None, critical_alerts="critical_count"),
    ]
    return stacked(parts)
