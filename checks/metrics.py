"""Metric samples."""

from checks.inputs import Inputs
from checks.registry import query
from pyspark.sql import functions as F
from tradewind.operators.slices import as_of_values
from tradewind.plans import orders, samples


@query("m1_event_counters", "SELECT event_type, COUNT(*) AS value FROM events GROUP BY 1")
def counters(t: Inputs):
    return samples.event_counters(t.events, ["event_type"])


def rounded(df, *columns):
    """Sums of doubles depend on the order of the rows in their last digits."""
    return df.select([F.round(c, 9).alias(c) if c in columns else F.col(c) for c in df.columns])


def _increase_sql(hours: int, step: int) -> str:
    """Growth in (until - hours, until] at every full step, per metric and event type."""
    return f"""
        SELECT metric, event_type, until AS ts, SUM(delta) AS grown FROM (
          SELECT 'events_total' AS metric, event_type, ts, d_events AS delta FROM growth
          UNION ALL SELECT 'value_sum', event_type, ts, d_value FROM growth) g,
          LATERAL (SELECT time_bucket(INTERVAL {step} HOURS, ts - INTERVAL 1 MICROSECOND,
                                      TIMESTAMP '1970-01-01')
                          + to_hours({step} * CAST(n AS INTEGER)) AS until
                   FROM range(1, {hours // step + 1}) AS r(n)) w
        WHERE delta IS NOT NULL GROUP BY 1, 2, 3"""


@query(
    "m2_rate_by_event_type",
    f"SELECT metric, event_type, ts, ROUND(grown / 21600.0::DOUBLE, 9) AS rate FROM ({_increase_sql(6, 1)}) i",
)
def rate(t: Inputs):
    return rounded(samples.rate(t.samples, "6 hours", ["event_type"], "1 hour"), "rate")


@query(
    "m2_rate_over_all",
    f"""
    SELECT metric, ts, ROUND(SUM(grown) / 86400.0::DOUBLE, 9) AS rate
    FROM ({_increase_sql(24, 24)}) i GROUP BY metric, ts""",
)
def rate_all(t: Inputs):
    return rounded(samples.rate(t.samples, "1 day"), "rate")


@query(
    "m3_increase",
    f"SELECT metric, event_type, ts, ROUND(grown, 9) AS increase FROM ({_increase_sql(3, 3)}) i",
)
def increase(t: Inputs):
    return rounded(samples.increase(t.samples, "3 hours", ["event_type"]), "increase")


@query(
    "m4_success_pct",
    """
    SELECT split_part(event_type, '.', 1) AS service,
           COUNT(*) FILTER (WHERE event_type IN ('payment.processed', 'inventory.reserved'))
             * 100.0::DOUBLE / COUNT(*) AS success_pct
    FROM order_log WHERE event_type NOT LIKE 'order.%' GROUP BY 1""",
)
def success(t: Inputs):
    steps = t.order_log.filter(~F.startswith("event_type", F.lit("order.")))
    good = F.col("event_type").isin("payment.processed", "inventory.reserved")
    by_service = steps.withColumn("service", F.substring_index("event_type", ".", 1))
    return samples.success_pct(by_service, good, ["service"])


@query(
    "m4_success_pct_smoothed",
    """
    SELECT COUNT(*) FILTER (WHERE event_type = 'payment.processed') * 100.0::DOUBLE
             / (COUNT(*) + 0.001::DOUBLE) AS success_pct
    FROM order_log WHERE event_type LIKE 'payment.%'""",
)
def success_smoothed(t: Inputs):
    paid = t.order_log.filter(F.startswith("event_type", F.lit("payment.")))
    return samples.success_pct(paid, F.col("event_type") == "payment.processed", eps=0.001)


DURATIONS = """
    SELECT (epoch_us(p.ts) - epoch_us(c.ts)) / 1e6 AS seconds
    FROM order_log c JOIN order_log p ON c.order_id = p.order_id
    WHERE c.event_type = 'order.created' AND p.event_type = 'payment.processed'"""
BOUNDS = "[0.1, 0.5, 1.0, 2.5, 5.0, 10.0, 'inf'::DOUBLE]"
BUCKETS = f"""
    SELECT le, COUNT(*) FILTER (WHERE seconds <= le) AS count
    FROM ({DURATIONS}) d, (SELECT unnest({BOUNDS})::DOUBLE AS le) b GROUP BY le"""


def durations(t: Inputs):
    return orders.order_durations(t.order_log)


@query("m5_buckets", f"SELECT CASE WHEN isinf(le) THEN 1e9 ELSE le END AS le, count FROM ({BUCKETS}) b")
def buckets(t: Inputs):
    found = samples.buckets(durations(t), "duration_seconds", samples.PROCESSING_BOUNDS)
    finite = F.when(F.col("le") == float("inf"), 1e9).otherwise(F.col("le"))
    return found.withColumn("le", finite)


@query(
    "m6_histogram_quantile",
    f"""
    WITH b AS ({BUCKETS}),
    placed AS (
      SELECT le, count, q, q * MAX(count) OVER (PARTITION BY q) AS rank,
             COALESCE(LAG(le) OVER (PARTITION BY q ORDER BY le), 0) AS low,
             COALESCE(LAG(count) OVER (PARTITION BY q ORDER BY le), 0) AS below
      FROM b, (VALUES (0.5::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE)) v(q))
    SELECT q, ROUND(arg_min(CASE WHEN isinf(le) THEN low
                      ELSE low + (le - low) * ((rank - below) / (count - below)) END, le), 9)
             AS quantile
    FROM placed WHERE count >= rank GROUP BY q""",
)
def quantiles(t: Inputs):
    found = samples.buckets(durations(t), "duration_seconds", samples.PROCESSING_BOUNDS)

    def at(q):
        return samples.histogram_quantile(found, q).withColumn("q", F.lit(q))

    return rounded(at(0.5).unionByName(at(0.95)).unionByName(at(0.99)), "quantile")


@query(
    "m7_topk",
    """
    SELECT l_partkey AS product, SUM(l_quantity) AS units FROM lineitem
    GROUP BY 1 ORDER BY units DESC, product LIMIT 10""",
)
def topk(t: Inputs):
    sold = t.table("lineitem").groupBy(F.col("l_partkey").alias("product")).agg(F.sum("l_quantity").alias("units"))
    return samples.topk(sold, "units", 10, ["product"])


@query(
    "m8_mean_latency",
    f"""
    SELECT event_type, ts,
           ROUND(SUM(grown) FILTER (WHERE metric = 'value_sum')
                 / NULLIF(SUM(grown) FILTER (WHERE metric = 'events_total'), 0), 9) AS mean_latency
    FROM ({_increase_sql(6, 6)}) i GROUP BY event_type, ts""",
)
def latency(t: Inputs):
    found = samples.mean_latency(t.samples, "value_sum", "events_total", "6 hours", ["event_type"])
    return rounded(found, "mean_latency")


@query(
    "m9_last_value",
    """
    SELECT 'events_total' AS metric, event_type, MAX(ts) AS ts, arg_max(events_total, ts) AS value
    FROM samples GROUP BY event_type
    UNION ALL
    SELECT 'value_sum', event_type, MAX(ts), arg_max(value_sum, ts) FROM samples GROUP BY event_type""",
)
def last(t: Inputs):
    return samples.last_value(t.samples, ["event_type"])


@query(
    "m10_status_distribution",
    """
    SELECT event_type AS status, COUNT(*) AS count,
           ROUND(100.0 * COUNT(*) / SUM(COUNT(*)) OVER (), 2) AS percentage
    FROM events GROUP BY 1""",
)
def distribution(t: Inputs):
    return samples.status_distribution(t.events.withColumnRenamed("event_type", "status"))


@query(
    "m11_table_view",
    """
    SELECT service AS "Service", error_type AS "Error Type", COUNT(*) AS "Errors"
    FROM dead_letters GROUP BY 1, 2""",
)
def table(t: Inputs):
    from tradewind.functions.scalars import service_of

    counted = t.dead_letters.groupBy(service_of("original_topic").alias("service"), "error_type").agg(
        F.count("*").alias("errors"), F.max("event_timestamp").alias("time")
    )
    return samples.table_view(
        counted, {"service": "Service", "error_type": "Error Type", "errors": "Errors"}
    )


@query(
    "j9_correlate",
    f"""
    SELECT COALESCE(a.ts, b.ts) AS ts, a.grown AS errors, b.grown AS purchases
    FROM (SELECT ts, grown FROM ({_increase_sql(1, 1)}) x
          WHERE metric = 'events_total' AND event_type = 'error') a
    FULL JOIN (SELECT ts, grown FROM ({_increase_sql(1, 1)}) y
               WHERE metric = 'events_total' AND event_type = 'purchase') b ON a.ts = b.ts""",
)
def correlated(t: Inputs):
    counted = t.samples.filter("metric = 'events_total'")

    def series(event_type, name):
        mine = samples.label_matches(counted, "event_type", event_type)
        return samples.increase(mine, "1 hour").select("ts", F.col("increase").alias(name))

    return samples.correlate(series("error", "errors"), series("purchase", "purchases"), ["ts"])


@query(
    "f11_label_matches",
    """
    SELECT event_type, COUNT(*) AS n FROM samples
    WHERE regexp_full_match(event_type, 'c.*|p.*') GROUP BY 1""",
)
def matching(t: Inputs):
    counted = t.samples.filter("metric = 'events_total'")
    found = samples.label_matches(counted, "event_type", "c.*|p.*")
    return found.groupBy(samples.label_of("event_type")).agg(F.count("*").alias("n"))


_SERIES = "CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id % 40 END"


@query(
    "m9_as_of_values",
    f"""
    WITH points AS (SELECT {_SERIES} AS k, ts, event_id FROM events WHERE event_type = 'click'
                    UNION ALL SELECT {_SERIES}, ts, -event_id FROM events WHERE event_type = 'purchase'),
    told AS (SELECT {_SERIES} AS k, ts, max(event_id) AS sample_id, arg_max(value, event_id) AS value FROM events
                WHERE event_type = 'purchase' AND {_SERIES} <> 7 GROUP BY 1, 2)
    SELECT k, event_id, ts, CASE WHEN fresh THEN sampled_at END AS as_of_ts, CASE WHEN fresh THEN sample_id END AS as_of_sample_id,
           CASE WHEN fresh THEN value END AS as_of_value
    FROM (SELECT p.*, s.ts AS sampled_at, s.sample_id, s.value, p.ts <= s.ts + INTERVAL 2 HOURS AS fresh
          FROM points p ASOF LEFT JOIN told s ON p.k = s.k AND p.ts >= s.ts) f""",
)
def as_of(t: Inputs):
    """The last purchase of a series at or before each click and at each purchase itself; one series is hot."""
    series = F.when(F.col("user_id") % 3 == 0, 0).otherwise(F.col("user_id") % 40).alias("k")
    bought = t.events.filter("event_type = 'purchase'")
    points = t.events.filter("event_type = 'click'").select(series, "event_id", "ts").union(bought.select(series, -F.col("event_id"), "ts"))
    sampled = bought.select(series, "ts", F.col("event_id").alias("sample_id"), "value").filter("k <> 7")
    return as_of_values(points, sampled, ["k"], "ts", ["sample_id", "value"], "2 hours", ["sample_id"])


@query(
    "j9_aligned_series",
    """
    WITH grid AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-28', INTERVAL 25 MINUTES)) AS ts),
    point AS (SELECT g.ts, e.event_type FROM grid g, (SELECT DISTINCT event_type FROM samples) e)
    SELECT p.ts, p.event_type, CASE WHEN p.ts <= s.ts + INTERVAL 90 MINUTES THEN s.events_total END AS events_total,
           CASE WHEN p.ts <= s.ts + INTERVAL 90 MINUTES THEN s.value_sum END AS value_sum
    FROM point p ASOF LEFT JOIN samples s ON p.event_type = s.event_type AND p.ts >= s.ts""",
)
def aligned(t: Inputs):
    """Two metrics side by side on one grid of times, each with its last sample of the last 90 minutes."""
    found = samples.aligned(t.samples, ["events_total", "value_sum"], "event_type", "2024-01-02", "2024-01-28", "25 minutes", "90 minutes")
    return found
