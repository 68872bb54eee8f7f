"""Scalar expressions, source views and joins that the larger queries do not show on their own."""

from uuid import uuid4

from checks.inputs import AS_OF, Inputs
from checks.registry import query
from pyspark.sql import functions as F
from tradewind.functions import scalars as s
from tradewind.operators.joins import contained_in, unmatched_within, zero_filled
from tradewind.plans.notifications import notifications
from tradewind.schemas import conform
from tradewind.session import durable_folder
from tradewind.sources.topics import Progress, decode, scan_files, topic_depth


@query(
    "s6_topic_depth",
    """
    SELECT event_type AS topic, CAST(user_id % 3 AS INTEGER) AS "partition", COUNT(*) AS messages,
           MIN(event_id) AS low_offset, MAX(event_id) + 1 AS high_offset
    FROM events GROUP BY 1, 2""",
)
def depth(t: Inputs):
    return topic_depth(t.envelope)


@query(
    "s5_two_scans",
    """
    SELECT event_type AS topic, CAST(user_id % 3 AS INTEGER) AS "partition", event_id AS "offset",
           CASE WHEN event_id < 5000 THEN 1 ELSE 2 END AS scan
    FROM events""",
)
def scans(t: Inputs):
    """A scan, records that come meanwhile, a scan that dies, and one more: each record is taken once."""
    folder = f"{durable_folder(t.spark)}/runs/scans-{uuid4().hex}"
    place = ["topic", "partition", "offset"]
    early, late = F.col("offset") < 5000, F.col("offset") >= 5000
    t.envelope.filter(early).write.parquet(f"{folder}/in")
    first = Progress(t.spark, f"{folder}/progress")
    taken = first.take(scan_files(t.spark, f"{folder}/in"))
    t.envelope.filter(late).write.mode("append").parquet(f"{folder}/in")
    taken.select(*place, F.lit(1).alias("scan")).write.parquet(f"{folder}/out/1")
    first.done()
    Progress(t.spark, f"{folder}/progress").take(scan_files(t.spark, f"{folder}/in"))
    second = Progress(t.spark, f"{folder}/progress")
    second.take(scan_files(t.spark, f"{folder}/in")).select(*place, F.lit(2).alias("scan")).write.parquet(f"{folder}/out/2")
    second.done()
    third = Progress(t.spark, f"{folder}/progress").take(scan_files(t.spark, f"{folder}/in")).select(*place, F.lit(3).alias("scan"))
    return t.spark.read.parquet(f"{folder}/out/1", f"{folder}/out/2").union(third)


@query(
    "s15_decode_payments",
    """
    SELECT CAST(user_id AS VARCHAR) AS user_id, 'ORD-' || event_id AS order_id, value AS amount,
           ts AS event_timestamp
    FROM events WHERE event_type = 'purchase'""",
)
def decoded(t: Inputs):
    """Payments written as JSON with a Los Angeles offset and read back through the schema."""
    local = F.date_format(F.from_utc_timestamp("ts", "America/Los_Angeles"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    payload = F.to_json(
        F.struct(
            F.col("user_id").cast("string").alias("user_id"),
            F.concat(F.lit("ORD-"), "event_id").alias("order_id"),
            F.col("value").alias("amount"),
            F.concat(local, F.lit("-08:00")).alias("timestamp"),
            F.lit("ignored").alias("unknown_field"),
        )
    )
    kind = F.when(F.col("event_type") == "purchase", "payment.processed").otherwise(F.col("event_type"))
    envelope = t.events.select(kind.alias("topic"), payload.cast("binary").alias("value"))
    return decode(envelope, "payment.processed", ["user_id", "order_id", "amount"])


@query(
    "p_order_scalars",
    f"""
    SELECT order_id, order_id || '_' || (epoch_us(updated_at) // 1000000) AS alert_key,
           'ORD-' || upper(substr(sha256(id || '|' || user_id), 1, 12)) AS derived_id,
           'TRK-' || right(order_id, 8) AS tracking_number,
           strftime(updated_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS iso_text,
           CAST(ROUND((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(updated_at)) / 3.6e9) AS INTEGER)
             AS age_hours,
           (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(updated_at)) / 1e6 AS age_seconds,
           date_trunc('hour', updated_at) AS hour,
           CASE WHEN status = 'PENDING' THEN 'UNKNOWN' ELSE status END AS shown_status
    FROM shop_orders""",
)
def order_scalars(t: Inputs):
    return t.orders.select(
        "order_id",
        s.epoch_key("order_id", "updated_at").alias("alert_key"),
        s.derived_id("ORD-", "id", "user_id").alias("derived_id"),
        s.tracking_number("order_id").alias("tracking_number"),
        s.iso_text("updated_at").alias("iso_text"),
        s.whole_hours_since("updated_at", AS_OF).alias("age_hours"),
        s.seconds_since("updated_at", AS_OF).alias("age_seconds"),
        F.date_trunc("hour", "updated_at").alias("hour"),
        s.label(F.when(F.col("status") != "PENDING", F.lower("status")), "UNKNOWN", upper=True).alias("shown_status"),
    )


@query(
    "p_basket_scalars",
    """
    SELECT id, quantity * amount AS line_total, 2 AS items,
           0.0::DOUBLE + quantity * amount + 1 * amount AS basket_total
    FROM lines""",
)
def baskets(t: Inputs):
    item = F.struct(F.col("quantity"), F.col("amount").alias("price"), F.lit(None).cast("double").alias("item_total"))
    single = F.struct(F.lit(1).alias("quantity"), F.col("amount").alias("price"), F.lit(None).cast("double").alias("item_total"))
    with_items = t.lines.select("id", F.array(item, single).alias("items"))
    filled = s.with_line_totals("items")
    return with_items.select(
        "id",
        filled[0]["item_total"].alias("line_total"),
        s.basket_size("items").alias("items"),
        s.basket_total("items").alias("basket_total"),
    )


@query(
    "p_text_scalars",
    r"""
    SELECT page_id,
           regexp_replace(regexp_replace(regexp_replace(
             path, '/user_\d+', '/{user_id}', 'g'),
             '/(\d+)(/|$)', '/{id}\2', 'g'),
             '/(txn_|ref_|order_|payment_|invoice_)[a-zA-Z0-9_]+', '/{reference_id}', 'g') AS endpoint,
           CASE WHEN contains(host, '.') THEN split_part(host, '.', 1) ELSE 'unknown' END AS service,
           substr(html, 1, 80) AS preview
    FROM (SELECT page_id, html, split_part(url, '/', 3) AS host,
                 '/shop/user_' || page_id || '/' || page_id || '/order_' || page_id || '/' || page_id
                   AS path
          FROM pages) p""",
)
def text(t: Inputs):
    ids = [F.lit("/shop/user_"), "page_id", F.lit("/"), "page_id", F.lit("/order_"), "page_id", F.lit("/"), "page_id"]
    return t.table("pages").select(
        "page_id",
        s.endpoint_template(F.concat(*ids)).alias("endpoint"),
        s.service_of(F.split_part("url", F.lit("/"), F.lit(3))).alias("service"),
        s.preview("html").alias("preview"),
    )


@query(
    "p30_notifications",
    """
    WITH all_events AS (
      SELECT id AS event_id, user_id, 'order.cancelled' AS kind, order_id AS about,
             cancellation_source AS cause
      FROM cancelled
      UNION ALL
      SELECT id, user_id, CASE status WHEN 'FULFILLED' THEN 'order.fulfilled' ELSE 'order.confirmed'
                          END, order_id, NULL
      FROM shop_orders WHERE rank <= 3
      UNION ALL SELECT 'x' || id, NULL, 'order.cancelled', order_id, NULL FROM shop_orders WHERE rank = 1
      UNION ALL SELECT id, NULL, CASE WHEN stock = 0 THEN 'inventory.depleted' ELSE 'inventory.low'
                                 END, product_id, NULL
      FROM products WHERE stock < 10)
    SELECT event_id, 'notification.send' AS event_type, '2024-02-01T00:00:00.000000+00:00' AS timestamp,
           'C' || event_id AS correlation_id, COALESCE(user_id, 'unknown') AS user_id,
           CASE WHEN kind NOT LIKE 'order.%' THEN 'admin@example.com'
                ELSE COALESCE(user_id || '@example.com', 'unknown@example.com') END AS recipient_email,
           kind AS notification_type,
           CASE WHEN event_id LIKE '%7' THEN '{"email_sent":"false","success":"false","processed":"true"}'
                ELSE '{"email_sent":"true","success":"true","processed":"true"}' END AS data,
           CASE WHEN kind = 'order.fulfilled' THEN COALESCE('TRK-' || event_id, 'N/A') END AS tracking_number,
           CASE WHEN kind = 'order.cancelled' THEN COALESCE(cause, 'Unknown reason') END AS reason,
           CASE WHEN cause = 'payment_failed' THEN 'Order Cancelled - Payment Failed #' || about
                WHEN cause = 'inventory_depleted' THEN 'Order Cancelled - Out of Stock #' || about
                WHEN kind = 'order.cancelled' THEN 'Order Cancelled #' || about
                WHEN kind = 'order.fulfilled' THEN 'Your Order is On the Way! Order #' || about
                WHEN kind = 'order.confirmed' THEN 'Order Confirmed #' || about
                WHEN kind = 'inventory.low' THEN 'Low Stock Alert: Product #' || about
                ELSE 'Out of Stock or Insufficient Stock Alert: Product #' || about END AS subject
    FROM all_events""",
)
def mails(t: Inputs):
    none = F.lit(None).cast("string")
    kind = F.when(F.col("status") == "FULFILLED", "order.fulfilled").otherwise("order.confirmed")
    cancelled = t.cancelled.select(
        F.col("id").alias("event_id"), "user_id", "order_id", none.alias("product_id"),
        F.lit("order.cancelled").alias("event_type"), "cancellation_source",
    )
    paid = t.orders.filter(F.substring("priority", 1, 1) <= "3").select(
        F.col("id").alias("event_id"), "user_id", "order_id", none.alias("product_id"),
        kind.alias("event_type"), none.alias("cancellation_source"),
    )
    low = t.products.filter("stock < 10").select(
        F.col("id").alias("event_id"), none.alias("user_id"), none.alias("order_id"), "product_id",
        F.when(F.col("stock") == 0, "inventory.depleted").otherwise("inventory.low").alias("event_type"),
        none.alias("cancellation_source"),
    )
    nobody = t.orders.filter(F.startswith("priority", F.lit("1"))).select(
        F.concat(F.lit("x"), "id").alias("event_id"), none.alias("user_id"), "order_id", none.alias("product_id"),
        F.lit("order.cancelled").alias("event_type"), none.alias("cancellation_source"),
    )
    events = cancelled.unionByName(paid).unionByName(low).unionByName(nobody).select(
        "*", F.concat(F.lit("C"), "event_id").alias("correlation_id"), F.concat(F.lit("TRK-"), "event_id").alias("tracking_number"),
        F.col("cancellation_source").alias("reason"),
    )
    mailed = notifications(events, "admin@example.com", "2024-02-01 00:00:00", ~F.endswith("event_id", F.lit("7")))
    return mailed.withColumn("data", F.to_json("data"))


@query(
    "j2_unmatched_within",
    """
    SELECT event_id FROM events e WHERE event_type = 'error' AND NOT EXISTS (
      SELECT 1 FROM events v WHERE v.event_type = 'view' AND v.user_id = e.user_id
      AND v.ts >= e.ts AND v.ts <= e.ts + INTERVAL 6 HOURS)""",
)
def unmatched(t: Inputs):
    errors = t.events.filter("event_type = 'error'").select("event_id", "user_id", "ts")
    views = t.events.filter("event_type = 'view'").select("user_id", F.col("ts").alias("seen"))
    return unmatched_within(errors, views, "user_id", "ts", "seen", "6 hours").select("event_id")


@query(
    "j6_contained_in",
    """
    SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS needle FROM customer c
    WHERE EXISTS (SELECT 1 FROM supplier s WHERE s.s_name LIKE '%' || c.c_custkey || '%')""",
)
def contained(t: Inputs):
    needles = t.table("customer").select(F.col("c_custkey").cast("string").alias("needle"))
    return contained_in(needles, "needle", t.table("supplier"), "s_name")


@query(
    "j7_zero_filled",
    """
    SELECT COALESCE(k, event_type) AS event_type, COALESCE(n, 0) AS n
    FROM (SELECT unnest(['click', 'refund']) AS k) x
    FULL JOIN (SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1) c ON x.k = c.event_type""",
)
def zeros(t: Inputs):
    counted = t.events.groupBy("event_type").agg(F.count("*").alias("n"))
    return zero_filled(counted, "event_type", "n", ["click", "refund"])


@query(
    "s8_conform_revenue",
    """
    SELECT window_start, window_end, CAST(total_revenue AS DOUBLE) AS total_revenue,
           CAST(order_count AS INTEGER) AS order_count
    FROM revenue""",
)
def conformed(t: Inputs):
    return conform(t.revenue, "revenue_metrics").drop("created_at", "avg_order_value")
