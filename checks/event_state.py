"""Order log, carts and stock."""

from uuid import uuid4

from checks.inputs import ORDERS_AS_OF, Inputs
from checks.registry import query
from pyspark.sql import functions as F
from tradewind.operators.dedup import dedup_events
from tradewind.operators.joins import not_yet_processed
from tradewind.plans import carts, orders, stock
from tradewind.session import durable_folder
from tradewind.sources.outbox import publish_pending
from tradewind.sources.sinks import to_topic

CARTS_AS_OF = "2024-01-20 12:00:00"


@query(
    "r1_dedup_events",
    """
    SELECT event_type, CAST(event_id AS VARCHAR) AS event_id, ts AS event_timestamp FROM events""",
)
def dedup(t: Inputs):
    return dedup_events(t.deliveries)


@query(
    "r2_order_status",
    """
    SELECT order_id, status, ts AS updated_at FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY step DESC, ts DESC) AS n
      FROM status_log) s
    WHERE n = 1""",
)
def status(t: Inputs):
    return orders.order_status(t.order_log)


@query(
    "r3_lifecycle_violations",
    """
    SELECT order_id, ts AS event_timestamp, before AS prev_status, status,
           CASE WHEN status = 'CANCELLED' THEN 'UNEXPECTED' ELSE 'REGRESSION' END AS violation
    FROM (
      SELECT *, LAG(status) OVER o AS before, LAG(step) OVER o AS step_before
      FROM status_log WINDOW o AS (PARTITION BY order_id ORDER BY ts, event_id)) s
    WHERE status = 'CANCELLED' OR step < step_before OR (step_before = 3 AND status <> before)""",
)
def violations(t: Inputs):
    path = ("PENDING", "RESERVATION_CONFIRMED", "PAID", "FULFILLED")
    return orders.lifecycle_violations(t.order_log, expected=path)


@query(
    "r4_order_durations",
    """
    SELECT order_id, created_at, paid_at,
           (epoch_us(paid_at) - epoch_us(created_at)) / 1e6 AS duration_seconds
    FROM (SELECT order_id, MIN(ts) FILTER (WHERE event_type = 'order.created') AS created_at,
                 MIN(ts) FILTER (WHERE event_type = 'payment.processed') AS paid_at
          FROM order_log GROUP BY order_id) d
    WHERE created_at IS NOT NULL AND paid_at IS NOT NULL""",
)
def durations(t: Inputs):
    return orders.order_durations(t.order_log)


@query(
    "r5_saga_outcomes",
    """
    SELECT split_part(event_type, '.', 1) AS step,
           CASE WHEN event_type IN ('inventory.reserved', 'payment.processed') THEN 'success'
                ELSE 'failed' END AS status,
           COUNT(*) AS count,
           CASE WHEN event_type IN ('inventory.reserved', 'payment.processed') THEN 0
                ELSE COUNT(*) END AS compensations
    FROM order_log WHERE event_type NOT LIKE 'order.%' GROUP BY event_type""",
)
def outcomes(t: Inputs):
    return orders.saga_outcomes(t.order_log)


# The log folded event by event, as the shop's own cart store does.
CARTS = f"""
    WITH RECURSIVE log AS (
      SELECT user_id, kind, product_id, CAST(quantity AS BIGINT) AS quantity, price, ts,
             ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
      FROM cart_log WHERE ts <= TIMESTAMP '{CARTS_AS_OF}'
    ), fold AS (
      SELECT user_id, CAST(0 AS BIGINT) AS n, CAST(NULL AS TIMESTAMP) AS changed,
             CAST([] AS STRUCT(product_id VARCHAR, quantity BIGINT, price DOUBLE)[]) AS cart
      FROM log WHERE n = 1
      UNION ALL
      SELECT user_id, n,
             CASE WHEN kind IN ('add', 'checkout') OR (present AND NOT (kind = 'set' AND quantity < 0))
                  THEN ts ELSE changed END,
             CASE WHEN kind = 'checkout' THEN []
                  WHEN kind = 'add' AND NOT present
                  THEN list_append(held, struct_pack(product_id := product_id, quantity := quantity, price := price))
                  WHEN NOT present OR (kind = 'set' AND quantity < 0) THEN held
                  WHEN kind = 'remove' OR (kind = 'set' AND quantity = 0)
                  THEN list_filter(held, lambda x: x.product_id <> product_id)
                  ELSE list_transform(held, lambda x: struct_pack(product_id := x.product_id, quantity :=
                         CASE WHEN x.product_id <> product_id THEN x.quantity
                              WHEN kind = 'set' THEN quantity ELSE x.quantity + quantity END, price := x.price))
             END
      FROM (SELECT *, list_contains(list_transform(held, lambda x: x.product_id), product_id) AS present
            FROM (SELECT l.*, f.changed,
                         CASE WHEN l.ts >= f.changed + INTERVAL 24 HOURS THEN [] ELSE f.cart END AS held
                  FROM fold f JOIN log l ON l.user_id = f.user_id AND l.n = f.n + 1) opened) seen
    ), carts AS (
      SELECT user_id, item.product_id AS product_id, item.quantity AS quantity, item.price AS price,
             changed AS last_update
      FROM (SELECT f.user_id, f.changed, unnest(f.cart) AS item
            FROM fold f JOIN (SELECT user_id, MAX(n) AS n FROM log GROUP BY user_id) l
              ON f.user_id = l.user_id AND f.n = l.n
            WHERE f.changed + INTERVAL 24 HOURS > TIMESTAMP '{CARTS_AS_OF}') living
    )"""


@query(
    "r6_current_carts",
    f"""{CARTS}
    SELECT user_id, product_id, quantity, price, quantity * price AS item_total, last_update
    FROM carts""",
)
def current(t: Inputs):
    return carts.current_carts(t.cart_log, CARTS_AS_OF)


@query(
    "r17_cart_ttl",
    f"""{CARTS}
    SELECT user_id, COUNT(*) AS item_count,
           CAST(floor((epoch_us(MAX(last_update)) + 86400000000
                 - epoch_us(TIMESTAMP '{CARTS_AS_OF}')) / 1000000) AS BIGINT) AS ttl_seconds
    FROM carts GROUP BY user_id""",
)
def ttl(t: Inputs):
    return carts.cart_ttl(carts.current_carts(t.cart_log, CARTS_AS_OF), CARTS_AS_OF)


@query(
    "r6_cart_totals",
    f"""{CARTS}
    SELECT user_id, COUNT(*) AS item_count, ROUND(SUM(quantity * price), 4) AS total_amount
    FROM carts GROUP BY user_id""",
)
def totals(t: Inputs):
    found = carts.cart_totals(carts.current_carts(t.cart_log, CARTS_AS_OF))
    return found.withColumn("total_amount", F.round("total_amount", 4))


MOVE_ORDER = ("move_id", "kind", "amount")


def ledger_of(t: Inputs, **options):
    known = t.moves.join(t.products.select("product_id"), "product_id", "left_semi")
    return stock.stock_ledger(t.products, known, MOVE_ORDER, **options)


LEDGER = "SELECT product_id, move_id, kind, ts AS event_timestamp, balance FROM ledger"


@query("r7_stock_ledger", LEDGER)
def ledger(t: Inputs):
    return ledger_of(t).select("product_id", "move_id", "kind", "event_timestamp", "balance")


@query("r7_stock_ledger_hot_products", LEDGER)
def ledger_hot(t: Inputs):
    """Other slices, the same balances."""
    found = ledger_of(t, width="1 day")
    return found.select("product_id", "move_id", "kind", "event_timestamp", "balance")


@query(
    "r8_low_stock_alerts",
    """
    SELECT product_id, ts AS event_timestamp, balance AS current_stock, 10 AS threshold
    FROM ledger WHERE kind = 'reserved' AND balance < 10""",
)
def low(t: Inputs):
    return stock.low_stock_alerts(ledger_of(t))


GREEDY = """
    WITH RECURSIVE requests AS (
      SELECT l.product_id, l.id, l.amount, l.created_at, l.quantity, p.stock,
             ROW_NUMBER() OVER (PARTITION BY l.product_id
                                ORDER BY l.created_at, l.id, l.amount) AS n
      FROM lines l JOIN products p ON l.product_id = p.product_id
    ), fold AS (
      SELECT product_id, id, amount, created_at, quantity, n, quantity <= stock AS accepted,
             CASE WHEN quantity <= stock THEN stock - quantity ELSE stock END AS remaining
      FROM requests WHERE n = 1
      UNION ALL
      SELECT r.product_id, r.id, r.amount, r.created_at, r.quantity, r.n,
             r.quantity <= f.remaining,
             CASE WHEN r.quantity <= f.remaining THEN f.remaining - r.quantity
                  ELSE f.remaining END
      FROM fold f JOIN requests r ON r.product_id = f.product_id AND r.n = f.n + 1
    )
    SELECT product_id, id, amount, created_at AS event_timestamp, quantity, accepted FROM fold"""


def greedy_of(t: Inputs, **options):
    requests = t.lines.select(
        "product_id", "id", "amount", F.col("created_at").alias("event_timestamp"), "quantity"
    )
    return stock.reserve_greedy(t.products, requests, ties=("id", "amount"), **options)


@query("r9_reserve_greedy", GREEDY)
def greedy(t: Inputs):
    return greedy_of(t)


@query("r9_reserve_greedy_hot_products", GREEDY)
def greedy_hot(t: Inputs):
    """Every product treated as a hot one."""
    return greedy_of(t, hot_above=0, width="1 day")


@query(
    "r10_stock_to_release",
    """
    SELECT r.product_id, CAST(SUM(r.quantity) AS BIGINT) AS quantity
    FROM reservations r JOIN cancelled c ON r.order_id = c.order_id
    WHERE c.cancellation_source = 'payment_failed' GROUP BY r.product_id""",
)
def release(t: Inputs):
    return orders.stock_to_release(t.cancelled, t.reservations)


@query(
    "r11_leaked_reservations",
    """
    SELECT r.order_id, r.product_id, CAST(SUM(r.quantity) AS BIGINT) AS quantity
    FROM reservations r JOIN cancelled c ON r.order_id = c.order_id
    WHERE c.cancellation_source = 'inventory_depleted' GROUP BY 1, 2""",
)
def leaked(t: Inputs):
    return orders.leaked_reservations(t.cancelled, t.reservations)


@query(
    "r12_publish_outbox_records",
    "SELECT event_type AS topic, order_id AS key, event_data AS value FROM outbox WHERE published = 'N'",
)
def outbox_records(t: Inputs):
    return orders.publish_outbox(t.outbox, "2024-02-01 00:00:00")[0]


@query(
    "r12_publish_outbox_marked",
    """
    SELECT id, order_id, event_type, 'Y' AS published,
           TIMESTAMP '2024-02-01 00:00:00' AS published_at
    FROM outbox WHERE published = 'N'""",
)
def outbox_marked(t: Inputs):
    marked = orders.publish_outbox(t.outbox, "2024-02-01 00:00:00")[1]
    return marked.select("id", "order_id", "event_type", "published", "published_at")


@query(
    "r12_publish_after_a_crash",
    """
    SELECT event_type AS topic, order_id AS key, event_data AS value, 'Y' AS published
    FROM outbox WHERE published = 'N'""",
)
def outbox_crash(t: Inputs):
    """The first publisher dies after sending; the second one sees more pending rows. Each row is sent once."""
    folder = f"{durable_folder(t.spark)}/runs/outbox-{uuid4().hex}"

    def send(records, name):
        records.write.mode("overwrite").parquet(f"{folder}/topic/batch={name}")

    def send_and_die(records, name):
        send(records, name)
        raise InterruptedError

    try:
        publish_pending(t.outbox.filter("event_type = 'click'"), f"{folder}/outbox", send_and_die, "2024-02-01 00:00:00")
    except InterruptedError:
        pass
    publish_pending(t.outbox, f"{folder}/outbox", send, "2024-02-01 00:00:00")
    marked = publish_pending(t.outbox, f"{folder}/outbox", send, "2024-02-01 00:00:00")
    sent = t.spark.read.parquet(f"{folder}/topic").drop("batch")
    # Every record sent has its row marked: orders are unique here.
    return sent.join(marked.select(F.col("order_id").alias("key"), "published"), "key", "left").select("topic", "key", "value", "published")


@query(
    "r13_first_payment",
    """
    SELECT order_id, payment_id, amount, created_at FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id
                                   ORDER BY created_at, payment_id, amount) AS n
      FROM payments) p
    WHERE n = 1""",
)
def first(t: Inputs):
    found = orders.first_payment(t.payments, ("payment_id", "amount"))
    return found.select("order_id", "payment_id", "amount", "created_at")


@query(
    "r14_fulfilment_candidates",
    f"""
    SELECT 'EVT-' || upper(substr(sha256('order.fulfilled|' || order_id), 1, 12)) AS event_id,
           'order.fulfilled' AS event_type,
           CASE WHEN rank = 1 THEN 'COR-' || upper(substr(sha256(order_id), 1, 12)) ELSE 'saga-' || id END AS correlation_id,
           strftime(TIMESTAMP '{ORDERS_AS_OF}', '%Y-%m-%dT%H:%M:%S.%f+00:00') AS timestamp, order_id, user_id,
           'TRK-' || right(order_id, 8) AS tracking_number,
           strftime(TIMESTAMP '{ORDERS_AS_OF}', '%Y-%m-%dT%H:%M:%S.%f+00:00') AS shipped_at
    FROM shop_orders
    WHERE status = 'PAID' AND updated_at <= TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL 5 SECONDS
    ORDER BY updated_at, order_id LIMIT 10""",
)
def candidates(t: Inputs):
    saga = F.when(~F.startswith("priority", F.lit("1")), F.concat(F.lit("saga-"), "id"))
    return orders.fulfilment_candidates(t.orders.withColumn("correlation_id", saga), ORDERS_AS_OF)


@query(
    "r15_refill_plan",
    """
    SELECT product_id, stock AS stock_before, stock + 50 AS stock, version + 1 AS version,
           50 AS quantity, TIMESTAMP '2024-02-01 00:00:00' AS updated_at
    FROM products WHERE stock < 20""",
)
def refill(t: Inputs):
    return stock.refill_plan(t.products, "2024-02-01 00:00:00")


@query(
    "r16_refill_summary",
    """
    SELECT COUNT(*) AS total_refills, CAST(COALESCE(SUM(50), 0) AS BIGINT) AS total_units_added,
           COUNT(DISTINCT product_id) AS products_refilled
    FROM products WHERE stock < 20""",
)
def summary(t: Inputs):
    return stock.refill_summary(stock.refill_plan(t.products, "2024-02-01 00:00:00"))


@query(
    "j8_not_yet_processed",
    """
    SELECT event_type, event_id, ts AS event_timestamp FROM order_log l
    WHERE NOT EXISTS (SELECT 1 FROM shop_orders o WHERE o.id = l.event_id
                      AND l.event_type = 'order.created' AND o.status = 'PENDING')""",
)
def unprocessed(t: Inputs):
    history = t.orders.filter("status = 'PENDING'").select(
        F.lit("order.created").alias("event_type"), F.col("id").alias("event_id")
    )
    return not_yet_processed(t.order_log, history).select("event_type", "event_id", "event_timestamp")


@query(
    "s13_to_topic",
    """
    SELECT 'order.' || lower(status) AS topic, user_id AS key, order_id, total_amount
    FROM shop_orders""",
)
def as_records(t: Inputs):
    rows = t.orders.select(
        F.concat(F.lit("order."), F.lower("status")).alias("topic"), "user_id", "order_id", "total_amount"
    )
    read_back = F.from_json("value", "order_id string, total_amount double")
    return to_topic(rows, key="user_id").select("topic", "key", read_back.alias("v")).select(
        "topic", "key", "v.order_id", "v.total_amount"
    )
