"""The relations of ``inputs.py`` in SQL, for the statements that check the queries."""

from __future__ import annotations


def money(column: str) -> str:
    """Sum of amounts with two digits, exact whatever the order of the rows."""
    return f"CAST(SUM(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


LATER = "epoch_ms(0) + to_microseconds(epoch_us({ts}) + CAST({micros} AS BIGINT))"

RELATIONS = {
    "payments_made": """
        SELECT CAST(user_id AS VARCHAR) AS user_id, value AS amount, ts
        FROM events WHERE event_type = 'purchase'""",
    "clicks": """
        SELECT CAST(user_id AS VARCHAR) AS user_id, value AS amount, ts,
               'PROD-' || json_extract_string(props, '$.k') AS product_id
        FROM events WHERE event_type = 'click'""",
    "processed": """
        SELECT CAST(event_id AS VARCHAR) AS id, CAST(event_id AS VARCHAR) AS event_id, event_type,
               ts AS processed_at
        FROM events""",
    "outbox": """
        SELECT CAST(event_id AS VARCHAR) AS id, 'ORD-' || event_id AS order_id, event_type,
               props AS event_data,
               CASE WHEN event_type IN ('click', 'view') THEN 'N' ELSE 'Y' END AS published,
               ts AS created_at
        FROM events""",
    "deliveries": """
        SELECT event_type, CAST(event_id AS VARCHAR) AS event_id, ts AS event_timestamp FROM events
        UNION ALL
        SELECT event_type, CAST(event_id AS VARCHAR), ts + INTERVAL 1 SECOND
        FROM events WHERE event_type = 'purchase'""",
    "cart_log": """
        SELECT event_id,
               CASE event_type WHEN 'click' THEN 'add' WHEN 'signup' THEN 'remove'
                    WHEN 'view' THEN 'set' ELSE 'checkout' END AS kind,
               CAST(user_id AS VARCHAR) AS user_id,
               'PROD-' || (CAST(json_extract_string(props, '$.k') AS INTEGER) // 25) AS product_id,
               CAST(floor(value / 20) AS INTEGER)
                 + CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS quantity,
               value AS price, ts
        FROM events WHERE event_type IN ('click', 'signup', 'view', 'purchase')""",
    "shop_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id, 'ORD-' || o_orderkey AS order_id,
               CAST(o_custkey AS VARCHAR) AS user_id,
               CASE o_orderstatus WHEN 'F' THEN 'FULFILLED' WHEN 'P' THEN 'PAID'
                    ELSE 'PENDING' END AS status,
               o_totalprice AS total_amount, o_orderdate AS created_at,
               """ + LATER.format(ts="o_orderdate", micros="floor(o_totalprice) * 10") + """ AS updated_at,
               CAST(o_orderpriority[1] AS INTEGER) AS rank
        FROM orders""",
    "lines": """
        SELECT l_orderkey || '-' || l_linenumber || '-' || l_suppkey || '-' || l_partkey || '-'
                 || CAST(l_quantity AS INTEGER) AS id,
               'ORD-' || l_orderkey AS order_id, 'PROD-' || l_partkey AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice AS amount,
               CASE WHEN l_linestatus = 'O' THEN 'card' ELSE 'transfer' END AS method,
               CASE WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               l_returnflag AS returnflag, l_shipdate AS created_at
        FROM lineitem""",
    "payments": "SELECT *, 'PAY-' || id AS payment_id FROM lines",
    "reservations": "SELECT id, order_id, product_id, quantity, created_at FROM lines",
    "products": """
        SELECT CAST(p_partkey AS VARCHAR) AS id, 'PROD-' || p_partkey AS product_id,
               p_name AS name, p_retailprice AS price, p_size AS stock, 1 AS version,
               TIMESTAMP '2024-01-01 00:00:00' + to_minutes(p_partkey) AS created_at
        FROM part""",
    "order_log": """
        SELECT o.id AS event_id, o.order_id, e.event_type,
               o.created_at + to_microseconds(CAST(e.delay AS BIGINT)) AS ts
        FROM shop_orders o,
        LATERAL (
          SELECT 'order.created' AS event_type, 0 AS delay, TRUE AS happens
          UNION ALL SELECT 'inventory.reserved', 2000000, o.rank < 5
          UNION ALL SELECT 'inventory.depleted', 2000000, o.rank = 5
          UNION ALL SELECT 'payment.processed', 3000000 + floor(o.total_amount) * 10, o.rank <= 3
          UNION ALL SELECT 'payment.failed', 3000000 + floor(o.total_amount) * 10, o.rank = 4
          UNION ALL SELECT 'order.fulfilled', 60000000, o.rank <= 3 AND o.status = 'FULFILLED'
          UNION ALL SELECT 'order.fulfilled', 1000000, o.rank <= 3 AND o.status = 'PAID'
        ) e
        WHERE e.happens""",
    "status_log": """
        SELECT order_id, event_id, ts,
               CASE event_type WHEN 'order.created' THEN 'PENDING'
                    WHEN 'inventory.reserved' THEN 'RESERVATION_CONFIRMED'
                    WHEN 'payment.processed' THEN 'PAID' WHEN 'order.fulfilled' THEN 'FULFILLED'
                    ELSE 'CANCELLED' END AS status,
               CASE event_type WHEN 'order.created' THEN 0 WHEN 'inventory.reserved' THEN 1
                    WHEN 'payment.processed' THEN 2 ELSE 3 END AS step
        FROM order_log""",
    "cancelled": """
        SELECT id, order_id, user_id,
               CASE rank WHEN 4 THEN 'payment_failed' ELSE 'inventory_depleted' END
                 AS cancellation_source
        FROM shop_orders WHERE rank IN (4, 5)""",
    "moves": """
        SELECT product_id, id AS move_id, amount, 'reserved' AS kind, quantity, created_at AS ts
        FROM lines
        UNION ALL
        SELECT product_id, id, amount, 'released', quantity, created_at + INTERVAL 7 DAYS
        FROM lines WHERE returnflag = 'R'""",
    "ledger": """
        SELECT m.product_id, m.move_id, m.amount, m.kind, m.quantity, m.ts,
               CAST(p.stock + SUM(CASE m.kind WHEN 'reserved' THEN -m.quantity ELSE m.quantity END)
                 OVER (PARTITION BY m.product_id ORDER BY m.ts, m.move_id, m.kind, m.amount
                       ROWS UNBOUNDED PRECEDING) AS BIGINT) AS balance
        FROM moves m JOIN products p ON m.product_id = p.product_id""",
    "revenue": f"""
        SELECT date_trunc('hour', ts) AS window_start,
               date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
               {money("amount")} AS total_revenue, COUNT(*) AS order_count,
               {money("amount")} / COUNT(*) AS avg_order_value
        FROM payments_made GROUP BY 1, 2""",
    "user_windows": """
        SELECT user_id, w AS window_start, COUNT(*) FILTER (WHERE source = 'order') AS orders_seen,
               MAX(amount) AS largest, CAST(SUM(CASE WHEN source = 'payment' THEN 1 END) AS BIGINT) AS payments_seen
        FROM (
          SELECT user_id, amount, source,
                 time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') - to_hours(6 * back) AS w
          FROM (SELECT user_id, amount, ts, 'payment' AS source FROM payments_made
                UNION ALL SELECT user_id, amount, ts, 'order' FROM clicks) a,
               range(0, 4) AS b(back)
        ) x
        GROUP BY user_id, w""",
    "alerts": """
        SELECT user_id || '_' || CAST(epoch(window_start) AS BIGINT) AS alert_id,
               window_start AS alert_timestamp, user_id,
               CASE WHEN orders_seen > 2 THEN 'UNUSUAL_ORDER_FREQUENCY'
                    WHEN largest > 200 THEN 'HIGH_ORDER_VALUE'
                    WHEN payments_seen > 2 THEN 'MULTIPLE_PAYMENT_EVENTS' END AS alert_type,
               CASE WHEN orders_seen > 3 THEN 'CRITICAL' WHEN largest > 300 THEN 'CRITICAL'
                    WHEN payments_seen > 3 THEN 'CRITICAL' WHEN orders_seen > 2 THEN 'HIGH'
                    WHEN largest > 200 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
               orders_seen, largest, payments_seen
        FROM user_windows
        WHERE orders_seen > 2 OR largest > 200 OR payments_seen > 2""",
    "abandoned": """
        SELECT c.user_id, c.product_id, c.ts AS item_added_time,
               c.ts + INTERVAL 24 HOURS AS detected_at
        FROM clicks c
        WHERE NOT EXISTS (SELECT 1 FROM payments_made p WHERE p.user_id = c.user_id
                          AND p.ts >= c.ts AND p.ts <= c.ts + INTERVAL 12 HOURS)""",
    "velocity": f"""
        SELECT * FROM (
          SELECT *, DENSE_RANK() OVER (PARTITION BY window_start ORDER BY units_sold DESC)
                      AS velocity_rank
          FROM (
            SELECT o.created_at AS window_start, o.created_at + INTERVAL 1 DAY AS window_end,
                   l.product_id, CAST(SUM(l.quantity) AS BIGINT) AS units_sold, {money("l.amount")} AS revenue
            FROM shop_orders o JOIN lines l ON o.order_id = l.order_id
            WHERE o.status = 'FULFILLED' GROUP BY 1, 2, 3
          ) sold
        ) ranked
        WHERE velocity_rank <= 10""",
    "ops": """
        SELECT date_trunc('hour', ts) AS window_start,
               date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type AS topic,
               'throughput' AS metric_name, COUNT(*) AS metric_value, 4 AS threshold,
               CASE WHEN COUNT(*) > 3 THEN 'HEALTHY' WHEN COUNT(*) > 1 THEN 'WARNING'
                    ELSE 'CRITICAL' END AS status
        FROM events GROUP BY 1, 2, 3""",
    "dead_letters": """
        SELECT CAST(event_id AS VARCHAR) AS event_id,
               CASE WHEN k < 20 THEN 'cart.item_added' WHEN k < 40 THEN 'order.created'
                    WHEN k < 60 THEN 'payment.failed' WHEN k < 80 THEN 'inventory.low'
                    ELSE 'unrouted' END AS original_topic,
               CASE WHEN k < 20 THEN 'cart' WHEN k < 40 THEN 'order' WHEN k < 60 THEN 'payment'
                    WHEN k < 80 THEN 'inventory' ELSE 'unknown' END AS service,
               CASE WHEN value < 10 THEN 'TimeoutError' WHEN value < 50 THEN 'OperationalError'
                    ELSE 'ValueError' END AS error_type,
               'failed on ' || props AS error_reason, 3 AS retry_count, props AS payload,
               CAST(user_id % 3 AS INTEGER) AS "partition", event_id AS "offset", ts
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
              FROM events WHERE event_type = 'error') e""",
    "samples": """
        SELECT hour AS ts, event_type,
               CAST(SUM(n) OVER d AS DOUBLE) AS events_total,
               CAST(SUM(v) OVER d AS DOUBLE) AS value_sum
        FROM (SELECT event_type, date_trunc('hour', ts) AS hour, COUNT(*) AS n,
                     SUM(CAST(value AS DECIMAL(18,2))) AS v
              FROM events GROUP BY 1, 2) h
        WINDOW d AS (PARTITION BY event_type, date_trunc('day', hour) ORDER BY hour)""",
    "growth": """
        SELECT ts, event_type, events_total, value_sum,
               CASE WHEN events_total < LAG(events_total) OVER s THEN events_total
                    ELSE events_total - LAG(events_total) OVER s END AS d_events,
               CASE WHEN value_sum < LAG(value_sum) OVER s THEN value_sum
                    ELSE value_sum - LAG(value_sum) OVER s END AS d_value
        FROM samples WINDOW s AS (PARTITION BY event_type ORDER BY ts)""",
}
