"""Declared schemas: event payloads by type, operational tables and result tables.

Nothing is inferred. A field marked NOT NULL is required of a producer; parsing still yields
nullable columns, and ``plans.dead_letters.split_valid`` is what enforces the requirement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values: event names, payload fields and table columns --------------------------

_BASE = (
    "event_id string not null, event_type string not null, "
    "timestamp string not null, correlation_id string not null"
)
_ITEM = "struct<product_id:string,quantity:int,price:double,item_total:double>"
_RESERVED_ITEM = "struct<product_id:string,quantity:int>"

_PAYLOAD = {
    "cart.item_added":
        "user_id string not null, product_id string not null, quantity int not null, "
        "price double not null",
    "cart.item_removed": "user_id string not null, product_id string not null",
    "cart.checkout_initiated":
        f"user_id string not null, items array<{_ITEM}> not null, total_amount double not null",
    "order.created":
        f"order_id string not null, user_id string not null, items array<{_ITEM}> not null, "
        "total_amount double not null",
    "order.reservation_confirmed":
        "order_id string not null, user_id string not null, total_amount double not null",
    "order.confirmed": "order_id string not null, user_id string not null",
    "order.cancelled":
        "order_id string not null, user_id string not null, reason string not null, "
        "cancellation_source string",
    "order.fulfilled":
        "order_id string not null, user_id string not null, tracking_number string, "
        "shipped_at string not null",
    "inventory.reserved":
        f"order_id string not null, items array<{_RESERVED_ITEM}>, product_id string, quantity int",
    "inventory.low":
        "product_id string not null, current_stock int not null, threshold int",
    "inventory.depleted": "order_id string not null, product_id string not null",
    "payment.processed":
        "payment_id string not null, order_id string not null, user_id string not null, "
        "amount double not null, currency string not null, method string not null",
    "payment.failed":
        "order_id string not null, user_id string not null, reason string not null",
    "notification.send":
        "user_id string not null, recipient_email string not null, "
        "notification_type string not null, data map<string,string> not null",
}

# Dead letters carry their own time in epoch seconds and the rejected payload as JSON text.
_DEAD_LETTER = (
    "event_id string, correlation_id string, original_topic string, original_event_type string, "
    "error_reason string, error_type string, retry_count int, payload string, timestamp double"
)

DEAD_LETTER_TOPIC = "dlq.events"
TOPICS = (*_PAYLOAD, DEAD_LETTER_TOPIC)
# The topics whose volume says whether the shop is alive: all but the dead letters.
JOURNEY_TOPICS = tuple(_PAYLOAD)

ITEM_ARRAY = f"array<{_ITEM}>"

ENVELOPE = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)

_TABLES = {
    "orders":
        "id string, order_id string, user_id string, correlation_id string, status string, "
        "items string, total_amount double, created_at timestamp, updated_at timestamp",
    "outbox_events":
        "id string, order_id string, event_type string, event_data string, published string, "
        "created_at timestamp, published_at timestamp",
    "processed_events":
        "id string, event_id string, event_type string, processed_at timestamp",
    "payments":
        "id string, payment_id string, order_id string, user_id string, amount double, "
        "currency string, method string, status string, reason string, created_at timestamp, "
        "updated_at timestamp",
    "products":
        "id string, product_id string, name string, description string, price double, "
        "stock int, version int, created_at timestamp, updated_at timestamp",
    "stock_reservations":
        "id string, order_id string, product_id string, quantity int, created_at timestamp",
    "cart_abandonment":
        "user_id string, product_id string, item_added_time timestamp, detected_at timestamp",
    "revenue_metrics":
        "window_start timestamp, window_end timestamp, total_revenue decimal(12,2), "
        "order_count int, avg_order_value decimal(12,2), created_at timestamp",
    "fraud_alerts":
        "alert_id string, alert_timestamp timestamp, user_id string, order_id string, "
        "alert_type string, severity string, details string, created_at timestamp",
    "inventory_velocity":
        "window_start timestamp, window_end timestamp, product_id string, units_sold int, "
        "revenue decimal(12,2), velocity_rank int",
    "operational_metrics":
        "window_start timestamp, window_end timestamp, topic string, metric_name string, "
        "metric_value decimal(12,2), threshold decimal(12,2), status string, "
        "services_checked string, created_at timestamp",
}

# The key that makes a replayed batch of each result table overwrite instead of duplicate.
RESULT_KEYS = {
    "revenue_metrics": ["window_start"],
    "fraud_alerts": ["alert_id"],
    "cart_abandonment": ["user_id", "product_id", "item_added_time"],
    "inventory_velocity": ["window_start", "product_id"],
    "operational_metrics": ["topic", "window_start"],
}

# -------------------------------------------------------------------------------------------

TABLE_NAMES = tuple(_TABLES)


def table_schema(table: str) -> T.StructType:
    """Columns of an operational or result table. Parsing the text needs a running session."""
    return T.StructType.fromDDL(_TABLES[table])


def schema_for(event_type: str) -> T.StructType:
    """Payload schema of an event type; an unknown type has only the fields all events share."""
    if event_type == DEAD_LETTER_TOPIC:
        return T.StructType.fromDDL(_DEAD_LETTER)
    payload = _PAYLOAD.get(event_type)
    return T.StructType.fromDDL(f"{_BASE}, {payload}" if payload else _BASE)


def pick(schema: T.StructType, fields: list[str] | None) -> T.StructType:
    """``schema`` cut down to ``fields``, so that JSON parsing skips the rest."""
    return schema if fields is None else T.StructType([schema[name] for name in fields])


# Columns that hold when a result row was produced.
_STAMPS = ("created_at", "detected_at")


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project ``df`` onto a stored table: its columns, order and types.

    Absent columns are null, except that a result row is stamped with the current time.
    """

    def column(field: T.StructField) -> Column:
        if field.name in df.columns:
            source = F.col(field.name)
        elif table in RESULT_KEYS and field.name in _STAMPS:
            source = F.current_timestamp()
        else:
            source = F.lit(None)
        return source.cast(field.dataType).alias(field.name)

    return df.select(*[column(field) for field in table_schema(table)])
