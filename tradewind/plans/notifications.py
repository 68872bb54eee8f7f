"""Which customer or administrator is told what about an event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.scalars import iso_text, label
from tradewind.functions.timing import Instant, instant

# ---- fixed values ---------------------------------------------------------------------------
NOTIFIED_TYPES = (
    "order.confirmed",
    "order.fulfilled",
    "order.cancelled",
    "inventory.low",
    "inventory.depleted",
)
CUSTOMER_DOMAIN = "example.com"
NO_RECIPIENT = "unknown@example.com"
SENT_TYPE = "notification.send"
SUBJECTS = {
    "order.confirmed": "Order Confirmed #%s",
    "order.fulfilled": "Your Order is On the Way! Order #%s",
    "order.cancelled": "Order Cancelled #%s",
    "inventory.low": "Low Stock Alert: Product #%s",
    "inventory.depleted": "Out of Stock or Insufficient Stock Alert: Product #%s",
}
CANCELLED_SUBJECTS = {
    "payment_failed": "Order Cancelled - Payment Failed #%s",
    "inventory_depleted": "Order Cancelled - Out of Stock #%s",
}
# ---------------------------------------------------------------------------------------------


def _subject() -> Column:
    """Subject by event type; a cancellation's depends on what caused it."""
    kind, cause = F.col("event_type"), F.col("cancellation_source")
    about = F.when(F.startswith(kind, F.lit("order.")), F.col("order_id")).otherwise(
        F.col("product_id")
    )
    subject = F.lit(None).cast("string")
    for event_type, text in SUBJECTS.items():
        subject = F.when(kind == event_type, F.format_string(text, about)).otherwise(subject)
    for source, text in CANCELLED_SUBJECTS.items():
        is_this = (kind == "order.cancelled") & (cause == source)
        subject = F.when(is_this, F.format_string(text, about)).otherwise(subject)
    return subject


def _text(flag: Column) -> Column:
    return F.when(flag, "true").otherwise("false")


def notifications(
    events: DataFrame, admin_email: str, as_of: Instant | None = None, sent: Column | None = None
) -> DataFrame:
    """One ``notification.send`` event per event that is worth a mail.

    Order events go to the customer, stock events to the administrator; without either, the recipient is a
    fixed unknown one. Mails are sent by others: ``sent`` says for which rows that worked (null: it did not;
    by default it did) and is told in ``data``. The time is ``as_of``, else now.
    """
    to_customer = F.startswith(F.col("event_type"), F.lit("order."))
    address = F.when(to_customer, F.concat(F.col("user_id"), F.lit(f"@{CUSTOMER_DOMAIN}"))).otherwise(F.lit(admin_email))
    recipient = F.coalesce(address, F.lit(NO_RECIPIENT))
    worked = _text(F.lit(True) if sent is None else F.coalesce(sent, F.lit(False)))
    now = F.current_timestamp() if as_of is None else instant(as_of)
    return events.filter(F.col("event_type").isin(list(NOTIFIED_TYPES))).select(
        "event_id",
        F.lit(SENT_TYPE).alias("event_type"),
        iso_text(now).alias("timestamp"),
        "correlation_id",
        label("user_id", "unknown").alias("user_id"),
        recipient.alias("recipient_email"),
        F.col("event_type").alias("notification_type"),
        F.create_map(F.lit("email_sent"), worked, F.lit("success"), worked, F.lit("processed"), F.lit("true")).alias("data"),
        _subject().alias("subject"),
        F.when(
            F.col("event_type") == "order.fulfilled", label("tracking_number", "N/A")
        ).alias("tracking_number"),
        F.when(F.col("event_type") == "order.cancelled", label("reason", "Unknown reason")).alias(
            "reason"
        ),
    )
