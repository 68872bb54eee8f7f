"""Scalar expressions. All are JVM-side and stay inside whole-stage code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.timing import Instant, as_column, instant

# ---- fixed values ---------------------------------------------------------------------------
# URL path patterns that hide an id, applied in this order, and the placeholder of each.
PATH_RULES = (
    (r"/user_\d+", "/{user_id}"),
    (r"/(\d+)(?=/|$)", "/{id}"),
    (r"/(txn_|ref_|order_|payment_|invoice_)[a-zA-Z0-9_]+", "/{reference_id}"),
)
TRACKING_PREFIX = "TRK-"
TRACKING_DIGITS = 8
ID_DIGITS = 12
# ---------------------------------------------------------------------------------------------


def parse_json(value: Column | str, schema: T.StructType | str) -> Column:
    """Struct from a JSON text or its bytes; a field that is missing or unreadable is null."""
    return F.from_json(as_column(value).cast("string"), schema)


def parse_time(text: Column | str) -> Column:
    """Timestamp from ISO-8601 text with or without an offset; null when unreadable."""
    return F.try_to_timestamp(as_column(text))


def from_epoch_seconds(seconds: Column | str) -> Column:
    return F.timestamp_seconds(as_column(seconds))


def iso_text(ts: Column | str) -> Column:
    """ISO-8601 text with microseconds and the session's offset."""
    return F.date_format(as_column(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def epoch_key(key: Column | str, ts: Column | str) -> Column:
    """``<key>_<epoch second>``: the same row always gets the same id, also on a rerun."""
    return F.concat(as_column(key), F.lit("_"), F.unix_timestamp(as_column(ts)).cast("string"))


def derived_id(prefix: str, *keys: Column | str) -> Column:
    """``<prefix>`` and twelve hex digits derived from the keys, so a rerun yields the same id."""
    text = F.concat_ws("|", *[as_column(key).cast("string") for key in keys])
    return F.concat(F.lit(prefix), F.upper(F.substring(F.sha2(text, 256), 1, ID_DIGITS)))


def tracking_number(order_id: Column | str) -> Column:
    return F.concat(F.lit(TRACKING_PREFIX), F.right(as_column(order_id), F.lit(TRACKING_DIGITS)))


def whole_hours_since(ts: Column | str, as_of: Instant) -> Column:
    """Hours from ``ts`` to ``as_of``, rounded to the nearest whole hour."""
    elapsed = F.unix_micros(instant(as_of)) - F.unix_micros(as_column(ts))
    return F.round(elapsed / F.lit(3.6e9)).cast("int")


def seconds_since(ts: Column | str, as_of: Instant) -> Column:
    return (F.unix_micros(instant(as_of)) - F.unix_micros(as_column(ts))) / F.lit(1e6)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole`` rounded half up; null for an empty whole.

    The division is done in decimals, so that a tie such as 12.345 rounds the same everywhere.
    """
    share = F.try_divide(part.cast("decimal(20,0)") * F.lit(100), whole.cast("decimal(20,0)"))
    return F.round(share, digits).cast("double")


def label(value: Column | str, default: str, upper: bool = False) -> Column:
    """A label that is never empty: the value, or ``default`` for null and empty text."""
    column = as_column(value)
    shown = F.upper(column) if upper else column
    return F.when(F.length(column) > 0, shown).otherwise(F.lit(default))


def service_of(topic: Column | str) -> Column:
    """The service that owns a topic: the text before the first dot, else ``unknown``."""
    column = as_column(topic)
    return F.when(F.contains(column, F.lit(".")), F.substring_index(column, ".", 1)).otherwise(
        F.lit("unknown")
    )


def endpoint_template(path: Column | str) -> Column:
    """A URL path with its ids replaced by placeholders, so that paths can be grouped."""
    return reduce(
        lambda column, rule: F.regexp_replace(column, rule[0], rule[1]),
        PATH_RULES,
        as_column(path),
    )


def line_total(quantity: Column | str, price: Column | str) -> Column:
    return as_column(quantity) * as_column(price)


def with_line_totals(items: Column | str) -> Column:
    """The item array with each item's total set to quantity times price."""
    return F.transform(
        as_column(items),
        lambda item: item.withField("item_total", line_total(item["quantity"], item["price"])),
    )


def basket_total(items: Column | str) -> Column:
    """Sum of quantity times price over an item array; zero for an empty one."""
    return F.aggregate(
        as_column(items),
        F.lit(0.0),
        lambda total, item: total + line_total(item["quantity"], item["price"]),
    )


def basket_size(items: Column | str) -> Column:
    return F.size(as_column(items))


def preview(text: Column | str, length: int = 80) -> Column:
    """The opening characters of a text, for a listing that shows the whole text elsewhere."""
    return F.substring(as_column(text), 1, length)


def json_of(**fields: Column) -> Column:
    """JSON object text; a null field is left out."""
    return F.to_json(F.struct(*[column.alias(name) for name, column in fields.items()]))
