"""Current carts folded from the cart event log, without collecting any user's events."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.scalars import line_total
from tradewind.functions.timing import Instant, instant, interval, micros, slice_of

# ---- fixed values ---------------------------------------------------------------------------
ADDED, REMOVED, CHECKED_OUT = "cart.item_added", "cart.item_removed", "cart.checkout_initiated"
# A changed quantity is a repository write without an event of its own; feed it as this type.
QUANTITY_SET = "cart.quantity_set"
CART_TTL = "24 hours"
# ---------------------------------------------------------------------------------------------


def _position() -> Column:
    return F.struct("event_timestamp", "event_id")


def _when_type(*types: str) -> Column:
    return F.col("event_type").isin(*types)


def cart_log(events: DataFrame) -> DataFrame:
    """The changes to carts, in the form both folds read; ``at`` is the time in microseconds.

    A missing quantity adds nothing and sets nothing.
    """
    unset = _when_type(QUANTITY_SET) & F.col("quantity").isNull()
    return events.filter(_when_type(ADDED, REMOVED, CHECKED_OUT, QUANTITY_SET) & ~unset).select(
        "event_id",
        "event_type",
        "user_id",
        "product_id",
        F.coalesce("quantity", F.lit(0)).cast("bigint").alias("quantity"),
        F.coalesce(F.col("price").cast("double"), F.lit(0.0)).alias("price"),
        F.unix_micros("event_timestamp").alias("at"),
        "event_timestamp",
    )


def apply_change(cart: dict, kind: str, product: str, quantity: int, price: float) -> bool:
    """Change ``cart`` (product to quantity and price) and tell whether that had an effect.

    Removing or setting what is not in the cart has none, nor has a negative quantity to set.
    """
    if kind == CHECKED_OUT:
        cart.clear()
    elif kind == ADDED:
        held = cart.get(product)
        cart[product] = (held[0] + quantity, held[1]) if held else (quantity, price)
    elif product not in cart or (kind == QUANTITY_SET and quantity < 0):
        return False
    elif kind == REMOVED or quantity == 0:
        del cart[product]
    else:
        cart[product] = (quantity, cart[product][1])
    return True


def _cart_starts(log: DataFrame, as_of: Instant, ttl: str) -> DataFrame:
    """Per user: a position before which nothing is left in the cart.

    That is the last checkout, or the last event that comes ``ttl`` or more after the one
    before. Such a gap cannot lie inside a slice as wide as ``ttl``, so it is found by comparing
    the first event of a slice with the last event of the slice before it.
    """
    per_slice = log.groupBy(
        "user_id", slice_of("event_timestamp", ttl).alias("slice")
    ).agg(
        F.min(_position()).alias("first"),
        F.max("event_timestamp").alias("last"),
        F.max(F.when(_when_type(CHECKED_OUT), _position())).alias("checkout"),
    )
    before = F.lag("last").over(Window.partitionBy("user_id").orderBy("slice"))
    expired = F.col("first.event_timestamp") >= F.col("before") + interval(ttl)
    return (
        per_slice.withColumn("before", before)
        .groupBy("user_id")
        .agg(
            F.max(F.greatest("checkout", F.when(expired, F.col("first")))).alias("start"),
            F.max("last").alias("last"),
        )
        .filter(F.col("last") + interval(ttl) > instant(as_of))
        .select("user_id", "start")
    )


def current_carts(events: DataFrame, as_of: Instant, ttl: str = CART_TTL) -> DataFrame:
    """Items in each living cart as of an instant.

    Adding again raises the quantity and keeps the first price; setting a quantity replaces it;
    removing, or setting zero, forgets the product; a checkout, or ``ttl`` without a change,
    empties the cart. What has no effect (``apply_change``) does not prolong a cart's life
    either. Events are ordered by time, then id.

    Whether an event has an effect depends on all before it, so a cart is folded in order. But
    nothing before the last checkout or gap matters: that is found by aggregates that combine
    before the shuffle, and only what comes after is sorted and folded, batch by batch, with one
    cart in memory.
    """
    log = cart_log(events).filter(F.col("event_timestamp") <= instant(as_of))
    columns = ["user_id", "event_type", "product_id", "quantity", "price", "at"]
    arranged = (
        log.join(_cart_starts(log, as_of, ttl), "user_id")
        .filter(F.col("start").isNull() | (_position() >= F.col("start")))
        .repartition("user_id")
        .sortWithinPartitions("user_id", "event_timestamp", "event_id")
        .select(*columns)
    )
    schema = T.StructType(
        [
            log.schema["user_id"],
            log.schema["product_id"],
            T.StructField("quantity", T.LongType()),
            T.StructField("price", T.DoubleType()),
            T.StructField("changed", T.LongType()),
        ]
    )
    width = micros(ttl)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        user, cart, changed = None, {}, None

        def items() -> list[tuple]:
            return [(user, product, held[0], held[1], changed) for product, held in cart.items()]

        for batch in batches:
            found = []
            for who, kind, product, quantity, price, at in zip(*(batch[column] for column in columns)):
                if who != user:
                    found += items()
                    user, cart, changed = who, {}, None
                if changed is not None and at >= changed + width:
                    cart.clear()
                if apply_change(cart, kind, product, quantity, price):
                    changed = at
            yield pd.DataFrame(found, columns=schema.names)
        yield pd.DataFrame(items(), columns=schema.names)

    return (
        arranged.mapInPandas(fold, schema)
        .withColumn("last_update", F.timestamp_micros("changed"))
        .filter(F.col("last_update") + interval(ttl) > instant(as_of))
        .select(
            "user_id",
            "product_id",
            "quantity",
            "price",
            line_total("quantity", "price").alias("item_total"),
            "last_update",
        )
    )


def cart_totals(carts: DataFrame) -> DataFrame:
    """Number of items and total amount of each cart."""
    return carts.groupBy("user_id").agg(
        F.count("*").alias("item_count"), F.sum("item_total").alias("total_amount")
    )


def cart_ttl(carts: DataFrame, as_of: Instant, ttl: str = CART_TTL) -> DataFrame:
    """Living carts and the whole seconds until each expires."""
    left = F.unix_micros(F.max("last_update")) + F.lit(micros(ttl)) - F.unix_micros(instant(as_of))
    return carts.groupBy("user_id").agg(
        F.count("*").alias("item_count"),
        F.floor(left / F.lit(1_000_000)).alias("ttl_seconds"),
    )
