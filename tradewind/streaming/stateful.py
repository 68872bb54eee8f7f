"""Streaming state that plain aggregates cannot hold: the current cart of each user."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tradewind.functions.timing import micros
from tradewind.plans.carts import CART_TTL, apply_change, cart_log

CART_CHANGES = (
    "user_id string, product_id string, quantity bigint, price double, item_total double, "
    "last_update timestamp"
)


class CartFold(StatefulProcessor):
    """Holds one user's cart and reports the cart's items whenever it changes.

    An empty cart is reported as one row without a product. A micro-batch is folded in order of
    event time, then id, so events may come unordered within a batch; events later than the
    watermark are dropped by Spark. Expiry is by event time: a change ``ttl`` or more after the
    one before finds an empty cart, and a timer empties a cart nobody changes any more.
    """

    def __init__(self, ttl_micros: int):
        self.ttl = ttl_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.items = handle.getMapState("items", "product_id string", "quantity bigint, price double")
        self.last = handle.getValueState("last", "micros bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = {product[0]: tuple(item) for product, item in self.items.iterator()}
        before = self.last.get()[0] if self.last.exists() else None
        cart, last = dict(held), before
        batch = pd.concat(list(rows), ignore_index=True)
        for event in batch.sort_values(["at", "event_id"]).itertuples():
            if last is not None and event.at >= last + self.ttl:
                cart.clear()
            if apply_change(cart, event.event_type, event.product_id, event.quantity, event.price):
                last = int(event.at)
        if (cart, last) == (held, before):
            return
        for product in held.keys() - cart.keys():
            self.items.removeKey((product,))
        for product, item in cart.items():
            if held.get(product) != item:
                self.items.updateValue((product,), (int(item[0]), float(item[1])))
        self.last.update((last,))
        self._schedule()
        yield self._report(key[0])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.items.clear()
        yield self._report(key[0])
        self.last.clear()

    def close(self) -> None:
        pass

    def _schedule(self) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer((self.last.get()[0] + self.ttl) // 1000)

    def _report(self, user_id: str) -> pd.DataFrame:
        at = pd.Timestamp(self.last.get()[0], unit="us")
        items = [
            (user_id, product[0], quantity, price, quantity * price, at)
            for product, (quantity, price) in self.items.iterator()
        ]
        return pd.DataFrame(
            items or [(user_id, None, None, None, None, at)],
            columns=["user_id", "product_id", "quantity", "price", "item_total", "last_update"],
        ).astype({"quantity": "Int64", "price": "float64", "item_total": "float64"})


def cart_changes(events: DataFrame, ttl: str = CART_TTL, watermark: str = "10 minutes") -> DataFrame:
    """The cart of each user after every micro-batch that changes it, as a stream.

    ``carts.current_carts`` is the batch counterpart. State is kept per user in the RocksDB
    store and leaves with the cart.
    """
    return (
        cart_log(events).withWatermark("event_timestamp", watermark)
        .groupBy("user_id")
        .transformWithStateInPandas(
            CartFold(micros(ttl)), CART_CHANGES, outputMode="Update", timeMode="EventTime"
        )
    )
