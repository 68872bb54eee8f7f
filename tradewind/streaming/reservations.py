"""Greedy reservation on a stream whose requests arrive out of order."""

from __future__ import annotations

from collections.abc import Iterator
from operator import itemgetter

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Groups of products that share their state. A checkpoint keeps the number it began with.
SHELVES = 1024
#: Most requests in one entry of the list state.
BLOCK = 10_000
#: Session settings for streams that hold many requests. A batch writes all that wait anew, so what the store has replaced
#: is dropped when the batch ends, and only two batches are kept to go back to. A started executor keeps its interval.
SETTINGS = {
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
    "spark.sql.streaming.stateStore.rocksdb.compactOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
}


class ReorderedReservations(StatefulProcessor):
    """Holds a shelf's stock and the requests the watermark has not passed, and decides them in order.

    A request is decided once the watermark is at or past its time, as no earlier one can come any more.
    Requests wait in list state; how many depends on the watermark's delay, not on the length of the stream.
    A call to the state store costs about as much as a thousand requests, so an entry is a block of requests,
    column by column, and blocks are only read when the timer of the shelf's first request, or a new one, is due.
    """

    def __init__(self, fields: list[str], columns: list[str], order: list[str], waiting: str, stock: str):
        self.columns, self.order = columns, [columns.index(name) for name in order]
        self.request = itemgetter(*[fields.index(name) for name in columns])
        self.waiting_schema, self.stock_schema = waiting, stock
        self.at, self.product, self.quantity = (columns.index(name) for name in ("at", "product_id", "quantity"))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.left = handle.getValueState("left", self.stock_schema)
        self.waiting = handle.getListState("waiting", self.waiting_schema)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.left.update((list(initialState.products), list(initialState.units)))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = [self.request(tuple(row)) for row in rows]
        timers = list(self.handle.listTimers())
        passed = timerValues.getCurrentWatermarkInMs()
        first = min(request[self.at] for request in new)
        if first <= passed * 1000 or any(timer <= passed for timer in timers):
            yield from self._decide(new, timers, timerValues)
            return
        self.waiting.appendList(self._blocks(new))
        self._wake(first, timers)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._decide([], list(self.handle.listTimers()), timerValues)

    def close(self) -> None:
        pass

    def _blocks(self, requests: list[tuple]) -> list[tuple]:
        return [tuple(list(column) for column in zip(*requests[i : i + BLOCK])) for i in range(0, len(requests), BLOCK)]

    def _wake(self, first: int, timers: list[int]) -> None:
        """One timer, for the first request that waits."""
        wanted = -(-first // 1000)
        if timers and min(timers) <= wanted:
            return
        for timer in timers:
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(wanted)

    def _decide(self, new: list[tuple], timers: list[int], timerValues) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        held = [request for block in self.waiting.get() for request in zip(*block)] if timers else []
        held += new
        later = [request for request in held if request[self.at] > passed]
        due = [request for request in held if request[self.at] <= passed]
        if later:
            self.waiting.put(self._blocks(later))
        elif timers:
            self.waiting.clear()
        if due:
            stock = dict(zip(*self.left.get())) if self.left.exists() else {}
            due.sort(key=itemgetter(*self.order))
            decided = Row(*self.columns, "accepted")
            for request in due:
                product, quantity, left = request[self.product], request[self.quantity], stock.get(request[self.product], 0)
                granted = 0 < (quantity or 0) <= left
                if granted:
                    stock[product] = left - quantity
                yield decided(*request, granted)
            if stock:
                self.left.update((list(stock), list(stock.values())))
        for timer in timers:
            self.handle.deleteTimer(timer)
        if later:
            self._wake(min(request[self.at] for request in later), [])


def reserve_as_they_come(
    requests: DataFrame,
    products: DataFrame,
    ties: tuple[str, ...] = ("order_id",),
    watermark: str = "10 minutes",
    shelves: int = SHELVES,
) -> DataFrame:
    """Decide each reservation of a stream in order of event time, then ``ties``; grants what stock covers.

    ``stock.reserve_greedy`` is the batch counterpart, with the same decisions for requests that are not later
    than the watermark. ``products`` (product_id, stock) opens the stock of a new checkpoint; unknown products
    have none. The result is product_id, event_timestamp, ``ties``, quantity and ``accepted``; ties and quantity
    must not be null. Requests of one product are decided by one task, as each depends on those before it.
    Products are dealt over ``shelves`` by hash: a task holds one shelf's waiting requests and stock at a time,
    so there should be more of them for more products. A checkpoint must keep its number.
    """
    if not isinstance(requests.schema["quantity"].dataType, T.IntegralType):
        raise TypeError("quantity must be of a whole-number type")
    columns = ["at", *ties, "quantity", "product_id"]
    shelf = F.pmod(F.xxhash64("product_id"), F.lit(shelves)).cast("int").alias("shelf")
    rows = requests.select(
        shelf, "product_id", F.unix_micros("event_timestamp").alias("at"), *ties, F.col("quantity").cast("bigint").alias("quantity"), "event_timestamp"
    ).filter("product_id is not null and event_timestamp is not null")
    types = {field.name: field.dataType.simpleString() for field in rows.schema}
    waiting = ", ".join(f"`{name}` array<{types[name]}>" for name in columns)
    decisions = ", ".join(f"`{name}` {types[name]}" for name in columns) + ", accepted boolean"
    stock = f"products array<{types['product_id']}>, units array<bigint>"
    opening = products.select(F.col("product_id").cast(types["product_id"]).alias("product_id"), F.col("stock").cast("bigint").alias("stock")).filter(
        "product_id is not null"
    )
    # Together, as a list of structs keeps products without stock.
    opened = opening.groupBy(shelf).agg(F.collect_list(F.struct("product_id", "stock")).alias("all"))
    opened = opened.select("shelf", F.col("all.product_id").alias("products"), F.col("all.stock").alias("units"))
    decided = (
        rows.withWatermark("event_timestamp", watermark)
        .groupBy("shelf")
        .transformWithState(
            ReorderedReservations(rows.columns, columns, ["at", *ties], waiting, stock), decisions,
            outputMode="Append", timeMode="EventTime", initialState=opened.groupBy("shelf"),
        )
    )
    return decided.select("product_id", F.timestamp_micros("at").alias("event_timestamp"), *ties, "quantity", "accepted")
