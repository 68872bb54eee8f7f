"""The status of each order as a stream with state that ends: final orders leave the store."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tradewind.functions.timing import micros
from tradewind.plans.orders import FINAL_STEP, STEP_OF_STATUS, status_of

STATUS_CHANGES = "order_id string, status string, updated_at_micros bigint"


def furthest(times: dict[str, int]) -> tuple[str, int]:
    """The furthest status of those reached and the last time it was reported.

    Final statuses are one step: the later of them counts, and of two at one time the first listed.
    """
    ended = [name for name in times if STEP_OF_STATUS[name] == FINAL_STEP]
    if ended:
        last = max(times[name] for name in ended)
        return next(name for name in STEP_OF_STATUS if times.get(name) == last and name in ended), last
    status = max(times, key=STEP_OF_STATUS.__getitem__)
    return status, times[status]


class OrderState(StatefulProcessor):
    """Holds, for one order, the last time of each status, and reports changes of status or time.

    A final order leaves the store ``kept`` after its end, another one after ``idle`` without an event.
    Both are timers of event time. Spark drops events behind the watermark, so none can revive an order that
    left, as long as its events are not spread over more than ``kept``.
    """

    def __init__(self, kept_micros: int, idle_micros: int):
        self.kept, self.idle = kept_micros, idle_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.times = handle.getValueState("times", ", ".join(f"{name} bigint" for name in STEP_OF_STATUS))

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        if initialState.status in STEP_OF_STATUS:
            self._store({initialState.status: initialState.at})

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = self._held()
        times = dict(before)
        for row in rows:
            times[row.status] = max(row.at, times.get(row.status, row.at))
        if times == before:
            return
        self._store(times)
        now = furthest(times)
        if not before or furthest(before) != now:
            yield Row(order_id=key[0], status=now[0], updated_at_micros=now[1])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.times.clear()
        return iter(())

    def close(self) -> None:
        pass

    def _held(self) -> dict[str, int]:
        if not self.times.exists():
            return {}
        return {name: at for name, at in zip(STEP_OF_STATUS, self.times.get()) if at is not None}

    def _store(self, times: dict[str, int]) -> None:
        self.times.update(tuple(times.get(name) for name in STEP_OF_STATUS))
        status, at = furthest(times)
        leaves = at + self.kept if STEP_OF_STATUS[status] == FINAL_STEP else max(times.values()) + self.idle
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(leaves // 1000)


def order_status_changes(
    events: DataFrame,
    known: DataFrame | None = None,
    kept: str = "1 day",
    idle: str = "30 days",
    watermark: str = "1 hour",
) -> DataFrame:
    """Each order's status and when it got there, after every micro-batch that changes it, as a stream.

    ``orders.order_status`` is the batch counterpart. ``known`` (order_id, status, updated_at) is the state
    that a new checkpoint starts from, such as the table of orders; an unknown status there is ignored.
    Events without an order or of types that set no status are left out. ``kept`` is how long an order that
    ended is remembered against late events, ``idle`` how long one that has not ended may be silent.
    """
    steps = events.select(
        "order_id", status_of(F.col("event_type")).alias("status"), F.unix_micros("event_timestamp").alias("at"), "event_timestamp"
    ).filter("status is not null and order_id is not null")
    initial = None
    if known is not None:
        rows = known.select("order_id", "status", F.unix_micros("updated_at").alias("at")).filter("order_id is not null and at is not null")
        initial = rows.groupBy("order_id")
    changes = (
        steps.withWatermark("event_timestamp", watermark)
        .groupBy("order_id")
        .transformWithState(OrderState(micros(kept), micros(idle)), STATUS_CHANGES, outputMode="Update", timeMode="EventTime", initialState=initial)
    )
    return changes.withColumn("updated_at", F.timestamp_micros("updated_at_micros")).drop("updated_at_micros")
