"""Removing repeated deliveries of an event, in batch and in a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tradewind.operators.joins import EVENT_KEY
from tradewind.operators.ranking import first_per_key


def dedup_events(
    events: DataFrame, ts: str = "event_timestamp", delay: str = "10 minutes"
) -> DataFrame:
    """One row per (event_type, event_id).

    A batch keeps the earliest delivery. A stream keeps the first to arrive and forgets an id
    ``delay`` after its event time, which bounds the state.
    """
    if events.isStreaming:
        return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(EVENT_KEY)
    return first_per_key(events, EVENT_KEY, [ts])
