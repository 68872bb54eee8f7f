"""Time helpers. Every "last 24 hours" takes its instant as a parameter, never the wall clock."""

from __future__ import annotations

from datetime import datetime

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

Instant = datetime | str | Column


def as_column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def instant(as_of: Instant) -> Column:
    """A timestamp column from a datetime, an ISO text or a column."""
    column = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return column.cast("timestamp")


def micros(span: str) -> int:
    """Microseconds in a span such as ``30 minutes``."""
    return pd.Timedelta(span).value // 1000


def interval(span: str) -> Column:
    return F.expr(f"INTERVAL {span}")


def within_last(ts: Column | str, as_of: Instant, span: str) -> Column:
    """Whether ``ts`` is later than ``as_of`` minus ``span``; later than ``as_of`` counts too."""
    return as_column(ts) > instant(as_of) - interval(span)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed seconds as a double, with microseconds."""
    return (F.unix_micros(as_column(end)) - F.unix_micros(as_column(start))) / F.lit(1e6)


def slice_of(ts: Column | str, width: str) -> Column:
    """Start of the fixed-width slice of time that holds ``ts``, in epoch microseconds."""
    at = F.unix_micros(as_column(ts))
    return at - F.pmod(at, F.lit(micros(width)))
