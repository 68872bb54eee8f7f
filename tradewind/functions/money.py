"""Money arithmetic that gives the same answer whatever order Spark adds the rows in.

Amounts arrive as doubles. A double sum depends on how rows were split over tasks, so a rerun
after a lost executor could store a different cent. Amounts with at most four decimals are
therefore added as whole ten-thousandths in a long, which is exact and as fast as adding doubles (a
decimal sum is more than ten times slower). If a group holds any other amount (more decimals, very
large, infinite or no number), or the long overflows, the group gets Spark's own sum or mean of doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = 10_000


def _parts(amount: Column | str) -> tuple[Column, Column]:
    """The amounts as doubles, and their sum in units; null if units cannot hold it exactly."""
    value = (F.col(amount) if isinstance(amount, str) else amount).cast("double")
    rounded = F.rint(value * F.lit(float(UNITS)))
    units = rounded.try_cast("bigint")
    exact = F.coalesce(units.isNotNull() & (rounded / F.lit(float(UNITS)) == value), F.lit(False)) | value.isNull()
    return value, F.when(F.bool_and(exact), F.try_sum(units))


def money_sum(amount: Column | str) -> Column:
    """Sum of the non-null amounts, null if there are none."""
    value, units = _parts(amount)
    return F.coalesce(units / F.lit(UNITS), F.sum(value))


def money_avg(amount: Column | str) -> Column:
    """Mean of the non-null amounts, null if there are none."""
    value, units = _parts(amount)
    return F.coalesce(F.try_divide(units / F.lit(UNITS), F.count(value)), F.avg(value))
