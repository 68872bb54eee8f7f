"""Metric samples ``(ts, metric, labels, value)``: rates, ratios, histograms, last values.

A counter only grows, except that it restarts at zero with its process. Rates and increases add
up the growth between consecutive samples of a series, taking the whole value after a restart,
and count the growth at the later sample. Nothing is extrapolated to the edges of the range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.timing import Instant, instant, interval, micros
from tradewind.operators.ranking import highest, share_of_total
from tradewind.operators.slices import as_of_values, previous_row

# ---- fixed values: upper bounds of the duration histograms, in seconds ----------------------
HTTP_BOUNDS = (0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)
QUERY_BOUNDS = (0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0)
PROCESSING_BOUNDS = (0.1, 0.5, 1.0, 2.5, 5.0, 10.0)
RESERVATION_BOUNDS = (0.01, 0.05, 0.1, 0.5, 1.0, 5.0)
NOTIFICATION_BOUNDS = (0.1, 0.5, 1.0, 2.5, 5.0)
# ---------------------------------------------------------------------------------------------


def event_counters(events: DataFrame, labels: list[str]) -> DataFrame:
    """Events per combination of label values."""
    return events.groupBy(*labels).agg(F.count("*").alias("value"))


def label_of(name: str) -> Column:
    return F.try_element_at(F.col("labels"), F.lit(name)).alias(name)


def label_matches(samples: DataFrame, name: str, pattern: str) -> DataFrame:
    """Samples whose label matches the whole pattern."""
    return samples.filter(label_of(name).rlike(f"^(?:{pattern})$"))


def _series() -> Column:
    """The labels as one text, independent of their order in the map."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries("labels"))))


def growth(samples: DataFrame, width: str = "1 day") -> DataFrame:
    """Each sample with ``delta``, the growth since the previous sample of its series."""
    keyed = samples.withColumn("series", _series())
    compared = previous_row(keyed, ["metric", "series"], "ts", ["value"], width=width)
    value, before = F.col("value"), F.col("prev_value")
    delta = F.when(value < before, value).otherwise(value - before)
    return compared.withColumn("delta", delta).drop("series", "prev_value")


def increase(
    samples: DataFrame, window: str, by: list[str] = (), step: str | None = None
) -> DataFrame:
    """Growth of the counters over the trailing ``window``, added up by the labels ``by``.

    It is evaluated every ``step`` (default: the window itself). A sample at the very time of an
    evaluation belongs to it, one at the start of the window does not.
    """
    just_before = F.col("ts") - F.expr("INTERVAL 1 MICROSECOND")
    span = F.window(just_before, window, step or window).alias("span")
    return (
        growth(samples)
        .filter("delta is not null")
        .groupBy("metric", *[label_of(name) for name in by], span)
        .agg(F.sum("delta").alias("increase"))
        .withColumn("ts", F.col("span.end"))
        .drop("span")
    )


def rate(
    samples: DataFrame, window: str, by: list[str] = (), step: str | None = None
) -> DataFrame:
    """``increase`` per second."""
    seconds = micros(window) / 1e6
    grown = increase(samples, window, by, step)
    return grown.withColumn("rate", F.col("increase") / F.lit(seconds)).drop("increase")


def correlate(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Two series side by side, by service and time; a side without a point there is null."""
    return left.join(right, on, "full_outer")


def aligned(
    samples: DataFrame, metrics: list[str], by: str, start: Instant, end: Instant, step: str, within: str
) -> DataFrame:
    """``metrics`` side by side on a grid of times from ``start`` to ``end``, for each value of the label ``by``.

    At each time a metric has the value of its last sample then, or null if that is older than ``within``.
    """
    series = samples.filter(F.col("metric").isin(list(metrics))).select("metric", label_of(by), "ts", "value")
    times = F.sequence(instant(start), instant(end), interval(step))
    # The labels of a metric are few; times are made in the tasks.
    points = series.select("metric", by).distinct().withColumn("ts", F.explode(times))
    found = as_of_values(points, series, ["metric", by], "ts", ["value"], within)
    columns = [F.max(F.when(F.col("metric") == metric, F.col("as_of_value"))).alias(metric) for metric in metrics]
    return found.groupBy("ts", by).agg(*columns)


def success_pct(events: DataFrame, success: Column, by: list[str] = (), eps: float = 0.0) -> DataFrame:
    """Percentage of events for which ``success`` holds.

    ``eps`` is added to the divisor, which turns an empty share into zero instead of null.
    """
    share = F.try_divide(F.count_if(success) * F.lit(100.0), F.count("*") + F.lit(float(eps)))
    return events.groupBy(*by).agg(share.alias("success_pct"))


def buckets(
    durations: DataFrame, value: str, bounds: tuple[float, ...], by: list[str] = ()
) -> DataFrame:
    """Cumulative histogram: per upper bound ``le``, how many values are at most that.

    One pass counts all bounds, and the counts are then turned into rows.
    """
    upper = [*bounds, float("inf")]
    counts = [F.count_if(F.col(value) <= bound).alias(f"b{i}") for i, bound in enumerate(upper)]
    rows = [
        F.struct(F.lit(bound).alias("le"), F.col(f"b{i}").alias("count"))
        for i, bound in enumerate(upper)
    ]
    counted = durations.filter(F.col(value).isNotNull()).groupBy(*by).agg(*counts)
    return counted.select(*by, F.explode(F.array(*rows)).alias("row")).select(*by, "row.*")


def histogram_quantile(histogram: DataFrame, q: float, by: list[str] = ()) -> DataFrame:
    """The ``q`` quantile of each cumulative histogram, linear inside the bucket it falls in.

    The first bucket starts at zero. A quantile beyond the last finite bound is that bound; an
    empty histogram has none. The window holds one group's buckets, a fixed short list.
    """
    merged = histogram.groupBy(*by, "le").agg(F.sum("count").alias("count"))
    order = Window.partitionBy(*by).orderBy("le")
    whole = Window.partitionBy(*by)
    placed = (
        merged.withColumn("rank", F.max("count").over(whole) * F.lit(q))
        .withColumn("low", F.coalesce(F.lag("le").over(order), F.lit(0.0)))
        .withColumn("below", F.coalesce(F.lag("count").over(order), F.lit(0)))
    )
    inside = F.try_divide(F.col("rank") - F.col("below"), F.col("count") - F.col("below"))
    value = F.when(F.col("le") == float("inf"), F.col("low")).otherwise(
        F.col("low") + (F.col("le") - F.col("low")) * inside
    )
    reached = placed.filter((F.col("count") >= F.col("rank")) & (F.col("rank") > 0))
    return reached.groupBy(*by).agg(F.min_by(value, "le").alias("quantile"))


def topk(df: DataFrame, column: str, n: int = 10, ties: list[str] = ()) -> DataFrame:
    return highest(df, column, n, ties)


def mean_latency(
    samples: DataFrame,
    sum_metric: str,
    count_metric: str,
    window: str,
    by: list[str] = (),
    step: str | None = None,
) -> DataFrame:
    """Growth of the sum divided by growth of the count, over the trailing window."""
    wanted = samples.filter(F.col("metric").isin(sum_metric, count_metric))
    grown = increase(wanted, window, by, step)

    def total(metric: str) -> Column:
        return F.sum(F.when(F.col("metric") == metric, F.col("increase")))

    return grown.groupBy(*by, "ts").agg(
        F.try_divide(total(sum_metric), total(count_metric)).alias("mean_latency")
    )


def last_value(samples: DataFrame, by: list[str] = ()) -> DataFrame:
    """The newest sample of each metric and label combination."""
    return samples.groupBy("metric", *[label_of(name) for name in by]).agg(
        F.max_by("value", "ts").alias("value"), F.max("ts").alias("ts")
    )


def status_distribution(events: DataFrame, status: str = "status") -> DataFrame:
    counts = events.groupBy(status).agg(F.count("*").alias("count"))
    return share_of_total(counts, "count", "percentage")


def table_view(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The named columns, in that order and under their display names."""
    return df.select(*[F.col(column).alias(shown) for column, shown in names.items()])
