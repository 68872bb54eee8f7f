"""Sketches per window, merged into longer ones, against exact figures."""

from uuid import uuid4

from checks.inputs import Inputs
from checks.registry import query
from checks.streams import run_to_end
from pyspark.sql import functions as F
from tradewind.operators import sketches
from tradewind.session import stored

RANKS = [0.5, 0.95, 0.99]


def hourly(t: Inputs):
    hour = F.date_trunc("hour", "ts").alias("hour")
    return sketches.sketched(t.events, ["event_type", hour], ["user_id"], ["value"], ["props"])


@query(
    "a5_unique_users_by_day",
    """
    SELECT date_trunc('day', ts) AS day, COUNT(*) AS rows, COUNT(DISTINCT user_id) AS users, TRUE AS close
    FROM events GROUP BY 1""",
)
def unique_users(t: Inputs):
    """Users of a day, from the sketches of its hours and event types, next to the exact number."""
    day = F.date_trunc("day", "hour").alias("day")
    found = sketches.merged(hourly(t), [day]).select("day", "rows", sketches.distinct_count("user_id").alias("estimate"))
    exact = t.events.groupBy(F.date_trunc("day", "ts").alias("day")).agg(F.count_distinct("user_id").alias("users"))
    off = F.abs(F.col("estimate") - F.col("users"))
    return found.join(exact, "day").select("day", "rows", "users", (off <= F.col("users") * sketches.distinct_error()).alias("close"))


@query(
    "m6_quantiles_from_sketches",
    """
    SELECT event_type, q, COUNT(*) AS rows, TRUE AS close
    FROM events, (SELECT unnest([0.5, 0.95, 0.99]::DOUBLE[]) AS q) GROUP BY event_type, q""",
)
def quantiles(t: Inputs):
    """Several quantiles of each event type from one aggregate; the true rank of each must be close to what was asked."""
    whole = sketches.merged(hourly(t), ["event_type"])
    found = whole.select(
        "event_type", "rows", F.explode(F.arrays_zip(F.array(*[F.lit(q) for q in RANKS]).alias("q"), sketches.quantile_values("value", RANKS).alias("v"))).alias("z")
    ).select("event_type", "rows", "z.q", "z.v")
    near = t.events.join(F.broadcast(found), "event_type").groupBy("event_type", "q", "rows").agg(
        (F.count_if(F.col("value") < F.col("v")) / F.count("*")).alias("below"), (F.count_if(F.col("value") <= F.col("v")) / F.count("*")).alias("upto"))
    close = (F.col("below") - sketches.RANK_ERROR <= F.col("q")) & (F.col("upto") + sketches.RANK_ERROR >= F.col("q"))
    return near.select("event_type", "q", "rows", close.alias("close"))


@query(
    "m7_frequent_items",
    """
    SELECT event_type, props AS item, COUNT(*) AS count FROM events GROUP BY 1, 2""",
)
def frequent(t: Inputs):
    """There are fewer different items than a sketch tracks exactly, so all of them come with their counts."""
    whole = sketches.merged(hourly(t), ["event_type"])
    return whole.select("event_type", F.explode(sketches.top_items("props", 1000)).alias("z")).select("event_type", "z.item", "z.count")


@query(
    "t_stream_sketches",
    """
    SELECT date_trunc('day', ts) AS day, COUNT(*) AS rows, COUNT(DISTINCT user_id) AS users,
           COUNT(DISTINCT props) AS items, TRUE AS close
    FROM events WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT MAX(ts) - INTERVAL 10 SECONDS FROM events)
    GROUP BY 1""",
)
def streamed(t: Inputs):
    """A stream stores sketches of each hour that has closed; days are merged from what it stored."""
    timed = t.event_stream.withWatermark("ts", "10 seconds")
    windows = sketches.sketched(timed, [F.window("ts", "1 hour").alias("w")], ["user_id"], ["value"], ["props"])
    kept = run_to_end(t, windows.withColumn("hour", F.col("w.start")).drop("w"), f"sketches-{uuid4().hex}", ["hour"])
    day = F.date_trunc("day", "hour").alias("day")
    days = stored(sketches.merged(kept, [day]))
    exact = t.events.groupBy(F.date_trunc("day", "ts").alias("day"), F.date_trunc("hour", "ts").alias("hour"), "user_id").agg(F.count("*").alias("n"))
    users = exact.join(kept.select("hour"), "hour", "left_semi").groupBy("day").agg(F.count_distinct("user_id").alias("users"))
    close = F.abs(sketches.distinct_count("user_id") - F.col("users")) <= F.col("users") * sketches.distinct_error()
    return days.join(users, "day").select(
        "day", "rows", "users", F.size(sketches.top_items("props", 1000)).cast("long").alias("items"), close.alias("close"))
