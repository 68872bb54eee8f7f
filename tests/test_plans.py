"""Physical plans: nothing compares all pairs, filters reach the scan, hot keys are split."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.inputs import Inputs
from tradewind.operators.hot import split_hot
from tradewind.operators.joins import having, lacking
from tradewind.plans import jobs, orders

SF_DIR = "/root/testdata/sf0.001"
BATCH_QUERIES = [name for name in entry.queries() if not name.startswith("t_")]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH_QUERIES)
def test_no_query_compares_all_pairs(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(jobs.revenue_by_window(Inputs(spark, SF_DIR).payments_made))
    assert "EqualTo(event_type,purchase)" in plan
    assert "ReadSchema: struct<ts:timestamp,event_type:string,value:double>" in plan


def test_ranks_are_limited_before_the_shuffle(spark):
    tables = Inputs(spark, SF_DIR)
    for df in (orders.first_payment(tables.payments), tables.velocity):
        plan = plan_of(df)
        assert "WindowGroupLimit" in plan
        assert plan.rindex("Partial") > plan.index("WindowGroupLimit")


def test_windows_are_aggregated_before_the_shuffle(spark):
    plan = plan_of(Inputs(spark, SF_DIR).alerts)
    assert plan.index("partial_max") > plan.index("Exchange hashpartitioning(user_id")


@pytest.fixture()
def small_partitions(spark):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def hot_items(spark, size=60_000):
    """A third of the items belong to one user and one half hour."""
    is_hot = F.col("id") % 3 == 0
    start = F.lit(datetime(2024, 1, 1)).cast("timestamp")
    return spark.range(0, size, 1, 4).select(
        F.when(is_hot, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 5000)).alias("user_id"),
        F.concat(F.lit("p"), F.col("id")).alias("product_id"),
        (start + F.make_dt_interval(secs=F.when(is_hot, F.col("id") % 600).otherwise(F.col("id")))).alias(
            "event_timestamp"
        ),
    )


def test_hot_user_is_split_in_the_abandonment_join(spark, small_partitions):
    items = hot_items(spark)
    checkouts = items.filter("user_id <> 'hot'").select("user_id", "event_timestamp")
    found = jobs.cart_abandonment(items, checkouts)
    assert found.groupBy().count().first()[0] == 20_000
    found.collect()
    assert "skew=true" in plan_of(found)


def test_hot_key_is_split_in_semi_and_anti_joins(spark, small_partitions):
    items = hot_items(spark)
    others = items.filter("user_id <> 'hot'").unionByName(items.filter("user_id = 'u1'"))
    for join, expected in ((lacking, 20_000), (having, 40_000)):
        found = join(items, others, ["user_id"])
        assert len(found.collect()) == expected
        assert "skew=true" in plan_of(found)


def test_hot_keys_are_told_from_usual_ones(spark):
    items = hot_items(spark, 3000)
    usual, hot = split_hot(items, ["user_id"], 500)
    assert usual.count() == 2000 and hot.select("user_id").distinct().count() == 1
    same, none = split_hot(items, ["user_id"], 1000)
    assert none is None and same.count() == 3000


def test_no_pairs_are_formed_for_a_busy_user(spark):
    start = datetime(2024, 1, 1)
    rows = [("u", "p", start + timedelta(seconds=i)) for i in range(2000)]
    items = spark.createDataFrame(rows, "user_id string, product_id string, event_timestamp timestamp")
    found = jobs.cart_abandonment(items, items.select("user_id", "event_timestamp"))
    assert found.count() == 0
