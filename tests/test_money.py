"""Money sums against Spark's own, where ten-thousandths cannot hold the amounts."""

import pytest
from pyspark.sql import functions as F

from tradewind.functions.money import money_avg, money_sum


@pytest.mark.parametrize(
    "amounts",
    [[1e15, 5.0], [0.00004] * 1000, [float("inf"), 5.0], [float("nan"), 5.0], [9e14, 9e14, 1.25], [None, None], [0.1, 0.2, None], [-3.5, 3.5], []],
)
def test_equal_to_plain_sum(spark, amounts):
    df = spark.createDataFrame([(a,) for a in amounts], "x double")
    ours, mean, total, avg = df.agg(money_sum("x"), money_avg("x"), F.sum("x"), F.avg("x")).first()
    assert ours == pytest.approx(total, rel=1e-12, nan_ok=True) if total is not None else ours is None
    assert mean == pytest.approx(avg, rel=1e-12, nan_ok=True) if avg is not None else mean is None


def test_usual_amounts_are_exact(spark):
    df = spark.range(10_000).selectExpr("0.1D x").repartition(7)
    assert df.agg(money_sum("x")).first()[0] == 1000.0
