"""Alert rules over KPI values."""

from __future__ import annotations

from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Fires when the KPI is ``above`` (or, if not, below) the limit."""

    alert: str
    kpi: str
    above: bool
    limit: float
    severity: str


# ---- fixed values: the recommended rules ----------------------------------------------------
RULES = (
    Rule("high_fraud_rate", "fraud_alerts_per_hour", True, 10.0, "WARNING"),
    Rule("high_cart_abandonment", "cart_abandonment_rate", True, 60.0, "WARNING"),
    # Revenue of the last day divided by the average day.
    Rule("revenue_anomaly", "revenue_vs_average", False, 0.8, "WARNING"),
    Rule("dead_letters", "dlq_messages", True, 50.0, "WARNING"),
    Rule("dead_letters_critical", "dlq_messages", True, 100.0, "CRITICAL"),
)
# ---------------------------------------------------------------------------------------------


def evaluate_alerts(kpis: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Each rule with the value of its KPI and whether it fires.

    ``kpis`` holds (kpi, value). A rule without a value does not fire. Several values of one
    KPI, say one per service, are judged one by one.
    """
    # The rules are a list written in code, a few rows whatever the data.
    table = kpis.sparkSession.createDataFrame(
        [astuple(rule) for rule in rules],
        "alert string, kpi string, above boolean, limit double, severity string",
    )
    beyond = F.when(F.col("above"), F.col("value") > F.col("limit")).otherwise(
        F.col("value") < F.col("limit")
    )
    return (
        kpis.join(F.broadcast(table), "kpi", "right")
        .withColumn("firing", F.coalesce(beyond, F.lit(False)))
        .select("alert", "kpi", "value", "limit", "severity", "firing")
    )
