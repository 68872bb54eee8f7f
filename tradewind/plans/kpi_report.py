"""The KPI snapshot over the result tables that jobs have stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradewind.functions.timing import Instant
from tradewind.plans.kpis import snapshot
from tradewind.schemas import RESULT_KEYS, table_schema
from tradewind.session import stored
from tradewind.sources.files import Folder
from tradewind.sources.sinks import read_current
from tradewind.sources.upsert import read_table


def current_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """The current rows of a result table under ``folder``, however its job stores it.

    A folder of runs and batches is reduced to the latest rows per key; a table by key or a snapshot is read
    as it is; a table that no job has written yet is empty.
    """
    path = f"{folder}/{table}"
    names = [name for name in Folder(spark, path).names() if not name.startswith(("_", "."))]
    if not names:
        return spark.createDataFrame([], table_schema(table))
    if any(name.startswith("run=") for name in names):
        return read_current(spark, path, RESULT_KEYS[table])
    return read_table(spark, path)


def report(spark: SparkSession, folder: str, as_of: Instant, n: int = 10) -> DataFrame:
    """All KPIs (kpi, label, value) as of an instant, from the tables under ``folder``.

    Several KPIs come from each table, so its current rows are stored once: each table is scanned and reduced
    once, and the KPIs read the small result.
    """
    tables = {table: stored(current_table(spark, folder, table)) for table in RESULT_KEYS}
    return snapshot(
        tables["revenue_metrics"],
        tables["fraud_alerts"],
        tables["inventory_velocity"],
        tables["cart_abandonment"],
        tables["operational_metrics"],
        as_of,
        n,
    )
