"""The jobs started from the command line, on envelope files."""

from datetime import datetime, timedelta

from test_streams import Topic

from tradewind.__main__ import parse, run
from tradewind.schemas import RESULT_KEYS, table_schema
from tradewind.sources.sinks import read_current

NOON = datetime(2024, 3, 5, 12)


def test_every_stream_fills_its_table(spark, tmp_path):
    topic = Topic(spark, tmp_path / "topic")
    for at in (NOON, NOON + timedelta(hours=3)):
        topic.send(
            topic.payment(at, 2000.0), topic.order(at), topic.added(at), topic.checkout(at, "other")
        )
    tables = {
        "revenue": "revenue_metrics",
        "fraud": "fraud_alerts",
        "carts": "cart_abandonment",
        "throughput": "operational_metrics",
    }
    for job, table in tables.items():
        out = str(tmp_path / job)
        run(spark, parse([job, "--files", topic.path, "--out", out, "--checkpoint", f"{out}-checkpoint", "--once"]))
        stored = read_current(spark, out, RESULT_KEYS[table])
        assert stored.count() > 0
        assert {f.name: f.dataType for f in stored.schema} == {f.name: f.dataType for f in table_schema(table)}


def test_velocity_replaces_its_table(spark, tmp_path):
    orders = spark.createDataFrame(
        [("o", "FULFILLED", '[{"product_id": "p", "quantity": 2, "item_total": 5.5}]', NOON)],
        "order_id string, status string, items string, created_at timestamp",
    )
    orders.write.parquet(str(tmp_path / "orders"))
    for _ in range(2):
        run(spark, parse(["velocity", "--orders", str(tmp_path / "orders"), "--out", str(tmp_path / "out")]))
    (row,) = spark.read.parquet(str(tmp_path / "out")).collect()
    assert (row.product_id, row.units_sold, str(row.revenue)) == ("p", 2, "5.50")


def test_velocity_of_some_partitions(spark, tmp_path):
    rows = [("o", "FULFILLED", '[{"product_id": "p", "quantity": 2, "item_total": 5.5}]', NOON, month) for month in ("2024-02", "2024-03")]
    orders = spark.createDataFrame(rows, "order_id string, status string, items string, created_at timestamp, month string")
    orders.write.partitionBy("month").parquet(str(tmp_path / "orders"))
    run(spark, parse(["velocity", "--orders", str(tmp_path / "orders"), "--out", str(tmp_path / "out"), "--months", "2024-03"]))
    assert [r.units_sold for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [2]


def test_kpis_over_what_jobs_stored(spark, tmp_path, capsys):
    topic = Topic(spark, tmp_path / "topic")
    for at in (NOON, NOON + timedelta(hours=3)):
        topic.send(topic.payment(at, 2000.0), topic.order(at))
    out = str(tmp_path / "tables" / "revenue_metrics")
    run(spark, parse(["revenue", "--files", topic.path, "--out", out, "--checkpoint", str(tmp_path / "c"), "--once"]))
    arguments = ["kpis", "--tables", str(tmp_path / "tables"), "--as-of", str(NOON + timedelta(hours=4))]
    run(spark, parse(arguments))
    assert '{"kpi":"revenue_total_24h","value":2000.0}' in capsys.readouterr().out
    run(spark, parse([*arguments, "--out", str(tmp_path / "kpis")]))
    found = {(r.kpi, r.label): r.value for r in spark.read.parquet(str(tmp_path / "kpis")).collect()}
    assert found["revenue_total_24h", None] == 2000.0 and found["critical_alerts", None] == 0
