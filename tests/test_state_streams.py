"""Streams with their own state: orders that end and leave, reservations that arrive out of order."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from hypothesis import given
from hypothesis import strategies as st

from checks import streams
from checks.inputs import Inputs
from tradewind.plans.orders import STEP_OF_STATUS
from tradewind.session import durable_folder
from tradewind.sources.sinks import read_current
from tradewind.streaming.order_state import furthest, order_status_changes
from tradewind.streaming.reservations import SETTINGS, reserve_as_they_come
from tradewind.streaming.runner import BatchFolderSink, batch_folder_sink, start_job

NOON = datetime(2024, 3, 5, 12)
LOG = "event_type string, order_id string, event_timestamp timestamp"
REQUEST = "product_id string, order_id string, quantity int, event_timestamp timestamp"


def minutes(n):
    return NOON + timedelta(minutes=n)


class Feed:
    """Files of rows, read as a stream one file at a time."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, path, schema

    def send(self, *rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(str(self.path / "in"))

    def run(self, build, mode):
        source = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(str(self.path / "in"))
        query = start_job(build(source), batch_folder_sink(str(self.path / "out")), "job", None, mode, str(self.path / "checkpoint"))
        query.awaitTermination(180)
        assert query.exception() is None
        return self.spark.read.parquet(str(self.path / "out"))

    def state(self, name):
        return self.spark.read.format("statestore").option("path", str(self.path / "checkpoint")).option("stateVarName", name).load()


def test_final_orders_leave_the_store(spark, tmp_path, rows):
    feed = Feed(spark, tmp_path, LOG)
    feed.send(("order.created", "a", minutes(0)), ("payment.processed", "a", minutes(2)), ("order.created", "b", minutes(1)), ("other", "c", minutes(1)))
    feed.send(("order.fulfilled", "a", minutes(3)), ("inventory.reserved", "a", minutes(1)), ("order.created", None, minutes(3)))

    def build(source):
        return order_status_changes(source, kept="30 minutes", idle="1 day", watermark="10 minutes")

    found = read_current(spark, str(tmp_path / "out"), ["order_id"]) if feed.run(build, "update") else None
    want = [("a", "FULFILLED", minutes(3)), ("b", "PENDING", minutes(1))]
    assert rows(found.select("order_id", "status", "updated_at")) == want
    assert sorted(r.key.order_id for r in feed.state("times").collect()) == ["a", "b"]
    # Long after its end, ``a`` leaves; a late event of it does not come back to life.
    feed.send(("order.created", "c", minutes(60)))
    feed.send(("order.created", "a", minutes(5)))
    feed.send(("order.created", "d", minutes(61)))
    feed.run(build, "update")
    found = read_current(spark, str(tmp_path / "out"), ["order_id"]).select("order_id", "status", "updated_at")
    assert rows(found) == [*want, ("c", "PENDING", minutes(60)), ("d", "PENDING", minutes(61))]
    assert sorted(r.key.order_id for r in feed.state("times").collect()) == ["b", "c", "d"]
    feed.send(("order.created", "e", minutes(60 * 48)))
    feed.run(build, "update")
    assert [r.key.order_id for r in feed.state("times").collect()] == ["e"]


def test_known_orders_open_the_state(spark, tmp_path, rows):
    feed = Feed(spark, tmp_path, LOG)
    known = spark.createDataFrame(
        [("a", "PAID", minutes(0)), ("b", "PAID", minutes(0)), ("c", "ODD", minutes(0)), (None, "PAID", minutes(0))],
        "order_id string, status string, updated_at timestamp")
    feed.send(("order.created", "a", minutes(9)), ("order.fulfilled", "b", minutes(9)), ("order.created", "c", minutes(9)))
    found = feed.run(lambda source: order_status_changes(source, known), "update")
    assert rows(found.select("order_id", "status")) == [("b", "FULFILLED"), ("c", "PENDING")]


@given(st.dictionaries(st.sampled_from(list(STEP_OF_STATUS)), st.integers(0, 3), min_size=1))
def test_furthest_status(times):
    status, at = furthest(times)
    assert at == times[status] and STEP_OF_STATUS[status] == max(STEP_OF_STATUS[name] for name in times)
    assert all(at >= times[name] for name in times if STEP_OF_STATUS[name] == STEP_OF_STATUS[status])


def greedy(stock, requests, until):
    left, out = dict(stock), []
    for product, order, quantity, at in sorted(requests, key=lambda r: (r[3], r[1])):
        granted = 0 < quantity <= left.get(product, 0)
        if granted:
            left[product] -= quantity
        if at <= until:
            out.append((product, at, order, quantity, granted))
    return sorted(out, key=repr)


def test_reservations_out_of_order_with_a_restart(spark, tmp_path, rows):
    stock = [("p", 10), ("q", 3), ("unused", 1)]
    files = [
        [("p", "o3", 6, minutes(3)), ("p", "o1", 3, minutes(1)), ("q", "o1", 4, minutes(1)), ("x", "o1", 1, minutes(1))],
        [("p", "o2", 5, minutes(2)), ("q", "o2", 3, minutes(3)), ("q", "o4", 0, minutes(4)), ("p", "o5", 2, minutes(14))],
        [("p", "o4", 2, minutes(4)), ("p", "o4b", 1, minutes(4)), ("q", "o9", 1, minutes(20))],
        [("p", "o6", 1, minutes(40))],
    ]
    feed = Feed(spark, tmp_path, REQUEST)
    products = spark.createDataFrame(stock, "product_id string, stock int")

    def build(source):
        return reserve_as_they_come(source, products, watermark="12 minutes")

    for part in files[:2]:
        feed.send(*part)
    feed.run(build, "append")
    for part in files[2:]:
        feed.send(*part)
    found = feed.run(build, "append").drop("run", "batch_id")
    sent = [request for part in files for request in part]
    assert rows(found) == greedy(stock, sent, minutes(28))


def test_products_share_shelves_of_state(spark, tmp_path, rows):
    """State is as many entries as shelves and blocks, not products or requests; 13 000 wait on each shelf."""
    draw = random.Random(3)
    stock = [(f"p{i}", 900 * i) for i in range(40)]
    sent = [(f"p{draw.randrange(50)}", f"o{i}", draw.choice((0, 1, 2, 7, None)), minutes(draw.randrange(25))) for i in range(26_000)]
    sent.insert(9, ("p1", "first", 1, minutes(-60)))
    feed = Feed(spark, tmp_path, REQUEST)
    products = spark.createDataFrame(stock, "product_id string, stock int")

    def build(source):
        return reserve_as_they_come(source, products, watermark="30 minutes", shelves=2)

    feed.send(*sent[:20_000])
    feed.send(*sent[20_000:])
    assert rows(feed.run(build, "append").select("order_id")) == [("first",)]
    waiting = feed.state("waiting").selectExpr("key.shelf", "size(list_element.order_id) AS requests").collect()
    assert len({row.shelf for row in waiting}) == 2 < len(waiting) < 10 and max(row.requests for row in waiting) <= 10_000
    assert sum(row.requests for row in waiting) == 26_000
    feed.send(("p1", "last", 1, minutes(70)))
    found = feed.run(build, "append").drop("run", "batch_id")
    expected = greedy(stock, [(product, order, quantity or 0, at) for product, order, quantity, at in sent], minutes(40))
    assert rows(found.na.fill(0, ["quantity"])) == expected


def test_batches_leave_no_shuffle_files_and_replaced_state(spark, tmp_path, rows):
    """Written as they come: equal rows, no folder for an empty batch, nothing shuffled left, early batches not kept."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    left = []

    def shuffled():
        return {f.name for top in manager.localDirsString() for f in Path(top).glob("*/shuffle_*.data")}

    class Noted(BatchFolderSink):
        def __call__(self, batch, batch_id):
            left.append(shuffled() - before)
            super().__call__(batch, batch_id)
            during.append(shuffled() - before)

    before, during = shuffled(), []
    usual = {key: spark.conf.get(key, None) for key in SETTINGS}
    stock = [("p", 10), ("q", 3)]
    sent = [(draw, f"o{i}", 1 + i % 3, minutes(i)) for i, draw in enumerate("pqx" * 20)]
    feed = Feed(spark, tmp_path, REQUEST)
    products = spark.createDataFrame(stock, "product_id string, stock int")
    for at in range(0, 60, 15):
        feed.send(*sent[at : at + 15])
    source = spark.readStream.schema(REQUEST).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    decided = reserve_as_they_come(source, products, watermark="12 minutes", shelves=2)
    sink = Noted(str(tmp_path / "out"), merged=False)
    query = start_job(decided, sink, "job", None, "append", str(tmp_path / "checkpoint"), SETTINGS)
    query.awaitTermination(180)
    assert query.exception() is None
    left.append(shuffled() - before)
    found = spark.read.parquet(str(tmp_path / "out"))
    assert rows(found.drop("run", "batch_id")) == greedy(stock, sent, minutes(47))
    # The first batch has no watermark, so it decides nothing.
    stored = {f.name for f in (tmp_path / "out").glob("run=*/*")}
    assert stored == {f"batch_id={k}" for k in range(1, len(during))} and found.select("batch_id").distinct().count() == len(stored)
    kept = [int(f.name) for f in (tmp_path / "checkpoint" / "commits").glob("[0-9]*")]
    assert max(kept) == len(during) - 1 and len(kept) < len(during)
    assert all(during[:-1]) and left == [set()] * len(left)
    assert {key: spark.conf.get(key, None) for key in SETTINGS} == usual


def test_the_check_keeps_neither_its_input_nor_a_copy(spark, tmp_path, rows):
    """What a stream has read is deleted, and no table is stored beside it."""
    lines = [(i, i % 3, 7, 1, float(1 + i % 4), 5.0 * i, "N", "O", datetime(1995, 1, 1) + timedelta(days=40 * i)) for i in range(60)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_returnflag string, l_linestatus string, l_shipdate timestamp").write.parquet(str(tmp_path / "lineitem.parquet"))
    parts = [(k, f"n{k}", 30, 1.0) for k in range(2)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_size int, p_retailprice double").write.parquet(str(tmp_path / "part.parquet"))
    top = Path(durable_folder(spark).removeprefix("file:"))
    earlier = {name: set(top.glob(name)) for name in ("tables/*", "runs/reserve-*")}
    found = streams.reservations(Inputs(spark, str(tmp_path)))
    until = lines[-1][-1] - timedelta(days=800)
    wanted = greedy({f"PROD-{k}": 30 for k in range(2)}, [(f"PROD-{r[1]}", f"{r[0]}-1-7-{r[1]}-{int(r[4])}", int(r[4]), r[-1]) for r in lines], until)
    assert rows(found.select("product_id", "event_timestamp", "id", "quantity", "accepted")) == wanted
    (folder,) = set(top.glob("runs/reserve-*")) - earlier["runs/reserve-*"]
    assert not list(folder.glob("in/*/part-*")) and set(top.glob("tables/*")) == earlier["tables/*"]


def test_reserved_quantities_are_whole(spark, tmp_path):
    feed = Feed(spark, tmp_path, REQUEST.replace("quantity int", "quantity double"))
    source = spark.readStream.schema(feed.schema).parquet(str(tmp_path))
    with pytest.raises(TypeError):
        reserve_as_they_come(source, spark.createDataFrame([("p", 1)], "product_id string, stock int"))
