"""Run a job: ``spark-submit -m tradewind`` or ``python -m tradewind <job> [options]``.

    revenue | fraud | carts | throughput    streams over topics
    velocity                                 batch over the orders table
    kpis                                     batch over the result tables of the others

Streams read Kafka (``--servers``) or a folder of envelope files (``--files``), and store their
result table under ``--out`` or merge it into the catalog table ``--table``. ``velocity`` reads
the orders from Parquet (``--orders``) and replaces the table under ``--out``. ``kpis`` reads the result
tables under ``--tables``, each in a folder of its name, and prints the KPIs as of ``--as-of`` (default: now) as
JSON lines, or replaces the table under ``--out``. Jobs fill such a folder with ``--out <tables>/<result table>``.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.plans import jobs
from tradewind.plans.kpi_report import report
from tradewind.schemas import JOURNEY_TOPICS, conform
from tradewind.session import build_session
from tradewind.sources.sinks import write_snapshot
from tradewind.sources.tables import read_table
from tradewind.sources.topics import decode, read_topics, source_options, stream_files
from tradewind.streaming.runner import batch_folder_sink, merge_sink, start_job


# Opens the stream of some topics. Each topic is opened on its own, so none is read twice.
Source = Callable[[list[str]], DataFrame]


def typed(source: Source, topic: str, *fields: str) -> DataFrame:
    return decode(source([topic]), topic, list(fields))


def revenue(source: Source) -> DataFrame:
    return jobs.revenue_by_window(typed(source, "payment.processed", "amount"))


def fraud(source: Source) -> DataFrame:
    return jobs.fraud_alerts(
        typed(source, "payment.processed", "user_id", "amount"),
        typed(source, "order.created", "user_id", "total_amount"),
    )


def carts(source: Source) -> DataFrame:
    return jobs.cart_abandonment(
        typed(source, "cart.item_added", "user_id", "product_id"),
        typed(source, "cart.checkout_initiated", "user_id"),
    )


def throughput(source: Source) -> DataFrame:
    return jobs.topic_throughput_health(source(list(JOURNEY_TOPICS)))


# How the result of a stream is made, and the table it fills.
STREAMS = {
    "revenue": (revenue, "revenue_metrics"),
    "fraud": (fraud, "fraud_alerts"),
    "carts": (carts, "cart_abandonment"),
    "throughput": (throughput, "operational_metrics"),
}


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tradewind", description=__doc__.splitlines()[0])
    parser.add_argument("job", choices=[*STREAMS, "velocity", "kpis"])
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--files", help="folder of envelope Parquet files, instead of Kafka")
    parser.add_argument("--max-per-trigger", type=int, help="records (Kafka) or files per batch")
    parser.add_argument("--orders", help="Parquet table of orders, for velocity")
    parser.add_argument("--months", nargs="*", help="for velocity: only these partitions (values of --partition)")
    parser.add_argument("--partition", default="month", help="partition column of --orders that --months names")
    parser.add_argument("--tables", help="folder of the result tables, for kpis")
    parser.add_argument("--as-of", help="instant of the KPIs, for kpis")
    parser.add_argument("--out", help="folder of the result table")
    parser.add_argument("--table", help="catalog table to merge into, instead of --out")
    parser.add_argument("--checkpoint", help="default: a folder per job in spark.checkpoint.dir")
    parser.add_argument("--trigger", default="10 seconds", help="time between batches")
    parser.add_argument("--once", action="store_true", help="process what is there, then stop")
    return parser.parse_args(arguments)


def run(spark: SparkSession, options: argparse.Namespace) -> None:
    if options.job == "kpis":
        found = report(spark, options.tables, options.as_of or F.current_timestamp())
        if options.out:
            write_snapshot(found, options.out)
        else:
            # A few rows per KPI, whatever the size of the tables.
            for line in found.toJSON().collect():
                print(line)
        return
    if options.job == "velocity":
        orders = read_table(spark, options.orders, None if options.months else "orders")
        if options.months:
            orders = orders.filter(F.col(options.partition).cast("string").isin(options.months))
        found = jobs.inventory_velocity(orders)
        write_snapshot(conform(found, "inventory_velocity"), options.out)
        return
    transform, table = STREAMS[options.job]

    def source(topics: list[str]) -> DataFrame:
        if options.files:
            return stream_files(spark, options.files, topics, options.max_per_trigger)
        return read_topics(spark, topics, source_options(options.servers, options.max_per_trigger))

    sink = merge_sink(options.table) if options.table else batch_folder_sink(options.out, table)
    trigger = None if options.once else options.trigger
    started = start_job(
        transform(source), sink, options.job, trigger, checkpoint=options.checkpoint
    )
    started.awaitTermination()


if __name__ == "__main__":
    chosen = parse()
    run(build_session(f"tradewind-{chosen.job}"), chosen)
