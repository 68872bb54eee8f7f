"""The given tables seen as a shop: what plays the part of a payment, an order, a reservation.

``relations.py`` says the same in SQL, name by name. Nothing is invented: every row derives from
one row of a given table, and all rows of a table take part.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.plans import jobs

AS_OF = "2024-01-30 20:00:00"
# The alerts thin out towards the end of the data; this instant has some of each kind before it.
ALERTS_AS_OF = "2024-01-29 00:00:00"
ORDERS_AS_OF = "2001-07-31 12:00:00"


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table_schema(self, name: str) -> T.StructType:
        """The stored schema with zone-less times declared as instants, which watermarks need."""
        stored = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet").schema
        return T.StructType(
            [
                T.StructField(f.name, T.TimestampType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType)
                for f in stored
            ]
        )

    def table(self, name: str) -> DataFrame:
        reader = self.spark.read.schema(self.table_schema(name))
        return reader.parquet(f"{self.sf_dir}/{name}.parquet")

    # ---- event log --------------------------------------------------------------------------

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def event_stream(self) -> DataFrame:
        """The events table read as a stream."""
        reader = self.spark.readStream.schema(self.table_schema("events"))
        return reader.option("pathGlobFilter", "events.parquet").parquet(self.sf_dir)

    @staticmethod
    def of_type(events: DataFrame, event_type: str) -> DataFrame:
        product = F.get_json_object("props", "$.k")
        return events.filter(F.col("event_type") == event_type).select(
            F.col("event_id").cast("string").alias("event_id"),
            F.col("user_id").cast("string").alias("user_id"),
            F.concat(F.lit("PROD-"), product).alias("product_id"),
            F.col("value").alias("amount"),
            F.col("value").alias("total_amount"),
            F.col("ts").alias("event_timestamp"),
        )

    @cached_property
    def payments_made(self) -> DataFrame:
        return self.of_type(self.events, "purchase")

    @cached_property
    def clicks(self) -> DataFrame:
        return self.of_type(self.events, "click")

    @staticmethod
    def as_envelope(events: DataFrame) -> DataFrame:
        """Event types as topics, with the record as JSON."""
        return events.select(
            F.col("user_id").cast("string").cast("binary").alias("key"),
            F.to_json(F.struct("event_id", "user_id", "value", "props")).cast("binary").alias("value"),
            F.col("event_type").alias("topic"),
            F.pmod("user_id", F.lit(3)).cast("int").alias("partition"),
            F.col("event_id").alias("offset"),
            F.col("ts").alias("timestamp"),
        )

    @cached_property
    def envelope(self) -> DataFrame:
        return self.as_envelope(self.events)

    @cached_property
    def processed(self) -> DataFrame:
        return self.events.select(
            F.col("event_id").cast("string").alias("id"),
            F.col("event_id").cast("string").alias("event_id"),
            "event_type",
            F.col("ts").alias("processed_at"),
        )

    @cached_property
    def outbox(self) -> DataFrame:
        waiting = F.col("event_type").isin("click", "view")
        return self.events.select(
            F.col("event_id").cast("string").alias("id"),
            F.concat(F.lit("ORD-"), "event_id").alias("order_id"),
            "event_type",
            F.col("props").alias("event_data"),
            F.when(waiting, "N").otherwise("Y").alias("published"),
            F.col("ts").alias("created_at"),
        )

    @cached_property
    def deliveries(self) -> DataFrame:
        """Each event once, and each purchase once more, delivered a second later."""
        first = self.events.select(
            "event_type", F.col("event_id").cast("string").alias("event_id"), F.col("ts").alias("event_timestamp")
        )
        again = first.filter("event_type = 'purchase'").withColumn(
            "event_timestamp", F.expr("event_timestamp + INTERVAL 1 SECOND")
        )
        return first.unionByName(again)

    @cached_property
    def cart_log(self) -> DataFrame:
        return self.as_cart_log(self.events)

    @staticmethod
    def as_cart_log(events: DataFrame) -> DataFrame:
        kind = (
            F.when(F.col("event_type") == "click", "cart.item_added")
            .when(F.col("event_type") == "signup", "cart.item_removed")
            .when(F.col("event_type") == "view", "cart.quantity_set")
            .when(F.col("event_type") == "purchase", "cart.checkout_initiated")
        )
        k = F.get_json_object("props", "$.k").cast("int")
        # Few products, so that a user meets the same one again.
        return events.select(
            "event_id",
            kind.alias("event_type"),
            F.col("user_id").cast("string").alias("user_id"),
            F.concat(F.lit("PROD-"), F.floor(k / F.lit(25))).alias("product_id"),
            (F.floor(F.col("value") / F.lit(20)) + F.when(F.col("event_type") == "click", 1).otherwise(0))
            .cast("int")
            .alias("quantity"),
            F.col("value").alias("price"),
            F.col("ts").alias("event_timestamp"),
        ).filter("event_type is not null")

    # ---- operational tables -----------------------------------------------------------------

    @cached_property
    def orders(self) -> DataFrame:
        status = (
            F.when(F.col("o_orderstatus") == "F", "FULFILLED")
            .when(F.col("o_orderstatus") == "P", "PAID")
            .otherwise("PENDING")
        )
        return self.table("orders").select(
            F.col("o_orderkey").cast("string").alias("id"),
            F.concat(F.lit("ORD-"), "o_orderkey").alias("order_id"),
            F.col("o_custkey").cast("string").alias("user_id"),
            status.alias("status"),
            F.col("o_totalprice").alias("total_amount"),
            F.col("o_orderdate").alias("created_at"),
            self.later("o_orderdate", F.floor("o_totalprice") * 10).alias("updated_at"),
            F.col("o_orderpriority").alias("priority"),
        )

    @staticmethod
    def later(ts: str, by_micros: Column) -> Column:
        return F.timestamp_micros(F.unix_micros(ts) + by_micros.cast("bigint"))

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines with a readable id of the line and of its order and product."""
        return self.table("lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", F.col("l_quantity").cast("int")).alias("id"),
            F.concat(F.lit("ORD-"), "l_orderkey").alias("order_id"),
            F.concat(F.lit("PROD-"), "l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").alias("amount"),
            F.when(F.col("l_linestatus") == "O", "card").otherwise("transfer").alias("method"),
            F.when(F.col("l_returnflag") == "R", "FAILED").otherwise("SUCCESS").alias("status"),
            F.col("l_returnflag").alias("returnflag"),
            F.col("l_shipdate").alias("created_at"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        return self.lines.select(
            "id", F.concat(F.lit("PAY-"), "id").alias("payment_id"), "order_id", "amount", "method", "status", "created_at"
        )

    @cached_property
    def reservations(self) -> DataFrame:
        return self.lines.select("id", "order_id", "product_id", "quantity", "created_at")

    @cached_property
    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("id"),
            F.concat(F.lit("PROD-"), "p_partkey").alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_retailprice").alias("price"),
            F.col("p_size").alias("stock"),
            F.lit(1).alias("version"),
            F.timestamp_seconds(F.lit(1704067200) + F.col("p_partkey") * 60).alias("created_at"),
        )

    @cached_property
    def orders_with_items(self) -> DataFrame:
        """One row per order line: its order, and the line as a JSON array of one item."""
        item = F.struct("product_id", "quantity", F.col("amount").alias("item_total"))
        lines = self.lines.select("order_id", F.to_json(F.array(item)).alias("items"))
        return self.orders.select("order_id", "status", "created_at").join(lines, "order_id")

    @cached_property
    def order_log(self) -> DataFrame:
        """The events of each order, from its priority and status.

        Priority 5 is out of stock, 4 fails to pay, the others pay; of those, fulfilled orders
        are fulfilled in time, and paid ones report fulfilment too early.
        """
        orders = self.orders.withColumn("rank", F.substring("priority", 1, 1).cast("int"))
        paid = F.col("rank") <= 3
        pay_delay = 3_000_000 + F.floor("total_amount") * 10

        def step(event_type: str, condition: Column, delay: Column) -> Column:
            return F.when(
                condition,
                F.struct(F.lit(event_type).alias("event_type"), delay.cast("bigint").alias("delay")),
            )

        steps = F.array(
            step("order.created", F.lit(True), F.lit(0)),
            step("inventory.reserved", F.col("rank") < 5, F.lit(2_000_000)),
            step("inventory.depleted", F.col("rank") == 5, F.lit(2_000_000)),
            step("payment.processed", paid, pay_delay),
            step("payment.failed", F.col("rank") == 4, pay_delay),
            step("order.fulfilled", paid & (F.col("status") == "FULFILLED"), F.lit(60_000_000)),
            step("order.fulfilled", paid & (F.col("status") == "PAID"), F.lit(1_000_000)),
        )
        return (
            orders.select("id", "order_id", "created_at", F.explode(steps).alias("step"))
            .filter("step is not null")
            .select(
                F.col("id").alias("event_id"),
                "order_id",
                F.col("step.event_type").alias("event_type"),
                self.later("created_at", F.col("step.delay")).alias("event_timestamp"),
            )
        )

    @cached_property
    def cancelled(self) -> DataFrame:
        source = (
            F.when(F.startswith("priority", F.lit("4")), "payment_failed")
            .when(F.startswith("priority", F.lit("5")), "inventory_depleted")
        )
        return (
            self.orders.select("id", "order_id", "user_id", source.alias("cancellation_source"))
            .filter("cancellation_source is not null")
        )

    @cached_property
    def moves(self) -> DataFrame:
        """Every line reserves stock; a returned one releases it a week later."""
        lines = self.lines.select(
            "product_id", F.col("id").alias("move_id"), "quantity", "amount", "created_at", "returnflag"
        )
        reserved = lines.select(
            "product_id", "move_id", "amount", F.lit("reserved").alias("kind"), "quantity",
            F.col("created_at").alias("event_timestamp"),
        )
        released = lines.filter("returnflag = 'R'").select(
            "product_id", "move_id", "amount", F.lit("released").alias("kind"), "quantity",
            F.expr("created_at + INTERVAL 7 DAYS").alias("event_timestamp"),
        )
        return reserved.unionByName(released)

    # ---- result tables ----------------------------------------------------------------------

    @cached_property
    def revenue(self) -> DataFrame:
        return jobs.revenue_by_window(self.payments_made, "1 hour")

    @cached_property
    def alerts(self) -> DataFrame:
        return scaled_alerts(self.payments_made, self.clicks)

    @cached_property
    def abandoned(self) -> DataFrame:
        found = jobs.cart_abandonment(self.clicks, self.payments_made, "12 hours")
        return found.withColumn("detected_at", F.expr("item_added_time + INTERVAL 24 HOURS"))

    @cached_property
    def velocity(self) -> DataFrame:
        return jobs.inventory_velocity(self.orders_with_items, "day")

    @cached_property
    def ops(self) -> DataFrame:
        return jobs.topic_throughput_health(
            self.envelope, "1 hour", threshold=4, healthy_above=3, warning_above=1, topics=None
        )

    # ---- dead letters and samples -----------------------------------------------------------

    @cached_property
    def dead_letters(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        topic = (
            F.when(k < 20, "cart.item_added")
            .when(k < 40, "order.created")
            .when(k < 60, "payment.failed")
            .when(k < 80, "inventory.low")
            .otherwise("unrouted")
        )
        error = F.when(F.col("value") < 10, "TimeoutError").when(F.col("value") < 50, "OperationalError").otherwise("ValueError")
        return self.events.filter("event_type = 'error'").select(
            F.col("event_id").cast("string").alias("event_id"),
            topic.alias("original_topic"),
            error.alias("error_type"),
            F.concat(F.lit("failed on "), "props").alias("error_reason"),
            F.lit(3).alias("retry_count"),
            F.col("props").alias("payload"),
            F.pmod("user_id", F.lit(3)).cast("int").alias("partition"),
            F.col("event_id").alias("offset"),
            F.col("ts").alias("event_timestamp"),
        )

    @cached_property
    def samples(self) -> DataFrame:
        """Hourly samples of two counters per event type, which restart every midnight."""
        hour = F.date_trunc("hour", "ts")
        hourly = self.events.groupBy("event_type", hour.alias("hour")).agg(
            F.count("*").cast("decimal(18,2)").alias("events_total"),
            F.sum(F.col("value").cast("decimal(18,2)")).alias("value_sum"),
        )
        day = Window.partitionBy("event_type", F.date_trunc("day", "hour")).orderBy("hour")

        def sample(metric: str) -> Column:
            so_far = F.sum(metric).over(day).cast("double")
            return F.struct(F.lit(metric).alias("metric"), so_far.alias("value"))

        return (
            hourly.select("event_type", "hour", F.array(sample("events_total"), sample("value_sum")).alias("both"))
            .select("event_type", "hour", F.explode("both").alias("one"))
            .select(
                F.col("hour").alias("ts"),
                "one.metric",
                F.create_map(
                    F.lit("service"), F.lit("shop"), F.lit("event_type"), F.col("event_type")
                ).alias("labels"),
                "one.value",
            )
        )


def scaled_alerts(payments: DataFrame, orders: DataFrame, **others) -> DataFrame:
    """Fraud rules with limits that this data can exceed."""
    return jobs.fraud_alerts(
        payments,
        orders,
        window="1 day",
        slide="6 hours",
        max_orders=2,
        max_amount=200,
        max_payments=2,
        critical_orders=3,
        critical_amount=300,
        critical_payments=3,
        **others,
    )
