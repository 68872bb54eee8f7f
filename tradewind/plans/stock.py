"""Stock: the ledger of moves, low-stock alerts, greedy reservation and refills."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.timing import Instant, instant
from tradewind.operators.hot import split_hot
from tradewind.operators.joins import having
from tradewind.operators.slices import running_sum
from tradewind.session import stored

# ---- fixed values ---------------------------------------------------------------------------
RESERVED, RELEASED, REFILLED = "reserved", "released", "refilled"
LOW_STOCK = 10
REFILL_BELOW, REFILL_QUANTITY = 20, 50
# ---------------------------------------------------------------------------------------------

# Folding costs about a microsecond per request, so a task can take this many of one product.
FOLD_AT_MOST = 50_000_000


def stock_ledger(
    products: DataFrame,
    moves: DataFrame,
    ties: tuple[str, ...] = ("move_id",),
    width: str = "1 hour",
) -> DataFrame:
    """Every move with its signed change and the product's stock after it.

    Stock opens at the product's ``stock``; a reservation lowers it, a release or refill raises
    it. Moves are ordered by time, then ``ties``.
    """
    sign = F.when(F.col("kind") == RESERVED, -1).otherwise(1)
    signed = moves.withColumn("delta", (sign * F.col("quantity")).cast("bigint"))
    opening = products.select("product_id", F.col("stock").cast("bigint").alias("delta"))
    return running_sum(
        signed,
        ["product_id"],
        "event_timestamp",
        "delta",
        "balance",
        list(ties),
        opening,
        width,
    )


def low_stock_alerts(ledger: DataFrame, threshold: int = LOW_STOCK) -> DataFrame:
    """Reservations that left a product with less than ``threshold``."""
    low = (F.col("kind") == RESERVED) & (F.col("balance") < threshold)
    return ledger.filter(low).select(
        "product_id",
        "event_timestamp",
        F.col("balance").alias("current_stock"),
        F.lit(threshold).alias("threshold"),
    )


def reserve_greedy(
    products: DataFrame,
    requests: DataFrame,
    ties: tuple[str, ...] = ("order_id",),
    width: str = "1 hour",
    hot_above: int = FOLD_AT_MOST,
) -> DataFrame:
    """Decide each reservation in order: grant it if the stock left covers it, else skip it.

    A skipped request does not stop later, smaller ones. The result is ``requests`` with
    ``accepted``; (event_timestamp, ties) must order the requests of a product uniquely. A
    request for an unknown product, or for nothing, is not granted. Stock is counted in whole units,
    so ``quantity`` must be of a whole-number type.

    Usual products are folded in one pass over sorted partitions. A hot product would keep one
    task busy, so hot ones are decided by ranges of stock instead (``_reserve_by_ranges``).
    """
    if not isinstance(requests.schema["quantity"].dataType, T.IntegralType):
        raise TypeError("quantity must be of a whole-number type")
    usual, hot = split_hot(requests, ["product_id"], hot_above)
    decided = _reserve_by_folding(products, usual, ties)
    if hot is None:
        return decided
    return decided.unionByName(_reserve_by_ranges(products, hot, ties, width))


def _reserve_by_folding(
    products: DataFrame, requests: DataFrame, ties: tuple[str, ...]
) -> DataFrame:
    """Walk through each product's requests in order, with the stock left in hand.

    The product's stock comes as a row in front of its requests, so one shuffle brings both
    together. Each partition holds whole products, sorted, and is read batch by batch, so memory
    does not grow with the number of requests.
    """
    opening = products.select("product_id", F.col("stock").cast("bigint").alias("_stock"))
    arranged = (
        requests.withColumn("_stock", F.lit(None).cast("bigint"))
        .unionByName(opening, allowMissingColumns=True)
        .repartition("product_id")
        .sortWithinPartitions(
            "product_id", F.col("_stock").desc_nulls_last(), "event_timestamp", *ties
        )
    )
    schema = T.StructType([*requests.schema.fields, T.StructField("accepted", T.BooleanType())])

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, left = None, 0
        for batch in batches:
            opens = batch["_stock"].notna().to_numpy()
            stocks = batch["_stock"].fillna(0).astype("int64")
            granted = []
            for product, is_opening, stock, quantity in zip(
                batch["product_id"], opens, stocks, batch["quantity"]
            ):
                if product != current:
                    current, left = product, 0
                if is_opening:
                    left = stock
                grant = not is_opening and 0 < quantity <= left
                if grant:
                    left -= quantity
                granted.append(grant)
            yield batch.assign(accepted=granted)[~opens][schema.names]

    return arranged.mapInPandas(fold, schema)


def _reserve_by_ranges(
    products: DataFrame, requests: DataFrame, ties: tuple[str, ...], width: str
) -> DataFrame:
    """The same decisions without walking: for products with very many requests.

    While between ``half`` and ``2 * half`` units are left, every request below ``half`` is
    granted, none of ``2 * half`` or more is, and at most one in between, because granting it
    leaves less than ``half``. So one running sum finds where a product leaves that range. A
    product passes each range once, and the ranges halve: the number of passes is the number of
    binary digits of the largest stock, whatever the number of requests. What a pass finds, one
    row per product, is stored.
    """
    position = F.struct("event_timestamp", *ties)
    quantity = F.col("quantity")
    asked = requests.filter(quantity > 0).select("product_id", "event_timestamp", *ties, "quantity")

    # Ranges a product has passed: the size below which requests were granted, from where to where.
    position_type = asked.select(position.alias("p")).schema["p"].dataType.simpleString()
    passed_type = f"array<struct<half:bigint,since:{position_type},until:{position_type}>>"
    wanted = having(products, requests, ["product_id"])
    state = stored(
        wanted.select(
            "product_id",
            F.col("stock").cast("bigint").alias("left"),
            F.lit(None).cast(position_type).alias("since"),
            F.array().cast(passed_type).alias("passed"),
        )
    )
    most = state.agg(F.max("left")).first()[0] or 0
    for digit in reversed(range(int(most).bit_length())):
        state = stored(_pass_range(state, asked, position, list(ties), F.lit(1 << digit), width))

    decided = requests.join(state.select("product_id", "passed"), "product_id", "left")
    accepted = F.exists("passed", lambda one: _granted(one, position, quantity))
    return decided.withColumn(
        "accepted", F.coalesce(accepted, F.lit(False)) & (quantity > 0)
    ).drop("passed")


def _granted(one: Column, position: Column, quantity: Column) -> Column:
    inside = (one["since"].isNull() | (position > one["since"])) & (
        one["until"].isNull() | (position <= one["until"])
    )
    return inside & ((quantity < one["half"]) | (position == one["until"]))


def _pass_range(
    state: DataFrame, asked: DataFrame, position: Column, ties: list[str], half: Column, width: str
) -> DataFrame:
    """Move every product with at least ``half`` units left to where fewer are left."""
    active = state.filter(F.col("left") >= half).select("product_id", "left", "since")
    in_range = asked.filter(F.col("quantity") < half * 2)
    ahead = in_range.join(active, "product_id").filter(
        F.col("since").isNull() | (position > F.col("since"))
    )
    is_small = F.col("quantity") < half
    small = F.when(is_small, F.col("quantity")).otherwise(0).cast("bigint")
    summed = running_sum(
        ahead.withColumn("small", small),
        ["product_id"],
        "event_timestamp",
        "small",
        "granted",
        ties,
        width=width,
    )
    after = F.col("left") - F.col("granted") - F.when(is_small, 0).otherwise(F.col("quantity"))
    leaves = F.when(is_small, after < half).otherwise(after >= 0)
    exits = (
        summed.filter(leaves)
        .groupBy("product_id")
        .agg(F.min(F.struct(position.alias("until"), after.alias("left"))).alias("exit"))
    )
    stayed = F.col("left") < half
    passed = F.array_append(
        "passed",
        F.struct(
            half.cast("bigint").alias("half"),
            F.col("since").alias("since"),
            F.col("exit.until").alias("until"),
        ),
    )
    return state.join(exits, "product_id", "left").select(
        "product_id",
        # Without an exit all requests have been decided, so nothing is left to pass.
        F.when(stayed, F.col("left")).otherwise(F.coalesce("exit.left", F.lit(0))).alias("left"),
        F.when(stayed, F.col("since")).otherwise(F.col("exit.until")).alias("since"),
        F.when(stayed, F.col("passed")).otherwise(passed).alias("passed"),
    )


def refill_plan(
    products: DataFrame,
    as_of: Instant,
    threshold: int = REFILL_BELOW,
    quantity: int = REFILL_QUANTITY,
) -> DataFrame:
    """Products below ``threshold`` with their stock raised, ready to be merged by product."""
    return products.filter(F.col("stock") < threshold).select(
        "product_id",
        F.col("stock").alias("stock_before"),
        (F.col("stock") + quantity).alias("stock"),
        (F.col("version") + 1).alias("version"),
        F.lit(quantity).alias("quantity"),
        instant(as_of).alias("updated_at"),
    )


def refill_summary(refills: DataFrame) -> DataFrame:
    return refills.agg(
        F.count("*").alias("total_refills"),
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("total_units_added"),
        F.count_distinct("product_id").alias("products_refilled"),
    )
