"""The streaming cart fold against the batch fold and against a plain fold of the same log."""

import random
from datetime import datetime, timedelta

import pytest

from tradewind.plans import carts
from tradewind.streaming.runner import start_job
from tradewind.streaming.stateful import cart_changes

SCHEMA = (
    "event_id long, event_type string, user_id string, product_id string, quantity int, "
    "price double, event_timestamp timestamp"
)
START = datetime(2024, 1, 1)
DAY = timedelta(hours=24)


def plain_fold(log, as_of):
    """What a key-value cart with an expiry holds after the log: the behaviour to match."""
    state, last = {}, {}
    for event_id, kind, user, product, quantity, price, at in sorted(log, key=lambda e: (e[6], e[0])):
        if user in last and at >= last[user] + DAY:
            state[user] = {}
        cart = state.setdefault(user, {})
        if kind in (carts.REMOVED, carts.QUANTITY_SET) and product not in cart:
            continue
        if kind == carts.QUANTITY_SET and quantity < 0:
            continue
        if kind == carts.ADDED:
            if product in cart:
                cart[product][0] += quantity
            else:
                cart[product] = [quantity, price]
        elif kind == carts.REMOVED:
            cart.pop(product, None)
        elif kind == carts.QUANTITY_SET:
            if quantity == 0:
                cart.pop(product)
            else:
                cart[product][0] = quantity
        elif kind == carts.CHECKED_OUT:
            cart.clear()
        last[user] = at
    return sorted(
        (user, product, quantity, price)
        for user, cart in state.items()
        if last[user] + DAY > as_of
        for product, (quantity, price) in cart.items()
    )


def random_log(seed, size=400):
    """A log with removals and sets of what is not in the cart, and negative quantities to set."""
    rng = random.Random(seed)
    log, at = [], START
    for event_id in range(size):
        at += timedelta(minutes=rng.choice([1, 5, 30, 200]))
        kind = rng.choice([carts.ADDED] * 3 + [carts.REMOVED] * 2 + [carts.QUANTITY_SET] * 2 + [carts.CHECKED_OUT])
        quantity = rng.randrange(-1, 5) if kind == carts.QUANTITY_SET else rng.randrange(1, 5)
        user, product = f"u{rng.randrange(6)}", f"p{rng.randrange(4)}"
        log.append((event_id, kind, user, product, quantity, float(rng.randrange(100)), at))
    return log, at


def test_what_has_no_effect_prolongs_nothing(spark):
    def at(hours):
        return START + timedelta(hours=hours)

    log = [
        (1, carts.ADDED, "u", "a", 1, 2.0, at(0)),
        (2, carts.QUANTITY_SET, "u", "b", 3, 2.0, at(20)),
        (3, carts.REMOVED, "u", "c", 1, 2.0, at(21)),
        (4, carts.QUANTITY_SET, "u", "a", -2, 2.0, at(22)),
        # The first cart has expired unseen, so this finds nothing to change.
        (5, carts.QUANTITY_SET, "u", "a", 7, 2.0, at(25)),
        (6, carts.ADDED, "v", "a", 1, 5.0, at(24)),
    ]
    found = carts.current_carts(spark.createDataFrame(log, SCHEMA), at(26)).collect()
    assert [(r.user_id, r.product_id, r.quantity) for r in found] == [("v", "a", 1)]


@pytest.mark.parametrize("seed", range(4))
def test_batch_matches_plain_fold(spark, seed):
    log, end = random_log(seed)
    for as_of in (end, end + timedelta(hours=20), end - timedelta(hours=30)):
        seen = [event for event in log if event[6] <= as_of]
        found = carts.current_carts(spark.createDataFrame(log, SCHEMA), as_of)
        got = sorted((r.user_id, r.product_id, r.quantity, r.price) for r in found.collect())
        assert got == plain_fold(seen, as_of)


def test_stream_matches_plain_fold(spark, tmp_path):
    log, end = random_log(7, 120)
    source = str(tmp_path / "log")
    third = len(log) // 3 + 1
    for part in range(3):
        piece = log[part * third : (part + 1) * third]
        spark.createDataFrame(piece, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)

    latest = {}

    def remember(batch, batch_id):
        for row in batch.collect():
            stamp, items = latest.get(row.user_id, (None, None))
            if stamp != batch_id:
                items = {}
            if row.product_id is not None:
                items[row.product_id] = (row.quantity, row.price)
            latest[row.user_id] = (batch_id, items)

    query = start_job(
        cart_changes(stream, watermark="0 seconds"),
        remember,
        "carts",
        trigger=None,
        output_mode="update",
        checkpoint=str(tmp_path / "checkpoint"),
    )
    query.awaitTermination(120)
    assert query.exception() is None
    got = sorted(
        (user, product, quantity, price)
        for user, (_, items) in latest.items()
        for product, (quantity, price) in items.items()
    )
    # The timer has emptied carts whose time was up at the watermark, the last event's time.
    assert got == plain_fold(log, end)
