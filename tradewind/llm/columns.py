"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed by the contracts: what separates words, and what a word is.
SPACE_CLASS = r"[\x20\x09-\x0D]"

#: Blocks of a group that are numbered apart.
RANK_BLOCKS = 1024


#: Bytes of text that a Python worker gets at once; it holds several times as much in arrays.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Let Python workers get at most ``BATCH_BYTES`` at once, if the session allows more."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    digits = "".join(c for c in spark.conf.get(name) if c.isdigit())
    if not digits or int(digits) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use."""
    taken = {name.lower() for name in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def whole(text: Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(text, F.lit(""))


def bytes_of(text: Column) -> Column:
    """Length in UTF-8 bytes as a long; null counts as empty."""
    return F.octet_length(whole(text)).cast("long")


def unit_draw(*parts: Column) -> Column:
    """A repeatable number in [0, 1) that depends on ``parts`` only: 52 bits of an MD5 digest.

    MD5 is used as plain hash: other systems have it too, so that they can check the result.
    """
    words = [F.coalesce(part.cast("string"), F.lit("null")) for part in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *words)), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def ranked(df: DataFrame, group: str, order: list[str], out: str) -> DataFrame:
    """``df`` with a rank in ``out``, gapless from 0 within ``group``.

    Rows are numbered within blocks of a group, by a hash of the first column of ``order``, and a block
    begins where the blocks before it end. So no task sorts a whole group, however large. ``df`` is read
    twice. Rows that are alike in ``group`` and ``order`` can swap ranks.
    """
    blocked = df.withColumn("rank_block", F.pmod(F.xxhash64(order[0], F.lit("block")), F.lit(RANK_BLOCKS)).cast("int"))
    sizes = blocked.groupBy(group, "rank_block").agg(F.count("*").alias("rows"))
    before = Window.partitionBy(group).orderBy("rank_block").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select(group, "rank_block", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rank_begin"))
    within = F.row_number().over(Window.partitionBy(group, "rank_block").orderBy(*order)) - 1
    return (
        blocked.withColumn(out, within)
        .join(begins, [group, "rank_block"])
        .withColumn(out, F.col("rank_begin") + F.col(out))
        .drop("rank_block", "rank_begin")
    )
