"""Mixing sources to target weights by Poisson replication.

Every source gets a mean repetition rate: its share of the mixed corpus over its share of the given
one. A document's number of copies is the Poisson quantile of a draw that only its id and the seed
decide, so a rerun, a retry or another cluster repeats the same mix, and no task needs to know of
another document. Copies are dealt to partitions and sorted by a digest of id and copy number:
a global shuffle. A source with a third of all rows is no hot key: sizes are summed with partial
aggregates, and rates are the only thing joined by source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.columns import bytes_of, fresh, unit_draw
from tradewind.session import stored

#: Rate of one Poisson draw; a higher rate is the sum of several draws.
MAX_RATE = 500.0


def source_sizes(docs: DataFrame) -> DataFrame:
    """source, docs, size: rows and, as size, UTF-8 bytes of text plus one for each document."""
    return docs.groupBy("source").agg(
        F.count("*").alias("docs"), F.sum(bytes_of(F.col("text")) + 1).alias("size")
    )


def tempered_targets(sizes: DataFrame, exponent: float) -> DataFrame:
    """Target weights proportional to a power of the sizes: 1 keeps the shares, 0 makes them equal."""
    return sizes.select("source", F.pow(F.col("size").cast("double"), F.lit(exponent)).alias("weight"))


def rates(sizes: DataFrame, targets: DataFrame, epochs: float) -> DataFrame:
    """source, rate: mean copies per document, so that the mix is ``epochs`` times the corpus.

    Sources without a target, or with a weight of zero or less, get rate 0. A null source is a
    source like any other.
    """
    wanted = targets.select(F.col("source").alias("target_source"), F.greatest("weight", F.lit(0.0)).alias("weight"))
    both = stored(
        sizes.join(wanted, sizes.source.eqNullSafe(F.col("target_source")), "left")
        .select("source", "size", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    )
    total, weights = both.agg(F.sum("size"), F.sum("weight")).first()
    if not weights:
        return both.select("source", F.lit(0.0).alias("rate"))
    rate = F.lit(float(epochs) * float(total)) * (F.col("weight") / F.lit(float(weights))) / F.col("size")
    return both.select("source", rate.alias("rate"))


def poisson_cdf(rate: Column) -> Column:
    """P(N <= k) for k = 0, 1, ... as far as a double tells them from 1."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30)
    start = F.struct(
        F.exp(-rate).alias("p"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("all")
    )

    def step(done: Column, k: Column) -> Column:
        p = done["p"] * rate / k
        return F.struct(p.alias("p"), (done["sum"] + p).alias("sum"), F.concat(done["all"], F.array(done["sum"] + p)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1).cast("long"), last), start, step, lambda done: done["all"])


def replicate(docs: DataFrame, targets: DataFrame, epochs: float = 1.0, seed: int = 7,
              sizes: DataFrame | None = None) -> DataFrame:
    """Copies of the documents, mixed: all columns, then ``copy_no`` (from 1) and ``mix_key``.

    The rows of a partition are in the order of ``mix_key``, which is independent of everything
    but id and copy number. Rows that share a doc_id share their number of copies. Null texts count as
    empty. Names that ``docs`` already has get an underscore in front. No rows give no rows.
    """
    sizes = stored(source_sizes(docs)) if sizes is None else sizes
    table = rates(sizes, targets, epochs)
    theirs, cdf, draws = fresh(docs, "rate_source"), fresh(docs, "cdf"), fresh(docs, "n_draws")
    copies, key = fresh(docs, "copy_no"), fresh(docs, "mix_key")
    needed = F.greatest(F.lit(1), F.ceil(F.col("rate") / MAX_RATE).cast("int"))
    known = table.select(F.col("source").alias(theirs), needed.alias(draws), poisson_cdf(F.col("rate") / needed).alias(cdf))

    def quantile(draw: Column) -> Column:
        return F.size(F.filter(F.col(cdf), lambda c: c <= draw))

    # Sums of Poisson numbers are Poisson: draws beyond the first are independent of it by their number.
    further = F.transform(F.sequence(F.lit(1), F.col(draws) - 1), lambda n: unit_draw(F.lit(seed), docs["doc_id"], n))
    rest = F.when(F.col(draws) > 1, F.aggregate(further, F.lit(0), lambda n, draw: n + quantile(draw))).otherwise(0)
    count = quantile(unit_draw(F.lit(seed), docs["doc_id"])) + rest
    mixed = (
        docs.join(known, docs["source"].eqNullSafe(known[theirs]), "left")
        .withColumn(copies, count).where(F.col(copies) > 0)
        .withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies))))
        .select(*docs.columns, copies)
    )
    digest = F.md5(F.concat_ws(":", F.lit(f"{seed} order"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                               F.col(copies).cast("string")))
    return mixed.withColumn(key, digest).repartition(key).sortWithinPartitions(key)
