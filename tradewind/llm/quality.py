"""Quality rules with risk-controlled thresholds.

Every document gets counts (``text_stats``), from which rules make scores. A rule rejects what scores above
its cutoff, and a document goes if any rule rejects it. Cutoffs are chosen per stratum from labelled documents:

* A chain orders the cutoffs of all rules from the one that costs the fewest good documents for the bad ones
  it catches. A point of the chain is a joint vector of cutoffs: those up to there. The chain comes from the bad
  labels and from every fifth good one (by a hash of the id), so it is fixed before the others are looked at.
* Along the chain, the share of the other good labels that the rules *together* reject is tested: an exact
  binomial test must prove it below ``risk``. The first failed test ends the chain (fixed-sequence testing, which
  costs no level); over strata the level is split (Bonferroni). So with probability ``1 - delta`` no stratum loses
  more than ``risk`` of its good documents. With no rejected label, 2 % take about 220 good labels.

Among the proven points the most useful one is taken; without any, the rules of a stratum reject nothing. The
counting of labels and the choice of points are aggregates; nothing is fitted on a sample.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm import tokens
from tradewind.llm.columns import fresh, small_batches
from tradewind.session import stored

CHUNK_BYTES = 1 << 20
REPEAT_WINDOW = 5
#: Every so many good labels serve the order of the chain, the others its tests.
ORDERING = 5
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
STATS_TYPE = T.StructType([T.StructField(name, T.LongType()) for name in STATS])

# Cutoffs a rule may take, from mild to strict.
RULES: dict[str, list[float]] = {
    "symbol_share": [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02, 0.01],
    "dup_lines_per_word": [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02, 0.01],
    "repeat_share": [0.19, 0.17, 0.15, 0.13, 0.11, 0.1, 0.09, 0.08, 0.07, 0.06, 0.05, 0.04, 0.03, 0.02, 0.01],
    "long_words": [40.0, 30.0, 25.0, 20.0, 18.0, 16.0, 15.0, 14.0, 13.0, 12.0, 11.0, 10.0, 9.0, 8.0],
    "short_words": [-1.5, -2.0, -2.5, -2.75, -3.0, -3.25, -3.5, -3.75, -4.0, -4.25, -4.5, -4.75, -5.0],
    "few_words": [-12.0, -15.0, -20.0, -25.0, -30.0, -35.0, -40.0, -45.0, -50.0, -60.0, -75.0, -100.0],
}

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _duplicate_lines(text: bytes) -> int:
    lines = text.split(b"\n")
    if len(lines) < 2:
        return 0
    spoken = [line for line in lines if line.strip(b" \t\n\x0b\x0c\r")]
    return len(spoken) - len(set(spoken))


def _chunk_stats(texts: list[bytes]) -> list[np.ndarray]:
    data, begins = tokens.joined(texts)
    first, last = tokens.words(data)
    hashes = tokens.word_hashes(data, first, last)
    bounds = np.searchsorted(first, begins)
    # Code points: bytes that do not continue one. Blanks are single bytes and never part of a word.
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    symbols = np.concatenate(([0], np.cumsum(_SYMBOL[data])))
    chars = np.concatenate(([0], np.cumsum(points[last] - points[first])))
    every = tokens.windows(hashes, REPEAT_WINDOW)
    repeated = []
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        n = hi - lo - REPEAT_WINDOW + 1
        if n < 2:
            repeated.append(0)
            continue
        own = every[lo : lo + n]
        order = np.argsort(own, kind="stable")
        same = own[order[1:]] == own[order[:-1]]
        covered = np.zeros(hi - lo + 1, dtype=np.int64)
        twice = np.zeros(n, dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        at = np.flatnonzero(twice)
        covered[at] += 1
        covered[at + REPEAT_WINDOW] -= 1
        repeated.append(int(np.count_nonzero(np.cumsum(covered)[: hi - lo])))
    return [
        np.diff(bounds), np.diff(chars[bounds]), np.diff(symbols[begins]),
        np.array([_duplicate_lines(t) for t in texts], dtype=np.int64), np.array(repeated, dtype=np.int64),
    ]


def stats_of(texts: list[bytes]) -> list[np.ndarray]:
    """The five counts of every text, column by column."""
    parts = [_chunk_stats(texts[a:b]) for a, b in tokens.slices([len(t) for t in texts], CHUNK_BYTES)]
    return [np.concatenate([part[i] for part in parts]).astype(np.int64) for i in range(len(STATS))]


@F.arrow_udf(STATS_TYPE)
def text_stats(text: pa.Array) -> pa.Array:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text; null has none."""
    texts = [t or b"" for t in text.cast(pa.binary()).to_pylist()]
    columns = stats_of(texts) if texts else [np.empty(0, dtype=np.int64)] * len(STATS)
    return pa.StructArray.from_arrays([pa.array(c) for c in columns], names=STATS)


# So that a filter on the counts does not count once more for itself below.
text_stats = text_stats.asNondeterministic()


def base_failed(stats: Column) -> Column:
    """Fewer than 10 words, or more than a fifth of the words in repeated windows."""
    return (stats["n_words"] < 10) | (100 * stats["n_repeat_words"] > 20 * stats["n_words"])


def scores(stats: Column) -> dict[str, Column]:
    """What each rule compares with its cutoff; the higher, the worse."""
    n = F.greatest(stats["n_words"], F.lit(1)).cast("double")
    length = stats["word_chars"] / n
    return {
        "symbol_share": stats["n_symbols"] / F.greatest(stats["word_chars"], F.lit(1)).cast("double"),
        "dup_lines_per_word": stats["n_dup_lines"] / n,
        "repeat_share": stats["n_repeat_words"] / n,
        "long_words": length,
        "short_words": -length,
        "few_words": -stats["n_words"].cast("double"),
    }


def _log_tail(k: int, n: int, p: float) -> float:
    """log P(X <= k) of a binomial with n trials."""
    if k >= n:
        return 0.0
    i = np.arange(k + 1)
    log_factorial = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, n + 1)))))
    terms = log_factorial[n] - log_factorial[i] - log_factorial[n - i] + i * math.log(p) + (n - i) * math.log1p(-p)
    top = terms.max()
    return float(top + math.log(np.exp(terms - top).sum()))


def proves(rejected: int, good: int, risk: float, level: float) -> bool:
    """Whether ``rejected`` of ``good`` documents prove a rate below ``risk`` at this level (exact binomial)."""
    return good > 0 and _log_tail(int(rejected), int(good), risk) <= math.log(level)


def _chains(labelled: DataFrame) -> DataFrame:
    """stratum and its chain: an array of (at, rule, cutoff), from the cheapest cutoff for what it catches on."""
    grid = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(float(cut)).alias("cutoff"), (F.col(rule) > cut).alias("over"))
        for rule, cuts in RULES.items() for cut in cuts
    ])
    first = F.col("good") * F.col("orders").cast("long")
    # A row becomes one row per rule and cutoff, summed up before the shuffle.
    counts = (
        labelled.select("stratum", "bad", first.alias("good"), F.explode(grid).alias("g"))
        .groupBy("stratum", F.col("g.rule").alias("rule"), F.col("g.cutoff").alias("cutoff"))
        .agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"),
             F.sum(F.col("good") * F.col("g.over").cast("long")).alias("good_over"),
             F.sum(F.col("bad") * F.col("g.over").cast("long")).alias("bad_over"))
    )
    cost = (F.col("good_over") + F.lit(0.5)) / (F.col("good") + 1)
    worth = (F.col("bad_over") / F.col("bad")) / cost
    in_order = Window.partitionBy("stratum").orderBy(worth.desc(), F.col("bad_over").desc(), "rule", F.col("cutoff").desc())
    return (
        counts.where("bad_over > 0").withColumn("at", F.row_number().over(in_order))
        .groupBy("stratum").agg(F.sort_array(F.collect_list(F.struct("at", "rule", "cutoff"))).alias("chain"))
    )


def cutoffs(labelled: DataFrame, risk: float = 0.02, delta: float = 0.05, worth: float = 50.0) -> DataFrame:
    """stratum and cutoffs (a map from rule to cutoff) of the strata in which some point of the chain is proven.

    ``labelled`` has stratum, good, bad (0/1), orders (whether a good label serves the order of the chain, not
    the tests) and a score per rule. A point is useful by the share of bad documents that it rejects, less
    ``worth`` times the share of tested good ones. Only points with a positive use are taken.
    """
    chains = stored(_chains(labelled))
    own, theirs = F.col("stratum"), F.col("chain_stratum")
    score = F.create_map(*[part for rule in RULES for part in (F.lit(rule), F.col(rule))])
    # Where in the chain a document is rejected first; null for never.
    reached = F.array_min(F.transform("chain", lambda c: F.when(F.col("scores")[c["rule"]] > c["cutoff"], c["at"])))
    tested = F.col("good") * (~F.col("orders")).cast("long")
    counts = stored(
        labelled.withColumn("scores", score).select("stratum", "bad", tested.alias("good"), "scores")
        .join(chains.withColumnRenamed("stratum", "chain_stratum"), own.eqNullSafe(theirs))
        .groupBy("stratum", reached.alias("at")).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    )
    strata = chains.count()
    level = min(delta / max(strata, 1), 1.0)

    @F.pandas_udf("boolean")
    def proven(rejected: pd.Series, good: pd.Series) -> pd.Series:
        return pd.Series([proves(k, n, risk, level) for k, n in zip(rejected, good)], dtype=bool)

    so_far = Window.partitionBy("stratum").orderBy(F.col("at").asc_nulls_last())
    whole = Window.partitionBy("stratum")
    points = (
        counts.select("stratum", "at", F.sum("good").over(so_far).alias("good_over"), F.sum("bad").over(so_far).alias("bad_over"),
                      F.sum("good").over(whole).alias("good"), F.sum("bad").over(whole).alias("bad"))
        .where("at is not null").withColumn("holds", proven("good_over", "good"))
        .withColumn("holds", F.min(F.col("holds").cast("int")).over(so_far) == 1)
    )
    use = F.col("bad_over") / F.greatest("bad", F.lit(1)) - F.lit(worth) * F.col("good_over") / F.greatest("good", F.lit(1))
    chosen = points.withColumn("use", use).where("holds and use > 0").groupBy("stratum").agg(
        F.max_by("at", F.struct("use", -F.col("at"))).alias("until"))
    taken = F.filter("chain", lambda c: c["at"] <= F.col("until"))

    def strictest(rule: str) -> Column:
        return F.array_min(F.transform(taken, lambda c: F.when(c["rule"] == rule, c["cutoff"])))

    entries = F.array(*[F.struct(F.lit(rule).alias("rule"), strictest(rule).alias("cutoff")) for rule in RULES])
    by_rule = F.map_from_entries(F.filter(entries, lambda r: r["cutoff"].isNotNull()))
    return chosen.join(chains.withColumnRenamed("stratum", "chain_stratum"), own.eqNullSafe(theirs)).select("stratum", by_rule.alias("cutoffs"))


def judged(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """``docs`` with a struct column ``quality`` (the counts, base_failed, kept).

    Good is a label with quality 1 that is not toxic, bad one with quality 0; documents that already
    fail the base rules take no part. A null text has no words and fails. Null strata are a stratum of
    their own; a stratum without labels keeps what the base rules keep. Repeated rows are judged alike.
    With several labels for an id, all count. An existing ``quality`` column stays; the new name then gets an underscore.
    """
    small_batches(docs.sparkSession)
    out, cuts = fresh(docs, "quality"), fresh(docs, "cutoffs")
    theirs = fresh(docs, "cutoff_stratum")
    counted = docs.withColumn(out, text_stats("text"))
    stats = F.col(out)
    told = labels.where("quality is not null").select(
        F.col("doc_id").alias("label_id"),
        ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("long").alias("good"),
        (F.col("quality") == 0).cast("long").alias("bad"),
    )
    orders = F.pmod(F.xxhash64("doc_id", F.lit("orders the chain")), F.lit(ORDERING)) == 0
    labelled = (
        docs.select("doc_id", F.col(stratum).alias("stratum"), text_stats("text").alias("s"))
        .where(~base_failed(F.col("s"))).select("doc_id", "stratum", orders.alias("orders"), *[c.alias(n) for n, c in scores(F.col("s")).items()])
        .join(told, F.col("doc_id") == F.col("label_id"))
    )
    # One row per stratum, in a file: Spark sees its size, and broadcasts it instead of shuffling texts by stratum.
    labelled = stored(labelled.drop("doc_id", "label_id"))
    chosen = stored(cutoffs(labelled, risk, delta).select(F.col("stratum").alias(theirs), F.col("cutoffs").alias(cuts)))
    with_cuts = counted.join(chosen, counted[stratum].eqNullSafe(chosen[theirs]), "left")
    rejects = F.lit(False)
    for rule, score in scores(stats).items():
        rejects = rejects | F.coalesce(score > F.col(cuts)[rule], F.lit(False))
    verdict = F.struct(*[stats[name].alias(name) for name in STATS], base_failed(stats).alias("base_failed"),
                       (~base_failed(stats) & ~rejects).alias("kept"))
    return with_cuts.withColumn(out, verdict).select(*docs.columns, out)


def passing(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """The documents that ``judged`` keeps, with their own columns only."""
    verdict = F.col(fresh(docs, "quality"))
    return judged(docs, labels, stratum, risk, delta).where(verdict["kept"]).select(*docs.columns)
