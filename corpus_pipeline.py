"""A training corpus from raw documents: quality, exact and near dedup, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's documents. All but the last return the columns of their documents, whatever these
are besides doc_id, text, lang and source.

Null and empty texts, and those of less than ten words, fail the quality rules. A null lang is a stratum and a
null source a source of its own. Null ids are ids like others: labels do not reach them. Of rows repeated with
id and text one stays. Very long texts are judged, compared and packed whole. No documents give no rows.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tradewind.llm import exact, mixing, near, packing, quality
from tradewind.llm.queries import MIX_EPOCHS, MIX_EXPONENT, MIX_SEED
from tradewind.session import durable_folder, stored


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules with risk-controlled cutoffs; rejected documents go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.passing(docs, labels)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts stays."""
    return exact.drop_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each component of near copies stays: five-word shingles, similarity 0.8 or more."""
    return near.drop_near_copies(docs, size=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, in a new order."""
    sizes = stored(mixing.source_sizes(docs))
    targets = mixing.tempered_targets(sizes, MIX_EXPONENT)
    return mixing.replicate(docs, targets, MIX_EPOCHS, MIX_SEED, sizes).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of at most 1024 tokens.

    A document that the mix repeats has its pieces as often; they share doc_id, piece and start.
    """
    return packing.pack(docs)


STAGES = [
    ("quality_rules", keep_good),
    ("exact_dedup", drop_exact),
    ("near_dedup", drop_near),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

#: Sketches, cutoffs and tokens are beyond SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the documents of ``sf_dir``."""
    folder = f"{durable_folder(spark)}/corpus/{uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
