"""The queries that apply the operators to the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import exact, language, manifest, mixing, near, near_vectors, packing, passages, quality, sharding, suffixes, url_rules, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# The rules of the URL query.
URL_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]
SHARDS = 24
MIX_EXPONENT = 0.7
MIX_EPOCHS = 1.0
MIX_SEED = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return url_rules.judge_urls(pages, rules).select("page_id", "url_verdict.*")


@query
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near.near_groups(table(spark, sf_dir, "documents"), size=4)
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.judged(docs, table(spark, sf_dir, "labels")).select("doc_id", "quality.*")


@query
def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sizes = mixing.stored(mixing.source_sizes(docs))
    targets = mixing.tempered_targets(sizes, MIX_EXPONENT)
    return mixing.replicate(docs, targets, MIX_EPOCHS, MIX_SEED, sizes)


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact.document_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query
def op3_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = suffixes.repeated_strings(table(spark, sf_dir, "documents"))
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_all(table(spark, sf_dir, "documents"))


@query
def op9_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.fuzzy_passages(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_repeated", F.size("passages").alias("n_passages"),
        F.array_sort(F.array_distinct("passages.partner")).alias("partners"), "passages",
    )


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    each = white.select("vec_id", "whitening.*").withColumn("c", F.explode("coordinates"))
    return each.select("vec_id", "c.component", "n", "deviation", "c.whitened", "c.explained", "identity_error")


@query
def op12_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    altered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    read = F.when(altered, F.translate("text", capitals, capitals.lower())).otherwise(F.col("text"))
    return manifest.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], {"text": read})
