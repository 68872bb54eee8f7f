"""Registering a query together with its SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.inputs import Inputs
from checks.relations import RELATIONS
from tradewind.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Times without a zone and decimals as doubles, as the SQL side returns them."""

    def column(field: T.StructField):
        if isinstance(field.dataType, T.TimestampType):
            return F.col(field.name).cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        return F.col(field.name)

    return df.select(*[column(field) for field in df.schema])


def with_relations(sql: str) -> str:
    """Put the named relations a statement uses in front of it, those they use first."""
    needed: list[str] = []

    def need(text: str) -> None:
        for name, body in RELATIONS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                need(body)
                needed.append(name)

    need(sql)
    if not needed:
        return sql.strip()
    recursive = "RECURSIVE " if "WITH RECURSIVE" in sql else ""
    body = sql.strip()
    if body.upper().startswith("WITH "):
        body = ", " + body[len("WITH RECURSIVE " if recursive else "WITH "):]
    parts = ",\n".join(f"{name} AS ({RELATIONS[name].strip()})" for name in needed)
    return f"WITH {recursive}{parts}\n{body}"


def query(name: str, sql: str | None = None):
    """Register ``build(inputs)`` under ``name``; without SQL only a test covers its values."""

    def register(build: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(Inputs(configure(spark), sf_dir)))

        assert name not in QUERIES, name
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = with_relations(sql)
        return build

    return register
