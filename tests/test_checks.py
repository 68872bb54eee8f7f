"""Every registered query against its SQL, on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as entry
from checks import catalog
from checks.__main__ import TABLES, rows_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_matches_sql(spark, sql, name):
    df = entry.queries()[name](spark, SF_DIR)
    relation = sql.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(relation.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(
        relation.columns, relation.fetchall()
    )


def test_every_query_has_sql():
    assert set(catalog.SQL) == set(catalog.QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["alert_id", "alert_timestamp"]
    assert df.count() > 0
