"""Reading operational tables over JDBC or from Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradewind.schemas import table_schema


def jdbc_options(url: str, user: str, password: str, driver: str = "org.postgresql.Driver") -> dict[str, str]:
    return {"url": url, "user": user, "password": password, "driver": driver}


def jdbc_reader_options(
    table: str,
    split_on: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options for a table read. With ``split_on`` the read runs as parallel range scans.

    A query string would be planned by the database and read by one task, so tables are read as
    they are and filters and columns are left to Spark's pushdown.
    """
    options = {"dbtable": table, "fetchsize": str(fetch_size)}
    if split_on:
        options |= {
            "partitionColumn": split_on,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, connection: dict[str, str], table: str, **split) -> DataFrame:
    reader = spark.read.format("jdbc").options(**connection)
    return reader.options(**jdbc_reader_options(table, **split)).load()


def read_jdbc_query(spark: SparkSession, connection: dict[str, str], query: str) -> DataFrame:
    """Rows of a query the database runs itself; one task reads them all."""
    return spark.read.format("jdbc").options(**connection).option("query", query).load()


def read_table(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """A Parquet table, with its declared schema when ``table`` names one."""
    reader = spark.read.schema(table_schema(table)) if table else spark.read
    return reader.parquet(path)
