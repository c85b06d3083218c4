"""Registered tables, ad-hoc SQL and JDBC databases."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def execute_query(spark: SparkSession, sql: str, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Run SQL over registered tables; ``tables`` are registered as views first."""
    for name, df in (tables or {}).items():
        register_view(df, name)
    return spark.sql(sql)


def cached(df: DataFrame) -> DataFrame:
    """Keep a table that several reports read; blocks that do not fit in memory go to disk."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def jdbc_url(host: str, database: str, port: int = 5432) -> str:
    return f"jdbc:postgresql://{host}:{port}/{database}"


def jdbc_options(url: str, user: str, password: str, fetch_size: int = 10_000, **options: object) -> dict[str, str]:
    return {
        "url": url,
        "user": user,
        "password": password,
        "driver": "org.postgresql.Driver",
        "fetchsize": str(fetch_size),
        **{k: str(v) for k, v in options.items()},
    }


def paging_options(column: str, lower: int, upper: int, pages: int) -> dict[str, str]:
    """Read a database table in ``pages`` ranges of a numeric, date or timestamp column."""
    if pages < 1:
        raise ValueError("pages must be at least 1")
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(pages),
    }


def read_jdbc_query(spark: SparkSession, sql: str, options: Mapping[str, str]) -> DataFrame:
    """The database runs ``sql``; its result arrives over one connection, so keep it small."""
    return spark.read.format("jdbc").options(**options).option("query", sql).load()


def read_jdbc_table(spark: SparkSession, table: str, options: Mapping[str, str], paging: Mapping[str, str]) -> DataFrame:
    """A whole database table over parallel connections; see ``paging_options``."""
    return spark.read.format("jdbc").options(**options).options(**paging).option("dbtable", table).load()
