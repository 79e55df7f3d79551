"""Flow files as SQL tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowengine.schema import FLOW_SCHEMA

_OPTIONS = {"csv": {"header": "true", "quote": ""}}


def register_tables(spark: SparkSession, database: str, tables: dict[str, tuple[str, str]]) -> DataFrame:
    """(re)create external tables {name: (format, path)} and list the database."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, (fmt, path) in tables.items():
        table = f"{database}.{name}"
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(
            table, path=path, source=fmt, schema=FLOW_SCHEMA, **_OPTIONS.get(fmt, {})
        )
    return spark.sql(f"SHOW TABLES IN {database}")


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    """B14."""
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
