"""Every training-data query with an SQL answer against it, over the given tables."""

import os

import duckdb
import pytest

from flowengine.llm import oracles, queries
from tests.compare import rows, spark_rows

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = ("documents", "embeddings", "pages", "labels", "benchmark")


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query(spark, name):
    frame = queries.queries()[name](spark, SF)
    got = spark_rows(frame)
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    cursor = con.execute(oracles.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    assert got and got == rows(columns, cursor.fetchall())
