"""Every named query against its SQL answer in DuckDB, over the driver's tables."""

import os

import pytest

import __spark_entry__ as contract
from flowengine.plans import catalogue, oracles
from tests.compare import duckdb_rows, spark_rows

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES, ORACLES = catalogue.queries(), oracles.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    frame = QUERIES[name](spark, SF)
    got = spark_rows(frame)
    assert got
    if name in ORACLES:
        columns, want = duckdb_rows(ORACLES[name], SF)
        assert sorted(frame.columns) == columns
        assert got == want


def test_only_known_queries_lack_sql():
    assert set(QUERIES) - set(ORACLES) == {"storage_footprint"}
    assert set(ORACLES) <= set(QUERIES)


def test_contract_registers_all():
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
