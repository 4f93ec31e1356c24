"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as registry
from check import TABLES, compare

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    line = compare(spark, duck, name, SMALL)
    assert "FAIL" not in line, line


def test_entry(spark):
    assert registry.entry(spark).count() > 0


def test_every_statement_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())
