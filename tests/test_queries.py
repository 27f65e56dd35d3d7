"""Every registered query against DuckDB at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import rows_of
from shredloom_checks import expected
from shredloom_checks.queries import DRIVER_TABLES, QUERIES

SF_DIR = entry_points.SMOKE_DIR


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in DRIVER_TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(expected.SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = entry_points.queries()[name](spark, SF_DIR).toPandas()
    want = duck.sql(entry_points.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) > 0 and rows_of(got) == rows_of(want)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 1500
