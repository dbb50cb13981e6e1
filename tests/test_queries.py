"""Every registered query against its SQL in DuckDB, bit by bit, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_point
import bench
from curvemill.standin import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = entry_point.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    found = [tuple(r[c] for c in columns) for r in df.collect()]
    result = duck.execute(entry_point.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    expected = [tuple(r[i] for i in at) for r in result.fetchall()]
    assert ordered(found) == ordered(expected)
    assert expected, "a check that compares nothing shows nothing"


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL)
    assert set(catalog.QUERIES) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_headlines_are_registered():
    assert set(bench.HEADLINES) <= set(entry_point.queries())
