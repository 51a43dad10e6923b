"""Every registered query against DuckDB on the same tables, whole."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as registered

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        name = file.removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{SF_DIR}/{file}')")
    return connection


def comparable(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    clean = [tuple(_value(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(clean, key=repr)


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


@pytest.mark.parametrize("name", sorted(registered.SQL))
def test_query_agrees_with_duckdb(spark, duck, name):
    df = registered.queries()[name](spark, SF_DIR)
    got = comparable([tuple(r) for r in df.collect()], df.columns)
    result = duck.execute(registered.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    want = comparable(result.fetchall(), columns)
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
    assert got[1], "a query without rows shows nothing"


def test_every_query_has_its_sql():
    assert set(registered.QUERIES) == set(registered.SQL)
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry_runs(spark):
    assert registered.entry(spark).count() > 0
