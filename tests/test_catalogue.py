"""Every registered query against its SQL twin on the small data."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from forecourt.catalogue.queries import REGISTERED

SMALL = entry_points.SMALL
TABLES = ["lineitem", "part", "pages"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return "~" if value is None else str(value)


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_query(spark, duck, name):
    df = entry_points.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    rows = sorted(tuple(normal(r[c]) for c in columns) for r in df.collect())
    assert rows
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        return
    result = duck.sql(sql)
    assert sorted(result.columns) == columns
    places = [result.columns.index(c) for c in columns]
    assert rows == sorted(tuple(normal(r[i]) for i in places) for r in result.fetchall())


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
