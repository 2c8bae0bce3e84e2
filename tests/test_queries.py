"""Every registered query with SQL gives the rows DuckDB gives."""

import math

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
SQL = contract.oracle_sql()
QUERIES = contract.queries()


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def shown(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(float(value)) if isinstance(value, float) else str(value)


def by_name(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(shown(row[i]) for i in order) for row in rows)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, folder, name):
    frame = QUERIES[name](spark, folder)
    got = by_name(frame.columns, [tuple(r) for r in frame.collect()])
    result = duck.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert got == by_name(columns, result.fetchall())


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["region", "Focus", "Recomm", "count"]
    assert frame.count() > 0
