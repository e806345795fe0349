"""Every registered query against its SQL, run by DuckDB on the same tables."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from shiftwell.catalog import QUERIES
from shiftwell.oracles import SQL

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS FROM '{FOLDER}/{table}.parquet'")
    return connection


def ordered(columns, data):
    """Rows with columns by name, sorted; NaN counts as NULL."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        return None if isinstance(value, float) and math.isnan(value) else value

    return sorted((tuple(plain(row[i]) for i in order) for row in data), key=repr)


# Iterated layouts have tests of their own.
WITHOUT_SQL = {"embedding_layout"}


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - WITHOUT_SQL))
def test_query_agrees_with_sql(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    answer = duck.execute(SQL[name])
    columns = [column[0] for column in answer.description]
    assert sorted(frame.columns) == sorted(columns)
    found = ordered(frame.columns, frame.collect())
    assert found == ordered(columns, answer.fetchall())
    assert found


def test_entry(spark):
    assert entry(spark).count() == 160


def test_every_query_has_sql():
    assert QUERIES.keys() - WITHOUT_SQL == SQL.keys()
    assert queries().items() >= QUERIES.items() and oracle_sql().items() >= SQL.items()
