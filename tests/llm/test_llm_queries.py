"""The subpackage's queries: against their SQL, and the pipeline stage by stage."""

import os

import duckdb
import pytest
from test_queries import ordered

from shiftwell.llm.oracles import SQL
from shiftwell.llm.queries import QUERIES

FOLDER = os.environ.get("LLM_FOLDER", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        duck.execute(f"CREATE VIEW {table} AS FROM '{FOLDER}/{table}.parquet'")
    frame = QUERIES[name](spark, FOLDER)
    answer = duck.execute(SQL[name])
    columns = [column[0] for column in answer.description]
    assert sorted(frame.columns) == sorted(columns)
    found = ordered(frame.columns, frame.collect())
    assert found == ordered(columns, answer.fetchall())
    assert found


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
