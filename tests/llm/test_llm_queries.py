"""The registered queries that SQL can express, against it."""

import os

import duckdb
import pytest

from gapweave.llm import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not there")


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    found = queries.queries()[name](spark, FOLDER)
    answer = connection.execute(queries.oracle_sql()[name])
    columns = sorted(d[0] for d in answer.description)
    where = [[d[0] for d in answer.description].index(c) for c in columns]
    assert sorted(found.columns) == columns
    want = sorted(repr([r[i] for i in where]) for r in answer.fetchall())
    assert sorted(repr([r[c] for c in columns]) for r in found.collect()) == want


def test_every_operator_is_registered():
    names = [n.split("_")[0] for n in queries.queries()]
    assert names == [f"op{i}" for i in range(1, 14)]
