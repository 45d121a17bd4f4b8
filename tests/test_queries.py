"""Every registered query against its SQL oracle on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not there")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def comparable(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return ""
        return repr(round(v, 6) + 0.0) if isinstance(v, float) else repr(v)

    return sorted([cell(r[i]) for i in order] for r in rows)


@pytest.mark.parametrize("name", list(entry.series_queries()))
def test_query_equals_oracle(spark, oracle, name):
    df = entry.queries()[name](spark, FOLDER)
    answer = oracle.execute(entry.series_sql()[name])
    columns = [d[0] for d in answer.description]
    assert sorted(df.columns) == sorted(columns)
    assert comparable(df.collect(), df.columns) == comparable(answer.fetchall(), columns)


def test_entry(spark):
    assert entry.entry(spark).count() == 15 * 720
