"""Every registered query against its oracle SQL on the smallest test data."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from shelfline_checks import oracle, queries

FOLDER = "/root/testdata/sf0.001"
GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES, ORACLE = queries.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in GIVEN:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    yield connection
    connection.close()


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


def rows(columns, data):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(row[i]) for i in order) for row in data), key=str)


def test_same_names():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    result = duck.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, df.collect()) == rows(columns, result.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
