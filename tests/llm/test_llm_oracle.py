"""The operators' queries that SQL can express, against DuckDB on the smallest test data."""

from __future__ import annotations

import duckdb
import pytest

from shelfline.llm import oracle, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "conversations", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = queries.queries()[name](spark, FOLDER)
    result = duck.execute(oracle.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    order = lambda names, data: sorted(str([row[names.index(c)] for c in sorted(names)]) for row in data)
    assert order(df.columns, df.collect()) == order(columns, result.fetchall())


def test_every_operator_has_a_query():
    names = list(queries.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
