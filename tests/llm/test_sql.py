"""Corpus queries that SQL can express, against DuckDB."""

from collections import Counter

import duckdb
import pytest

from waymark.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, name):
    data = "/root/testdata/sf0.01"
    duck = duckdb.connect()
    for table in ("documents", "pages", "labels"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    found = duck.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, data)
    assert sorted(got.columns) == sorted(found.columns)
    assert Counter(map(tuple, got.select(*found.columns).collect())) == Counter(found.fetchall())
