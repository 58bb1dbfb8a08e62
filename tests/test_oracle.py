"""Every query with SQL against DuckDB on the small tables."""

import math
from collections import Counter

import duckdb
import pytest

from waymark import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def tidy(value):
    return float(f"{value:.9g}") if isinstance(value, float) and not math.isnan(value) else value


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, duck, name):
    relation = duck.sql(catalog.oracle_sql()[name])
    columns = list(relation.columns)
    want = Counter(tuple(map(tidy, row)) for row in relation.fetchall())
    frame = catalog.queries()[name](spark, DATA)
    assert sorted(frame.columns) == sorted(columns)
    got = Counter(tuple(map(tidy, row)) for row in frame.select(*columns).collect())
    assert got == want, (list((got - want))[:3], list((want - got))[:3])
