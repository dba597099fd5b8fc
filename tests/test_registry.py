"""Every registered query gives the rows of its SQL, value by value."""

import math
import os

import duckdb
import pytest

from registry import load_all

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
QUERIES = load_all()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(value(row[i]) for i in order) for row in data)


def value(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int, float)):
        return (2, "nan" if isinstance(v, float) and math.isnan(v) else float(v))
    return (3, str(v))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    query = QUERIES[name]
    result = query.run(spark, SF_DIR)
    found = [tuple(r) for r in result.collect()]
    if query.sql is None:
        return
    expected = duck.execute(query.sql)
    columns = [c[0] for c in expected.description]
    assert sorted(result.columns) == sorted(columns)
    assert rows(result.columns, found) == rows(columns, expected.fetchall())
