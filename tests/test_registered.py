"""Every registered query against its SQL twin in an independent engine, and its plan."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from verify.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert got or name in ("missing_labels",), "no rows"
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "MapInPandas" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    spark.catalog.clearCache()
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = Counter(tuple(plain(row[p]) for p in places) for row in result.fetchall())
    assert got == want
