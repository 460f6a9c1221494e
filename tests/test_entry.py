"""Every query against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from loghelm.plans.oracle import SQL
from loghelm.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
FITTED = {"fitted_forest", "fitted_centers", "fitted_axes", "fitted_detections"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    clean = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(clean(r[i]) for i in order) for r in rows), key=str)


def test_keys():
    assert set(SQL) == set(QUERIES) - FITTED
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["template", "level", "source", "format", "n"]
    assert rows.count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(got.columns)
    assert canonical(got.columns, got.collect()) == canonical(columns, result.fetchall())


@pytest.mark.parametrize("name", sorted(FITTED))
def test_fitted_queries_run(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0
