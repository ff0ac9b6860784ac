"""Every registered query against its SQL, on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry_points
from compare import connect, duckdb_result, spark_result

FOLDER = "/root/testdata/sf0.001"
# The training-data queries have tests of their own.
QUERIES = {n: q for n, q in entry_points.queries().items() if not re.match(r"op\d+_|pipeline$", n)}
ORACLE = {n: q for n, q in entry_points.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, database, name):
    types, rows = spark_result(QUERIES[name](spark, FOLDER))
    expected_types, expected = duckdb_result(database, ORACLE[name])
    assert types == expected_types
    assert rows == expected


def test_entry(spark):
    assert entry_points.entry(spark).count() == 9
