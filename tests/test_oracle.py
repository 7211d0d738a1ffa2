"""Every registered query with an oracle matches DuckDB (small scale for speed)."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, duck

SF = os.environ.get("RISKLOOM_TEST_SF", "/root/testdata/sf0.001")
SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    line = compare(spark, con, name, QUERIES[name], SQL[name], SF)
    assert line.startswith("OK"), line


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0
