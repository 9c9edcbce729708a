"""Every registered query against its SQL on DuckDB, over the smallest tables."""

import pytest

import __spark_entry__
from check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
ORACLE = __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(__spark_entry__.queries()))
def test_query_matches_sql(spark, duck, name):
    problem, n = compare(spark, duck, SF_DIR, name, __spark_entry__.queries()[name], ORACLE.get(name))
    assert problem is None
    assert n > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
