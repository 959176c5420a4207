"""Every registered query against its DuckDB SQL."""

import pytest

import __spark_entry__ as contract
from tests.oracle_check import connect, oracle_rows, spark_rows
from wirestar.plans.catalog import QUERIES as CATALOG
from wirestar.sources.staging import owned_staging

QUERIES = contract.queries()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_of_the_library_has_sql():
    assert set(CATALOG) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", CATALOG)
def test_query_equals_sql(spark, duck, sf_dir, name):
    with owned_staging(spark):
        got = spark_rows(QUERIES[name](spark, sf_dir))
    want = oracle_rows(duck, contract.oracle_sql()[name])
    assert got == want
    assert got[1], "a query without rows checks nothing"


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "user_key" and df.count() > 0
