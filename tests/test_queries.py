"""Every query against the equivalent SQL in DuckDB, on the smallest test tables."""

import compare
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, connection, name):
    assert compare.spark_rows(contract.queries()[name](spark, SF_DIR)) == compare.duckdb_rows(connection, ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(ORACLE)))
def test_query_without_sql_has_rows(spark, name):
    assert contract.queries()[name](spark, SF_DIR).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(contract.queries())


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["customer_id", "product_1", "product_2", "product_3", "product_4", "product_5"]
    assert frame.count() == 74
