"""Every registered query against DuckDB, on the smallest data set."""

import pytest
from compare import connect, duck_rows, spark_rows

import __spark_entry__ as driver
from plantroom.plans import all_queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, duck, name):
    columns, found = spark_rows(driver.queries()[name](spark, SF_DIR))
    assert found, "a query without rows checks nothing"
    oracle = driver.oracle_sql()[name]
    expected_columns, expected = duck_rows(duck, oracle)
    assert columns == expected_columns
    assert found == expected


def test_entry(spark):
    assert driver.entry(spark).columns == ["time", "click", "error", "purchase", "signup", "view"]
