"""Every registered query against its SQL, over whole tables."""

import pytest

import __spark_entry__ as driver
from oracle import TESTDATA, differences, duck_rows
from storeflow.catalog import QUERIES

FOLDER = str(TESTDATA / "sf0.01")


def test_every_query_has_sql():
    """Of the main library; text and vector queries without SQL have tests of their own."""
    assert set(QUERIES) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_sql(spark, name):
    result = driver.queries()[name](spark, FOLDER)
    expected = duck_rows(FOLDER, driver.oracle_sql()[name])
    assert expected.num_rows > 0
    assert differences(result, expected) == []


def test_entry(spark):
    result = driver.entry(spark)
    small = str(TESTDATA / "sf0.001")
    assert differences(result, duck_rows(small, driver.oracle_sql()["units_by_product"])) == []
