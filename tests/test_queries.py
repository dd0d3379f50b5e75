"""Every registered query gives what its SQL says."""

from __future__ import annotations

import pytest
from compare import connect, duck_rows, spark_rows

import __spark_entry__ as driver
from checks import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF))
    expected_columns, expected = duck_rows(duck, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected
    assert rows


def test_entry(spark):
    top = driver.entry(spark)
    assert top.columns == ["game_name", "category", "sub_category", "sentiment", "count", "rank"]
    assert top.count() > 0
