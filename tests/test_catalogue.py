"""Every query gives the rows of its SQL."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from txclean import catalogue
from tests.compare import database, duck_bag, spark_bag

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES = catalogue.queries()
ORACLE = catalogue.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_driver_has_every_query():
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["Cleaning Stage", "Reason For Change", "Total Rows Changed"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    columns, rows = spark_bag(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = duck_bag(db, ORACLE[name])
    assert columns == expected_columns
    assert rows.total() == expected.total()
    assert rows == expected
