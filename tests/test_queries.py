"""Every registered query beside its SQL, over whole tables."""

import os

import pytest

import __spark_entry__ as entry_file
import compare
from tallymark.plans import all_queries, all_sql

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, duck, name):
    assert name in SQL, "every query so far has SQL"
    assert compare.difference(QUERIES[name](spark, FOLDER), duck, SQL[name]) is None


def test_sql_without_query():
    assert not set(SQL) - set(QUERIES)


def test_entry_registers_them():
    assert set(QUERIES) <= set(entry_file.queries()) and set(SQL) <= set(entry_file.oracle_sql())


def test_entry(spark):
    found = entry_file.entry(spark)
    assert "engagement_rate" in found.columns and found.count() > 0
