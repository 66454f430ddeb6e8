"""Every registered query of the library itself against its SQL, on the smallest data."""

import compare
import pytest

import __spark_entry__ as entry
from driver_queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.duck(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    got = compare.spark_rows(QUERIES[name](spark, FOLDER))
    assert got == compare.sql_rows(con, ORACLES[name])
    assert got[1], "a query over whole tables finds something"


def test_all_are_registered():
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
