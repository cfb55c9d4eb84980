"""Every registered query against its SQL twin, on the smallest tables."""

import os

import pytest

import oracle
from costseries.plans import QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="sample tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = oracle.connect(DATA)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    q = QUERIES[name]
    assert q.sql, "every query has a SQL twin"
    problem = oracle.compare(q.build(spark, DATA), q.sql, duck)
    assert problem in (None, "no rows"), problem


def test_entry_contract(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
