"""Every named query against plain SQL on the same tables."""

import pytest

import __spark_entry__ as driver
from checks.compare import connect, difference
from checks.oracle import ORACLES
from tallyhouse.plans import catalog
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_a_twin():
    assert set(catalog.queries()) == set(ORACLES)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query_matches_sql(spark, duck, name):
    actual = catalog.queries()[name](spark, SMALL).toArrow()
    expected = duck.sql(ORACLES[name]).to_arrow_table()
    assert difference(actual, expected) is None


def test_entry(spark):
    assert driver.entry(spark).count() == 9
