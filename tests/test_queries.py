"""Every registered query against its SQL on the smallest data set."""

import os

import pytest

import __spark_entry__ as driver
from zilverspoor import checks
from zilverspoor.checks.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not there")


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_of_the_engine_has_an_oracle():
    assert set(checks.oracle_sql()) == set(checks.queries())
    assert set(checks.queries()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(checks.queries()))
def test_query(spark, connection, name):
    problem = compare(driver.queries()[name](spark, FOLDER), connection, driver.oracle_sql()[name])
    assert problem is None
