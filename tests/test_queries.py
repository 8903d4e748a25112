"""Registered queries against their SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from testbed.compare import check, duck
from testbed.queries import QUERIES

SF = "/root/testdata/sf0.001"
# the training-data operators have their own tests in tests/llm
NAMES = list(QUERIES)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    assert check(spark, con, SF, name, entry.queries()[name], entry.oracle_sql().get(name)) is None


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["obs_code", "description", "n_observations", "avg_value"]
