import pytest

import __spark_entry__ as driver
from oracle import compare, connect

from rivulet.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(driver.queries()) >= set(QUERIES) and set(driver.oracle_sql()) >= set(ORACLES)


def test_entry_runs(spark):
    assert driver.entry(spark).limit(5).count() == 5


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, con, sf_dir, name):
    assert compare(spark, con, name, sf_dir, QUERIES[name], ORACLES[name]) is None
