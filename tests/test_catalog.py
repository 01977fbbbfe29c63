"""Every registered query against its SQL, or at least for rows."""

from __future__ import annotations

import pytest
from compare import difference, duck

from martloom.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, sf_dir, name):
    assert difference(spark, con, name, sf_dir) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_points(spark):
    import __spark_entry__ as driver

    assert driver.queries().keys() >= QUERIES.keys()
    assert driver.oracle_sql().keys() >= ORACLES.keys()
    assert driver.queries().keys() >= driver.oracle_sql().keys()
    assert driver.entry(spark).columns[0] == "order_id"
