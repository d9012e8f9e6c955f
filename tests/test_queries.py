"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest

import __spark_entry__ as entry
from candlehouse.workload.oracle import ORACLE
from candlehouse.workload.queries import QUERIES
from compare import connect, difference


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLE[name]) is None


def test_every_query_is_registered_and_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_plans_of_marts_are_short(spark, sf_dir):
    """Marts read the stored fact and dimension, and hash their groups."""
    for name in ("mv_daily", "mv_hourly", "mv_symbol"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") <= 3, name
        assert "SortAggregate" not in plan and "RoundRobin" not in plan, name


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
