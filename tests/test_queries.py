"""Every registered raster query against its SQL; those without SQL give rows."""

import pytest

from rasterloom.plans import catalog
from tests import oracle

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return oracle.connection(small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, small, con, name):
    oracle.same(QUERIES[name](spark, small), con, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(catalog.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_filters_reach_the_scan(spark, small):
    plan = QUERIES["point_filter_basic"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in plan and "l_comment" not in plan
    plan = QUERIES["rasterize_majority"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "CartesianProduct" not in plan
