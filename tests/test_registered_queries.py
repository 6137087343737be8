"""Every registered query against its SQL on the smallest tables, and what its plan must not contain."""

import pytest

import __spark_entry__ as driver
from dupelens.queries import check_sql, spark_queries
from tests.compare import compare, connect
from tests.conftest import SF_SMALL

QUERIES = spark_queries()
SQL = check_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_SMALL)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    if name in SQL:
        problem, _ = compare(name, frame, duck, SQL[name])
        assert problem is None, problem
    else:
        assert frame.count() > 0


def test_entry_is_stable(spark):
    frame = driver.entry(spark)
    assert frame.columns == ["song_id", "product_indicator", "asset_type", "group_key", "copy_count"]
    assert frame.count() > 0


def test_scan_filters_and_columns_reach_the_files(spark):
    plan = QUERIES["pairs_by_type"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "o_orderdate" not in plan
    plan = QUERIES["backlog_catalog_a"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "PushedFilters: [" in plan
    assert "WindowGroupLimit" in plan
