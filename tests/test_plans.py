"""Physical-plan checks for the scale-relevant choices."""

import pytest

import __spark_entry__ as E
from farelake.operators import quality as Q
from farelake.plans import fixtures as fx
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_year_filter_reaches_the_scan(spark):
    t = Q.filter_year_in(fx.trips(spark, SF_SMALL), "pickup_datetime", [1996, 1998])
    p = plan(t)
    assert "PushedFilters" in p
    assert "GreaterThanOrEqual(o_orderdate" in p and "LessThan(o_orderdate" in p


def test_scan_reads_only_used_columns(spark):
    q = E.queries()["count_by_month_service"](spark, SF_SMALL)
    p = plan(q)
    assert "l_returnflag" not in p and "l_comment" not in p


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_python_udf_in_any_query(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_top_k_is_a_bounded_take(spark):
    p = plan(E.queries()["top_pickup_zones"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def test_exact_quantiles_do_not_use_the_percentile_aggregate(spark):
    p = plan(E.queries()["percentile_exact"](spark, SF_SMALL))
    assert "percentile(" not in p.lower()


def test_fact_dimension_joins_are_broadcast(spark):
    p = plan(E.queries()["fact_trip"](spark, SF_SMALL))
    assert p.count("BroadcastHashJoin") >= 6
