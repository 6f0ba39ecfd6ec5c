"""Plan checks over every registered query: no cartesian products or
nested-loop joins, no row-at-a-time Python in the plan."""
import contextlib
import io

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

QUERIES = E.queries()
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_plan_has_no_pairs_or_python(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    plan = buf.getvalue()
    bad = [f for f in FORBIDDEN if f in plan]
    assert not bad, f"{key}: {bad}"


def test_fact_filters_reach_the_scan(spark):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES["metric_fill_rate"](spark, SF_SMALL).explain(mode="formatted")
    plan = buf.getvalue()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan
