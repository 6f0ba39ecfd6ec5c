"""A range of run days written in one pass equals the daily runs over the same upstream tables."""
import datetime as dt
import os

import pytest

from conftest import SF_SMALL
from quayside.plans.context import RunContext, fixture_context
from quayside.plans.project import Project
from quayside.plans.range_runs import RANGE_RUNS
from quayside.plans.run import backfill_metrics, run_models

UPSTREAM = ["dim_warehouse", "dim_yard_trailer", "stg_units_reservation"]
FIRST, LAST = dt.date(1998, 6, 13), dt.date(1998, 6, 16)  # Saturday to Tuesday: two Sunday weeks


def rows(spark, path):
    df = spark.read.parquet(path)
    return sorted((str(tuple(r)) for r in df.select(*sorted(df.columns)).collect()))


def test_backfill_writes_what_daily_runs_write(spark, tmp_dir):
    base = fixture_context()
    daily, ranged = os.path.join(tmp_dir, "daily"), os.path.join(tmp_dir, "ranged")
    run_models(Project.for_sf_dir(spark, SF_SMALL, base), UPSTREAM, ranged)
    metrics = list(RANGE_RUNS)
    for k in range((LAST - FIRST).days + 1):
        ctx = RunContext(as_of=dt.datetime.combine(FIRST + dt.timedelta(days=k), base.as_of.time()), params=base.params)
        p = Project.for_sf_dir(spark, SF_SMALL, ctx)
        for name in UPSTREAM:
            p._built[name] = spark.read.parquet(os.path.join(ranged, name))
        run_models(p, metrics, daily)
    bounds = {"manual_backfill": True, "backfill_start": FIRST, "backfill_end": LAST}
    p = Project.for_sf_dir(spark, SF_SMALL, RunContext(as_of=base.as_of, params={**base.params, **bounds}))
    backfill_metrics(p, metrics, ranged)
    for name in metrics:
        got, want = rows(spark, os.path.join(ranged, name)), rows(spark, os.path.join(daily, name))
        assert got == want and got, name


def test_a_backfill_needs_its_bounds(spark, tmp_dir):
    with pytest.raises(ValueError, match="backfill_start"):
        backfill_metrics(Project.for_sf_dir(spark, SF_SMALL, fixture_context()), ["metric_fill_rate"], tmp_dir)
