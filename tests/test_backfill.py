import datetime as dt

from pyspark.sql import functions as F

from quayside.functions import backfill as B
from quayside.plans.context import RunContext


def test_generic_window_uses_run_bounds_when_condition_holds(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 11)], "d date")
    run = B.backfill_window(F.col("d"), dt.date(2024, 1, 8), dt.date(2024, 1, 10),
                            dt.date(2024, 1, 1), dt.date(2024, 1, 10), True)
    back = B.backfill_window(F.col("d"), dt.date(2024, 1, 8), dt.date(2024, 1, 10),
                             dt.date(2024, 1, 1), dt.date(2024, 1, 10), False)
    manual = B.backfill_window(F.col("d"), dt.date(2024, 1, 8), dt.date(2024, 1, 10),
                               dt.date(2024, 1, 1), dt.date(2024, 1, 10), True, manual_backfill=True,
                               backfill_start=dt.date(2024, 1, 2), backfill_end=dt.date(2024, 1, 3))
    assert df.where(run).count() == 3
    assert df.where(back).count() == 10
    assert df.where(manual).count() == 2


def test_14_day_rule():
    # 2023-10-01 is a Sunday and the first of the month
    assert B.regular_14_day_backfill(RunContext(dt.datetime(2023, 10, 1, 12))) == dt.date(2023, 9, 3)
    # 01:00 UTC on 2024-03-06 is 20:00 in New York
    assert B.regular_14_day_backfill(RunContext(dt.datetime(2024, 3, 6, 1))) == dt.date(2024, 2, 21)
    assert B.regular_14_day_backfill(RunContext(dt.datetime(2024, 3, 6, 12))) == dt.date(2024, 2, 28)


def test_6_month_rule():
    assert B.regular_6_month_backfill(RunContext(dt.datetime(2024, 8, 31, 12))) == dt.date(2024, 2, 29)
    assert B.regular_6_month_backfill(RunContext(dt.datetime(2024, 3, 15, 12))) == dt.date(2023, 9, 15)


def test_daily_runs_equal_one_range_run(spark, tmp_dir):
    """SURVEY §5 (4): N daily runs, written by partition overwrite, equal one run over N days."""
    import os

    from quayside.operators import sinks
    from quayside.plans.context import fixture_context
    from quayside.plans.fill_rate import fill_rate_for_days
    from quayside.plans.project import Project
    from conftest import SF_ORACLE

    path = os.path.join(tmp_dir, "fill_rate")
    last = dt.date(1998, 6, 17)
    days = [last - dt.timedelta(days=i) for i in range(6, -1, -1)]
    base = fixture_context()
    for d in days + [days[3]]:  # the re-run of one day must not change anything
        ctx = RunContext(as_of=dt.datetime.combine(d, base.as_of.time()), params=base.params)
        p = Project.for_sf_dir(spark, SF_ORACLE, ctx)
        sinks.insert_overwrite(p.build("metric_fill_rate"), path)
    daily = spark.read.parquet(path)
    rng = fill_rate_for_days(Project.for_sf_dir(spark, SF_ORACLE, base), days[0], last)
    cols = ["report_date", "warehouse_id", "ship_class", "cadence", "fill_rate_mm", "refresh_date"]
    a = sorted(tuple(r) for r in daily.select(*cols).collect())
    b = sorted(tuple(r) for r in rng.select(*cols).collect())
    assert a == b and len(a) > 0
