"""M15 ``metric_fill_rate``: on-time ratio over four date windows.

The reference scans the fill-rate fact four times (one UNION ALL branch per
cadence).  Here the fact is scanned once: a pushed-down range filter keeps
only the days any window can hold, each row is tagged with the cadences whose
window contains its date (``explode`` of an array of labels, no shuffle), and
one partial+final hash aggregate computes every cadence together.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import calendar as cal
from quayside.functions import scalar as S
from quayside.operators import relops as R
from quayside.plans.project import Project, model

GRAIN = ["warehouse_id", "report_date", "cadence", "ship_class"]


def cadence_windows(today: dt.date) -> list[tuple[str, dt.date, dt.date]]:
    """(label, first day, last day) for each cadence, from the UTC 'today'."""
    d = dt.timedelta
    return [
        ("daily", today - d(days=1), today - d(days=1)),
        ("weekly", cal.py_week_start_sunday(today), today),
        ("last3days", today - d(days=3), today - d(days=1)),
        ("daybeforeyesterday", today - d(days=2), today - d(days=2)),
    ]


def fill_rate_base(p: Project) -> DataFrame:
    """``fill_rate_cte``: filtered fact with warehouse and facility type attached."""
    fr = p.source("weekly_fill_rate").where(
        (F.col("performanceexclusions") == 0) & (F.col("OrderType_Performance") == "Standard"))
    wh = p.dimension("dim_warehouse", "warehouse_string_id")
    ft = p.dimension("facility_type", "wh_id", "FacilityType", source=True)
    j = (fr.join(wh, fr.whid == wh.warehouse_string_id, "left")
           .join(ft, wh.warehouse_string_id == ft.wh_id, "left"))
    return j.select(
        F.col("whid").alias("warehouse_id"),
        F.col("shipclass").alias("ship_class"),
        F.col("FacilityType").alias("is_middle_mile"),
        "cptdatetime", "ShippedOnTime",
    )


@model("metric_fill_rate")
def metric_fill_rate(p: Project) -> DataFrame:
    today = p.ctx.current_date
    windows = cadence_windows(today)
    lo = min(w[1] for w in windows)
    hi = max(w[2] for w in windows)
    base = fill_rate_base(p)
    # range filter on the raw timestamp so the parquet reader can skip row groups
    base = base.where((F.col("cptdatetime") >= cal.lit_ntz(dt.datetime.combine(lo, dt.time())))
                      & (F.col("cptdatetime") < cal.lit_ntz(dt.datetime.combine(hi + dt.timedelta(days=1), dt.time()))))
    day = F.to_date("cptdatetime")
    labels = F.array_compact(F.array(*[
        F.when(day.between(cal.lit_date(a), cal.lit_date(b)), F.lit(name)) for name, a, b in windows]))
    tagged = base.select("warehouse_id", "ship_class", "is_middle_mile", "ShippedOnTime",
                         F.explode(labels).alias("cadence"))
    agg = tagged.groupBy(
        F.col("warehouse_id").cast("bigint").alias("warehouse_id"), "ship_class", "is_middle_mile", "cadence",
    ).agg(S.null_safe_ratio(F.sum("ShippedOnTime"), F.count("ShippedOnTime")).alias("fill_rate_mm"))
    out = agg.select(
        "warehouse_id", "ship_class", "is_middle_mile",
        cal.lit_date(p.ctx.report_date_hq).alias("report_date"),
        F.col("fill_rate_mm").cast("double").alias("fill_rate_mm"),
        cal.lit_ntz(p.ctx.current_datetime_hq).alias("refresh_date"),
        "cadence",
    )
    return out


def fill_rate_for_days(p: Project, first_day: dt.date, last_day: dt.date) -> DataFrame:
    """Backfill: the fill-rate model for every run day in [first_day, last_day] in one scan.

    A row dated ``d`` belongs to the run of day ``t`` (``t`` = the run's UTC
    date) when ``d`` lies in one of that run's windows: daily ``t = d+1``,
    day-before-yesterday ``t = d+2``, last three days ``t ∈ d+1..d+3``, weekly
    ``t ∈ d..Saturday(d)``.  Each row is tagged with at most twelve
    (run day, cadence) pairs, kept only inside the requested range, and one
    aggregate computes every run at once — equal to running the model once
    per day (each run at the same time of day as ``p.ctx.as_of``).
    """
    base = fill_rate_base(p)
    lo = min(first_day - dt.timedelta(days=3), cal.py_week_start_sunday(first_day))
    base = base.where((F.col("cptdatetime") >= cal.lit_ntz(dt.datetime.combine(lo, dt.time())))
                      & (F.col("cptdatetime") < cal.lit_ntz(dt.datetime.combine(last_day + dt.timedelta(days=1), dt.time()))))
    d = F.to_date("cptdatetime")
    saturday = F.date_add(cal.week_start_sunday(d), 6)

    def tag(days, cadence):
        return F.struct(F.date_add(d, days).alias("run_day"), F.lit(cadence).alias("cadence"))
    weekly = F.transform(F.sequence(d, saturday), lambda t: F.struct(t.alias("run_day"), F.lit("weekly").alias("cadence")))
    tags = F.concat(F.array(tag(1, "daily"), tag(2, "daybeforeyesterday"),
                            tag(1, "last3days"), tag(2, "last3days"), tag(3, "last3days")), weekly)
    tagged = (base.select("warehouse_id", "ship_class", "is_middle_mile", "ShippedOnTime", F.explode(tags).alias("t"))
                  .where(F.col("t.run_day").between(cal.lit_date(first_day), cal.lit_date(last_day))))
    agg = tagged.groupBy(
        F.col("warehouse_id").cast("bigint").alias("warehouse_id"), "ship_class", "is_middle_mile",
        F.col("t.run_day").alias("run_day"), F.col("t.cadence").alias("cadence"),
    ).agg(S.null_safe_ratio(F.sum("ShippedOnTime"), F.count("ShippedOnTime")).alias("fill_rate_mm"))
    tod = p.ctx.as_of - dt.datetime.combine(p.ctx.as_of.date(), dt.time())
    run_ts = F.timestamp_add("SECOND", F.lit(int(tod.total_seconds())), F.col("run_day").cast("timestamp_ntz"))
    ny = cal.utc_to_zone(run_ts, p.ctx.hq_zone)
    return agg.select(
        "warehouse_id", "ship_class", "is_middle_mile",
        F.date_sub(F.to_date(ny), 1).alias("report_date"),
        F.col("fill_rate_mm").cast("double").alias("fill_rate_mm"),
        ny.alias("refresh_date"), "cadence",
    )
