"""M13 ``stg_unit_snapshot``: trailers on site at today's 04:00 (New York).

The on-site filter runs on the materialised trailer dimension, so it reaches
the parquet scan as pushed filters; the group-by is on visit-level columns,
keyed by reservation.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import calendar as cal
from quayside.operators import relops as R
from quayside.plans.project import Project, model

RES = "inbound_trailer_reservation_id"
# Arrivals older than this many days are not on site; the sentinel unit count.
ON_SITE_LOOKBACK_DAYS = 25
SENTINEL_UNITS = 400


def on_site(yt: DataFrame, ctx) -> DataFrame:
    """Arrived in the last 25 days and by the cut-off; not departed and
    not unloaded by the cut-off; not cancelled."""
    cutoff = cal.lit_ntz(ctx.cutoff_hq)
    start = cal.lit_ntz(ctx.current_datetime - dt.timedelta(days=ON_SITE_LOOKBACK_DAYS))
    arrival = F.col("trailer_arrival_datetime_local")
    return yt.where(
        R.is_false("is_trailer_cancelled")
        & arrival.between(start, cutoff)
        & (F.col("trailer_depart_datetime_local").isNull() | (F.col("trailer_depart_datetime_local") > cutoff))
        & arrival.isNotNull()
        & (F.col("trailer_unload_datetime_local").isNull() | (F.col("trailer_unload_datetime_local") > cutoff)))


def unit_ladder() -> F.Column:
    """A2: the unit fallback ladder, branch order as written.  The first branch
    already takes every non-NULL count, so the sentinel branches never fire."""
    tir, xd, avg = F.col("trailer_inbound_reservation_units"), F.col("xd_trailer_reservation_units"), F.col("average_subwarehouse_qty")
    m = tir % SENTINEL_UNITS
    return (F.when(tir.isNotNull() | (m == 0), tir.cast("double"))
             .when(tir.isNull() | (m == 0), F.coalesce(xd.cast("double"), avg))
             .when(m == 0, xd.cast("double"))
             .when(xd == 0, avg))


@model("stg_unit_snapshot")
def stg_unit_snapshot(p: Project) -> DataFrame:
    yt = on_site(p.ref("dim_yard_trailer"), p.ctx).select(
        RES, "warehouse_id", F.col("trailer_scheduled_start_datetime_local").alias("sched"),
        F.col("trailer_arrival_datetime_local").alias("yt_arrival"))
    ur = p.ref("stg_units_reservation").select(
        RES, F.col("trailer_arrival_datetime_local").alias("ur_arrival"), "trailer_inbound_reservation_units",
        "xd_trailer_reservation_units", "average_subwarehouse_qty", "subwarehouse")
    dw = p.dimension("dim_warehouse", "warehouse_id", "time_zone_hours_offset")
    j = R.lookup_join(yt.join(ur, RES), dw, "warehouse_id", "warehouse_id", "left", keys=yt)

    ur_day, sched_day = F.to_date("ur_arrival"), F.to_date("sched")
    status = (F.when(ur_day < sched_day, "arrived_early")
               .when(ur_day == sched_day, "arrived_on_time")
               .when(ur_day > sched_day, "arrived_late"))
    now_local = cal.add_hours(cal.lit_ntz(p.ctx.current_datetime_hq), F.col("time_zone_hours_offset"))
    keys = [
        F.col(RES), F.col("warehouse_id"), F.col("time_zone_hours_offset"),
        status.alias("arrival_status"),
        cal.hour_boundaries("sched", "yt_arrival").alias("unload_time_window_at_arrival_hours"),
        cal.hour_boundaries(F.col("sched"), now_local).alias("remaining_unload_time_hours"),
        cal.week_number_sunday(sched_day).alias("trailer_scheduled_start_week_date"),
        F.col("sched").alias("trailer_scheduled_start_datetime_local"),
        F.col("yt_arrival").alias("trailer_arrival_datetime_local"),
        F.col("subwarehouse"),
    ]
    out = j.groupBy(*keys).agg(F.sum(unit_ladder()).alias("sum_trailer_units"))
    return out
