"""The ``report_date`` metrics of a range of run days, each from one scan of its inputs.

A backfill over N days is not N runs: every input row is tagged with the run days it belongs to, and one aggregate
computes all of them.  A visit is on site on a stretch of days, from its arrival to its departure, its unloading or 25 days
on; a transaction of a day counts for the runs of a week; capacity and sheet rows belong to one day each.  Rows are
reduced (per warehouse and day) before they are tagged, or tagged after the joins, so tags never multiply a
shuffle.  Each run has the time of day of ``p.ctx.as_of``.  The run's upstream tables (visits, units, warehouses) are
taken as they stand; over the same tables, a range equals the daily runs (tested).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions import calendar as cal
from quayside.functions import scalar as S
from quayside.operators import relops as R
from quayside.plans import inbound_trailers as IT
from quayside.plans import on_yard as OY
from quayside.plans import snapshot as SN
from quayside.plans import throughput as TV
from quayside.plans import yard_utilization as MU
from quayside.plans.fill_rate import fill_rate_for_days
from quayside.plans.project import Project

RES = "inbound_trailer_reservation_id"


class Clock:
    """What a run's clock shows, as columns of its ``run_day`` (SURVEY §7.5: all derives from the run's instant)."""

    def __init__(self, p: Project):
        of_day = p.ctx.as_of - dt.datetime.combine(p.ctx.as_of.date(), dt.time())
        self.now = F.timestamp_add("SECOND", F.lit(int(of_day.total_seconds())), F.col("run_day").cast("timestamp_ntz"))
        self.now_hq = cal.utc_to_zone(self.now, p.ctx.hq_zone)
        self.cutoff = cal.cutoff(F.to_date(self.now_hq), SN_CUTOFF_HOURS)
        self.midnight = cal.cutoff(F.to_date(self.now_hq), 0)
        self.report_date = F.date_sub(F.col("run_day"), 1)


SN_CUTOFF_HOURS = 4  # Fixed value: the on-site snapshot's time of day in New York


def _tagged(df: DataFrame, first: Column, last: Column, days: tuple[dt.date, dt.date]) -> DataFrame:
    """``df`` with a row per ``run_day`` from ``first`` to ``last`` within the range; rows without one are left out."""
    lo, hi = F.greatest(first, cal.lit_date(days[0])), F.least(last, cal.lit_date(days[1]))
    return df.where(lo <= hi).withColumn("run_day", F.explode(F.sequence(lo, hi)))


def snapshot_for_days(p: Project, first: dt.date, last: dt.date) -> DataFrame:
    """M13 per run day: the trailers on site at its 04:00.  The joins see a visit once; its days come after."""
    clock = Clock(p)
    arrival, depart, unload = (F.col(f"trailer_{x}_datetime_local") for x in ("arrival", "depart", "unload"))
    reach = dt.timedelta(days=SN.ON_SITE_LOOKBACK_DAYS + 1)
    yt = (p.ref("dim_yard_trailer")
          .where(R.is_false("is_trailer_cancelled") & (arrival >= cal.lit_ntz(dt.datetime.combine(first - reach, dt.time())))
                 & (arrival < cal.lit_ntz(dt.datetime.combine(last + dt.timedelta(days=1), dt.time()))))
          .select(RES, "warehouse_id", F.col("trailer_scheduled_start_datetime_local").alias("sched"), arrival.alias("yt_arrival"),
                  depart.alias("depart"), unload.alias("unload")))
    ur = p.ref("stg_units_reservation").select(
        RES, F.col("trailer_arrival_datetime_local").alias("ur_arrival"), "trailer_inbound_reservation_units",
        "xd_trailer_reservation_units", "average_subwarehouse_qty", "subwarehouse")
    dw = p.dimension("dim_warehouse", "warehouse_id", "time_zone_hours_offset")
    j = R.lookup_join(yt.join(ur, RES), dw, "warehouse_id", "warehouse_id", "left", keys=yt)
    came = F.to_date("yt_arrival")
    until = [F.date_add(F.to_date(c), 1) for c in ("depart", "unload")]  # New York's day is the run's or the one before
    stay = F.least(F.date_add(came, SN.ON_SITE_LOOKBACK_DAYS), *until)   # nulls do not count
    on_site = _tagged(j, came, stay, (first, last)).where(
        (F.col("yt_arrival") >= F.timestamp_add("DAY", F.lit(-SN.ON_SITE_LOOKBACK_DAYS), clock.now)) & (F.col("yt_arrival") <= clock.cutoff)
        & (F.col("depart").isNull() | (F.col("depart") > clock.cutoff)) & (F.col("unload").isNull() | (F.col("unload") > clock.cutoff)))
    ur_day, sched_day = F.to_date("ur_arrival"), F.to_date("sched")
    now_local = cal.add_hours(clock.now_hq, F.col("time_zone_hours_offset"))
    return on_site.groupBy(
        F.col("run_day"), F.col(RES), F.col("warehouse_id"), F.col("time_zone_hours_offset"),
        F.when(ur_day < sched_day, "arrived_early").when(ur_day == sched_day, "arrived_on_time").when(ur_day > sched_day, "arrived_late")
        .alias("arrival_status"),
        cal.hour_boundaries("sched", "yt_arrival").alias("unload_time_window_at_arrival_hours"),
        cal.hour_boundaries(F.col("sched"), now_local).alias("remaining_unload_time_hours"),
        cal.week_number_sunday(sched_day).alias("trailer_scheduled_start_week_date"),
        F.col("sched").alias("trailer_scheduled_start_datetime_local"), F.col("yt_arrival").alias("trailer_arrival_datetime_local"),
        F.col("subwarehouse")).agg(F.sum(SN.unit_ladder()).alias("sum_trailer_units"))


def inbound_trailers_for_days(p: Project, first: dt.date, last: dt.date, snapshot: DataFrame | None = None) -> DataFrame:
    """M16 per run day: units and SLA breaches per reservation on site."""
    clock = Clock(p)
    snap = (snapshot_for_days(p, first, last) if snapshot is None else snapshot).where(R.like_any("subwarehouse", IT.INBOUND_SUBWAREHOUSES))
    of = ["run_day", "inbound_reservation_id"]
    units = snap.groupBy("run_day", F.col(RES).alias("inbound_reservation_id"), "warehouse_id").agg(F.sum("sum_trailer_units").alias("sum_trailer_units"))
    yt = p.ref("dim_yard_trailer").select(F.col(RES).alias("inbound_reservation_id"), "trailer_arrival_datetime_local",
                                          "trailer_scheduled_start_datetime_local").where(F.col("inbound_reservation_id").isNotNull()).distinct()
    rows = units.join(yt, "inbound_reservation_id", "left").select(
        *of, "warehouse_id", "sum_trailer_units",
        cal.hour_boundaries(clock.cutoff, F.col("trailer_arrival_datetime_local")).alias("since_arrival"),
        (cal.hour_boundaries(clock.midnight, F.col("trailer_scheduled_start_datetime_local")) / 24).alias("since_appointment")).distinct()
    flags = rows.withColumns({
        "out_of_arrival_72_hours": R.flag_int(F.col("since_arrival") > IT.ARRIVAL_SLA_HOURS),
        "out_of_appt_1_day": R.flag_int(F.col("since_appointment") > IT.APPOINTMENT_SLA_DAYS)})
    breaches = flags.groupBy(*of, "out_of_arrival_72_hours", "out_of_appt_1_day").agg(F.sum("sum_trailer_units").alias("units"))
    copies = rows.groupBy(*of, "warehouse_id").agg(F.count(F.lit(1)).alias("n"))
    return copies.join(breaches, of).select(
        "warehouse_id", clock.report_date.alias("report_date"), "inbound_reservation_id",
        (F.col("units") * F.col("n")).cast("double").alias("total_amount_units"), "out_of_arrival_72_hours", "out_of_appt_1_day",
        F.greatest("out_of_arrival_72_hours", "out_of_appt_1_day").alias("out_of_both_sla"))


def on_yard_units_for_days(p: Project, first: dt.date, last: dt.date, snapshot: DataFrame | None = None) -> DataFrame:
    """M17 per run day: units by accountability bucket vs the day's capacity in the newest upload."""
    clock = Clock(p)
    snap = (snapshot_for_days(p, first, last) if snapshot is None else snapshot).where(R.like_any("subwarehouse", OY.ON_YARD_SUBWAREHOUSES))
    res = p.source("reservation").select(F.col("ReservationID").alias(RES), F.col("WarehouseID").alias("res_wh"))
    warehouse = F.when(F.col("warehouse_id").isin(OY.RESERVATION_WAREHOUSE_SITES), F.col("res_wh")).otherwise(F.col("warehouse_id"))
    now_local = cal.add_hours(clock.now_hq, F.col("time_zone_hours_offset"))
    acc = snap.join(res, RES, "left").groupBy(
        "run_day", F.col(RES).alias("inbound_reservation_id"), warehouse.alias("warehouse_id"),
        OY.accountability_bucket(now_local).alias("accountability_bucket")).agg(F.sum("sum_trailer_units").alias("sum_trailer_units"))
    cap = p.source("receiving_capacity")
    latest = cap.agg(F.max("upload_date").alias("upload_date"))  # one row
    days = cap.where(F.col("day_of_unit_capacity").between(cal.lit_date(first - dt.timedelta(days=1)), cal.lit_date(last)))
    per_day = days.join(F.broadcast(latest), "upload_date").select(
        F.date_add("day_of_unit_capacity", 1).alias("run_day"), "warehouse_id", "inbound_unit_capacity")
    return acc.where(F.col("sum_trailer_units").isNotNull()).join(per_day, ["run_day", "warehouse_id"]).select(
        clock.report_date.alias("report_date"), "inbound_reservation_id", "warehouse_id", "accountability_bucket", "sum_trailer_units",
        "inbound_unit_capacity",
        F.round(S.safe_divide(F.col("sum_trailer_units"), F.col("inbound_unit_capacity")), 1).alias("on_yard_units_metric_value"))


def _between(c: str, lo: dt.date, hi: dt.date) -> Column:
    """Days of a timestamp column, as a range its reader can skip by."""
    return (F.col(c) >= cal.lit_ntz(dt.datetime.combine(lo, dt.time()))) & (F.col(c) < cal.lit_ntz(dt.datetime.combine(hi + dt.timedelta(days=1), dt.time())))


def throughput_variance_for_days(p: Project, first: dt.date, last: dt.date) -> DataFrame:
    """M18 per run day.  Inputs are summed per warehouse and day first; a day then counts for the runs whose window holds it."""
    day = F.col("day")
    sunday, saturday = cal.week_start_sunday(day), F.date_add(cal.week_start_sunday(day), 6)
    yesterday = F.col("run_day") == F.date_add(day, 1)
    lo, hi = cal.py_week_start_sunday(first - dt.timedelta(days=1)), last + dt.timedelta(days=6)
    warehouse = F.col("warehouse_id").cast("bigint").alias("warehouse_id")
    of = ["run_day", "warehouse_id"]

    got = p.source("tran_log_units").where(_between("log_datetime_local", lo, hi)).groupBy(
        warehouse, F.to_date("log_datetime_local").alias("day")).agg(F.sum("inbound_receiving_units").alias("units"))
    # the week of a run is its yesterday's, Sunday to Saturday
    received = _tagged(got, F.date_add(sunday, 1), F.date_add(saturday, 1), (first, last)).groupBy(*of).agg(
        F.sum("units").alias("week_units"), F.sum(F.when(yesterday, F.col("units"))).alias("day_units"))

    # of a warehouse's day, the newest upload counts, and for the lag the newest of the week two weeks before the next day's
    upload = F.col("upload_date")
    lag_from = F.date_sub(cal.week_start_sunday(F.date_add(day, 1)), TV.CAPACITY_LAG_DAYS)
    in_lag = upload.between(lag_from, F.date_add(lag_from, 6))
    uploads = (p.source("receiving_capacity").withColumnRenamed("day_of_unit_capacity", "day")
               .where(day.between(cal.lit_date(lo), cal.lit_date(hi))).groupBy("warehouse_id", "day", "upload_date")
               .agg(F.sum("inbound_unit_capacity").alias("units")))
    newest = uploads.groupBy(warehouse, "day").agg(
        F.max_by("units", F.struct(upload.isNotNull(), upload)).alias("units"),
        F.max_by("units", F.when(in_lag, upload)).alias("lag_units"), F.max(F.when(in_lag, upload)).alias("lag_upload"))
    newest = newest.withColumn("lag_units", F.when(F.col("lag_upload").isNotNull(), F.col("lag_units")))
    planned = _tagged(newest, F.date_add(sunday, 1), F.date_add(saturday, 1), (first, last)).groupBy(*of).agg(
        F.sum("units").alias("week_capacity"), F.sum(F.when(yesterday, F.col("units"))).alias("day_capacity"),
        F.sum(F.when(yesterday, F.col("lag_units"))).alias("lag_capacity"))

    number = F.col("freight_class_number")
    label = F.when(number == "1", TV.SP_BINS).when(number > "1", TV.LP).when(number.isNull(), TV.SP_BINS)
    fine = (p.source("tran_log_units_freight").where(_between("log_datetime_local", min(lo, first - dt.timedelta(days=6)), last))
            .groupBy(warehouse, F.to_date("log_datetime_local").alias("day"), "freight_class_id").agg(*TV.pick_sums())
            .join(p.dimension("freight_class", source=True), "freight_class_id").groupBy("warehouse_id", "day", number)
            .agg((F.sum("bulk_pick_units") + F.sum("bins_pick_units")).alias("units")).withColumn("label", label))
    # the day counts for its own week's runs so far, and for the next day's run as yesterday
    out = _tagged(fine, day, F.greatest(saturday, F.date_add(day, 1)), (first, last))
    of_class = lambda cond, name: F.sum(F.when(cond & (F.col("label") == name), F.col("units")))
    total = lambda cond: (of_class(cond, TV.LP) + of_class(cond, TV.SP_BINS)).cast("double")
    shipped = out.groupBy(*of).agg(total(yesterday).alias("shipped_day"), total(F.col("run_day") <= saturday).alias("shipped_week"))

    week_u, day_u, week_c, day_c = F.col("week_units"), F.col("day_units"), F.col("week_capacity"), F.col("day_capacity")
    return received.join(planned, of, "left").join(shipped, of, "left").select(
        F.date_sub(F.col("run_day"), 1).alias("report_date"), "warehouse_id",
        week_u.alias("received_units_actual_week_to_date"), day_u.alias("received_units_actual_reporting_daily"),
        week_c.alias("inbound_unit_receiving_capacity_week_to_date"), day_c.alias("inbound_unit_capacity_reporting_daily"),
        (week_u - week_c).alias("throughput_variance_week_to_date_num"),
        F.nullif(week_c, F.lit(0)).alias("throughput_variance_week_to_date_denominator"),
        day_u.alias("throughput_variance_daily_num"), F.nullif("lag_capacity", F.lit(0)).alias("throughput_variance_daily_denominator"),
        ((week_u - week_c) / F.nullif(week_c, F.lit(0))).alias("throughput_variance_week_to_date"),
        ((day_u - day_c) / F.nullif(day_c, F.lit(0))).alias("throughput_variance_daily"),
        F.col("shipped_day").alias("ob_fc_total_units_shipped_actuals_day"), F.col("shipped_week").alias("ob_fc_total_units_shipped_actuals_week"))


def yard_utilization_for_days(p: Project, first: dt.date, last: dt.date) -> DataFrame:
    """M14 and M19 per run day: the reservations on its yesterday's sheet vs its week's spot capacity."""
    one = dt.timedelta(days=1)
    uploaded = F.col("upload_date")
    start = max(first - one, p.ctx.param("yard_report_min_date", MU.DEFAULT_MIN_REPORT_DATE))
    sheet = p.source("yard_sheet").where(uploaded.between(cal.lit_date(start), cal.lit_date(last - one))).select(
        F.date_add("upload_date", 1).alias("run_day"), F.col("External_Reference").alias("ReservationID"),
        MU.warehouse_of("WarehouseName").alias("warehouse_id")).where(F.col("warehouse_id").isNotNull())
    counted = sheet.groupBy("run_day", "warehouse_id").agg(F.count_distinct("ReservationID").alias("amount_of_units"))
    counted = counted.withColumn("week", cal.week_number_sunday(F.col("run_day"))).withColumn("year", F.year(F.col("run_day")))
    spots = p.source("spot_capacity").select(
        F.col("FCID").alias("warehouse_id"), cal.week_number_sunday("Week").alias("week"), F.year("Week").alias("year"),
        F.col("Yard_Capacity").alias("yard_capacity"))
    # rows of equal capacity are one group; a row counts once per equal row of its week, which a distinct count ignores
    yu = counted.join(spots.distinct(), ["warehouse_id", "week", "year"], "left")
    shared = yu.where(F.col("warehouse_id") == MU.SHARED_CAPACITY_SOURCE).select(
        "run_day", (F.col("yard_capacity") + MU.SHARED_CAPACITY_UPLIFT).alias("shared_capacity"))
    return yu.join(shared, "run_day", "left").select(
        F.date_sub(F.col("run_day"), 1).alias("report_date"), "warehouse_id", "amount_of_units",
        F.when(F.col("warehouse_id").isin(MU.SHARED_CAPACITY_SITES), F.col("shared_capacity")).otherwise(F.col("yard_capacity")).alias("yard_capacity"))


# metric → its rows for a range of run days
RANGE_RUNS: dict[str, Callable[[Project, dt.date, dt.date], DataFrame]] = {
    "metric_fill_rate": fill_rate_for_days,
    "metric_inbound_trailers": inbound_trailers_for_days,
    "metric_on_yard_units": on_yard_units_for_days,
    "metric_throughput_variance": throughput_variance_for_days,
    "metric_yard_utilization": yard_utilization_for_days,
}


def rows_of_range(p: Project, names: list[str], first: dt.date, last: dt.date) -> dict[str, DataFrame]:
    """The rows of each metric over the range; metrics of the on-site snapshot share one, written once."""
    found, snapshot = {}, None
    for name in names:
        run = RANGE_RUNS[name]
        if name in ("metric_inbound_trailers", "metric_on_yard_units"):
            if snapshot is None:
                snapshot = p.stage("snapshot_for_days", snapshot_for_days(p, first, last))
            found[name] = run(p, first, last, snapshot)
        else:
            found[name] = run(p, first, last)
    return found
