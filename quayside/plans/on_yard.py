"""M17 ``metric_on_yard_units``: on-yard units by accountability bucket vs capacity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import calendar as cal
from quayside.functions import scalar as S
from quayside.operators import relops as R
from quayside.plans.project import Project, model

RES = "inbound_trailer_reservation_id"
# Subwarehouses in scope; warehouses whose id is taken from the reservation;
# the unload window in hours.
ON_YARD_SUBWAREHOUSES = ["%SPDomesticInbound%", "%SPCGFInbound%", "%Receiv%", "%VAS%", "%SPO%"]
RESERVATION_WAREHOUSE_SITES = [9, 18]
WINDOW_HOURS = 48


def accountability_bucket(now_local: F.Column) -> F.Column:
    """Two-level CASE; the early branch has no ELSE (NULL), the outer ELSE is a literal.
    The labels are fixed values."""
    status = F.col("arrival_status")
    remaining = F.col("remaining_unload_time_hours")
    week = F.col("trailer_scheduled_start_week_date")
    now_week = cal.week_number_sunday(F.to_date(now_local))
    today_local = F.to_date(now_local).cast("timestamp_ntz")
    early = (F.when((week == now_week) & (F.col("trailer_scheduled_start_datetime_local") > today_local),
                    "appointed_later_this_week")
              .when(week > now_week, "appointed_future_weeks"))
    in_window = remaining.between(-WINDOW_HOURS, 0)
    late = F.when(in_window, "arrived_late_within_48hr_unload_window").otherwise("arrived_late_not_within_48hr_unload_window")
    on_time = F.when(in_window, "within_48hr_window").otherwise("past_48hr_window")
    return (F.when((status == "arrived_early") & (remaining > 0), early)
             .when((status == "arrived_late") & (F.col("unload_time_window_at_arrival_hours") < 0), late)
             .when(status.isin("arrived_early", "arrived_on_time") & (remaining <= WINDOW_HOURS), on_time)
             .otherwise("dude!"))


@model("metric_on_yard_units")
def metric_on_yard_units(p: Project) -> DataFrame:
    snap = p.ref("stg_unit_snapshot").where(R.like_any("subwarehouse", ON_YARD_SUBWAREHOUSES))
    cr = p.source("reservation").select(F.col("ReservationID").alias(RES), F.col("WarehouseID").alias("cr_wh"))
    j = snap.join(cr, RES, "left")
    now_local = cal.add_hours(cal.lit_ntz(p.ctx.current_datetime_hq), F.col("time_zone_hours_offset"))
    wh = F.when(F.col("warehouse_id").isin(RESERVATION_WAREHOUSE_SITES), F.col("cr_wh")).otherwise(F.col("warehouse_id"))
    acc = j.groupBy(F.col(RES).alias("inbound_reservation_id"), wh.alias("warehouse_id"),
                    accountability_bucket(now_local).alias("accountability_bucket")
                    ).agg(F.sum("sum_trailer_units").alias("sum_trailer_units"))

    cap = p.source("receiving_capacity")
    day = cal.lit_date(p.ctx.report_date)
    # the newest upload of all days, not of this day
    cap_day = (R.newest(cap, "upload_date").where(F.col("day_of_unit_capacity") == day)
                  .select("warehouse_id", "inbound_unit_capacity"))
    out = (acc.where(F.col("sum_trailer_units").isNotNull())
              .join(cap_day, "warehouse_id")  # LEFT JOIN then INNER JOIN on its column = inner (J17)
              .select(day.alias("report_date"), "inbound_reservation_id", "warehouse_id", "accountability_bucket",
                      "sum_trailer_units", "inbound_unit_capacity",
                      F.round(S.safe_divide(F.col("sum_trailer_units"), F.col("inbound_unit_capacity")), 1)
                      .alias("on_yard_units_metric_value")))
    return out
