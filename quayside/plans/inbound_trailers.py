"""M16 ``metric_inbound_trailers``: units on yard and SLA breaches per reservation.

The reference's last step self-joins the SLA rows on reservation id and sums
over the pairs.  The same totals come from two per-reservation reductions —
the number of left rows per (warehouse, date, reservation) and the unit sum
per (reservation, flags) — joined on reservation id: at most a handful of
rows per reservation meet in that join, however many visits it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import calendar as cal
from quayside.operators import relops as R
from quayside.plans.project import Project, model

RES = "inbound_trailer_reservation_id"
# Subwarehouses counted as inbound on the yard; the two SLA limits.
INBOUND_SUBWAREHOUSES = ["%Inbound%", "%Receiv%", "%VAS%", "SubSatelliteLotRomeoville", "%Rug%"]
ARRIVAL_SLA_HOURS = 72
APPOINTMENT_SLA_DAYS = 1


def sla_calculation(p: Project) -> DataFrame:
    snap = p.ref("stg_unit_snapshot").where(R.like_any("subwarehouse", INBOUND_SUBWAREHOUSES))
    report_date = cal.lit_date(p.ctx.report_date)
    all_trailers = snap.groupBy(F.col(RES).alias("inbound_reservation_id"), "warehouse_id").agg(
        F.sum("sum_trailer_units").alias("sum_trailer_units"))
    yt = p.ref("dim_yard_trailer").select(
        F.col(RES).alias("inbound_reservation_id"), "trailer_arrival_datetime_local",
        "trailer_scheduled_start_datetime_local")
    j = all_trailers.join(yt, "inbound_reservation_id", "left")
    arrival_cutoff = cal.lit_ntz(p.ctx.cutoff_hq)
    appt_cutoff = cal.lit_ntz(p.ctx.appointment_cutoff_hq)
    return j.select(
        report_date.alias("report_date"), "inbound_reservation_id", "warehouse_id",
        cal.hour_boundaries(arrival_cutoff, F.col("trailer_arrival_datetime_local")).alias("unload_diff_arrival"),
        (cal.hour_boundaries(appt_cutoff, F.col("trailer_scheduled_start_datetime_local")) / 24).alias("unload_diff_appt"),
        "sum_trailer_units",
    ).distinct()  # GROUP BY every column (A10)


@model("metric_inbound_trailers")
def metric_inbound_trailers(p: Project) -> DataFrame:
    a = sla_calculation(p)
    flags = a.select(
        "inbound_reservation_id", "sum_trailer_units",
        R.flag_int(F.col("unload_diff_arrival") > ARRIVAL_SLA_HOURS).alias("out_of_arrival_72_hours"),
        R.flag_int(F.col("unload_diff_appt") > APPOINTMENT_SLA_DAYS).alias("out_of_appt_1_day"))
    flags = flags.withColumn("out_of_both_sla", R.flag_int(
        (F.col("out_of_arrival_72_hours") == 1) | (F.col("out_of_appt_1_day") == 1)))
    n_left = a.groupBy("warehouse_id", "report_date", "inbound_reservation_id").agg(F.count(F.lit(1)).alias("n_left"))
    right = flags.groupBy("inbound_reservation_id", "out_of_arrival_72_hours", "out_of_appt_1_day", "out_of_both_sla").agg(
        F.sum("sum_trailer_units").alias("units"))
    out = n_left.join(right, "inbound_reservation_id", "left").select(
        "warehouse_id", "report_date", "inbound_reservation_id",
        (F.col("units") * F.col("n_left")).cast("double").alias("total_amount_units"),
        F.coalesce("out_of_arrival_72_hours", F.lit(0)).alias("out_of_arrival_72_hours"),
        F.coalesce("out_of_appt_1_day", F.lit(0)).alias("out_of_appt_1_day"),
        F.coalesce("out_of_both_sla", F.lit(0)).alias("out_of_both_sla"))
    return out
