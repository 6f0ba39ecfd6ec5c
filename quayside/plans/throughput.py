"""M18 ``metric_throughput_variance``: received units vs capacity, daily and week to date.

The reference scans the transaction log twice and the capacity view twice;
here each is scanned once with a pushed-down date range, and the daily and
week-to-date figures are conditional sums of one aggregate per warehouse.
All inputs of the final left joins are then one row per warehouse.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions import calendar as cal
from quayside.plans.project import Project, model

# Freight class labels of the outbound pivot; the capacity plan's lag in days.
LP, SP_BINS = "Bulk_Picks_LP", "Bulk_Picks_SP_Bins"
CAPACITY_LAG_DAYS = 14


def pick_sums() -> list[F.Column]:
    """The freight log's two pick sums, under their columns' names."""
    return [F.sum(c).alias(c) for c in ("bulk_pick_units", "bins_pick_units")]


def _sum_if(cond: F.Column, c: str) -> F.Column:
    return F.sum(F.when(cond, F.col(c)))


def received(p: Project, yday: dt.date, wtd: tuple[dt.date, dt.date]) -> DataFrame:
    log = p.source("tran_log_units")
    lo, hi = wtd
    day = F.to_date("log_datetime_local")
    rows = log.where((F.col("log_datetime_local") >= cal.lit_ntz(dt.datetime.combine(lo, dt.time())))
                     & (F.col("log_datetime_local") < cal.lit_ntz(dt.datetime.combine(hi + dt.timedelta(days=1), dt.time()))))
    return rows.groupBy(F.col("warehouse_id").cast("bigint").alias("warehouse_id")).agg(
        F.sum("inbound_receiving_units").alias("inbound_receiving_units_wtd"),
        _sum_if(day == cal.lit_date(yday), "inbound_receiving_units").alias("inbound_receiving_units_daily"))


def capacity(p: Project, today: dt.date, yday: dt.date, wtd: tuple[dt.date, dt.date]) -> DataFrame:
    """Planned receiving units per warehouse from one scan of the capacity view: of each (warehouse,
    day), the newest upload (W6, ties kept) counts for the week to date, and the newest one of the
    Sunday week two weeks before this one for yesterday's lagged figure (A17)."""
    lo, hi = wtd
    lag_week = cal.py_week_start_sunday(today) - dt.timedelta(days=CAPACITY_LAG_DAYS)
    day, upload = F.col("day_of_unit_capacity"), F.col("upload_date")
    is_yday = day == cal.lit_date(yday)
    in_wtd = day.between(cal.lit_date(lo), cal.lit_date(hi))
    in_lag = is_yday & upload.between(cal.lit_date(lag_week), cal.lit_date(lag_week + dt.timedelta(days=6)))
    # uploads are summed first, so the newest one is found among few rows per warehouse and day
    per_upload = (p.source("receiving_capacity").where(in_wtd | in_lag)
                  .groupBy("warehouse_id", "day_of_unit_capacity", "upload_date")
                  .agg(F.sum("inbound_unit_capacity").alias("units")))
    of = Window.partitionBy("warehouse_id", "day_of_unit_capacity")
    newest = (per_upload.withColumn("newest", F.max(F.when(in_wtd, upload)).over(of))
                        .withColumn("newest_lag", F.max(F.when(in_lag, upload)).over(of)))
    current = in_wtd & upload.eqNullSafe(F.col("newest"))
    return newest.groupBy(F.col("warehouse_id").cast("bigint").alias("warehouse_id")).agg(
        _sum_if(current, "units").alias("sum_ib_unit_capacity_wtd"),
        _sum_if(current & is_yday, "units").alias("sum_ib_unit_capacity_daily"),
        _sum_if(in_lag & (upload == F.col("newest_lag")), "units").alias("sum_ib_unit_capacity_daily_lag2"))


def shipped(p: Project, today: dt.date, yday: dt.date) -> DataFrame:
    """Outbound units per warehouse, yesterday and this week so far."""
    tl = p.source("tran_log_units_freight")
    fc = p.dimension("freight_class", source=True)
    week_start = cal.py_week_start_sunday(today)
    lo = min(yday, week_start)
    rows = tl.where((F.col("log_datetime_local") >= cal.lit_ntz(dt.datetime.combine(lo, dt.time())))
                    & (F.col("log_datetime_local") < cal.lit_ntz(dt.datetime.combine(today + dt.timedelta(days=1), dt.time()))))
    date = F.to_date("log_datetime_local").alias("date")
    # summed per class id before the classes join: the log is not shuffled by its few ids
    j = rows.groupBy("warehouse_id", date, "freight_class_id").agg(*pick_sums()).join(fc, "freight_class_id")
    num = F.col("freight_class_number")
    label = (F.when(num == "1", SP_BINS).when(num > "1", LP).when(num.isNull(), SP_BINS))
    # grouped by the finer freight class number first, as written
    fine = j.groupBy("warehouse_id", "date", num).agg(
        (F.sum("bulk_pick_units") + F.sum("bins_pick_units")).alias("BulkPick_Units"))
    pivot = (fine.withColumn("Freight_Class", label)
                 .groupBy("warehouse_id", "date").pivot("Freight_Class", [LP, SP_BINS]).agg(F.sum("BulkPick_Units")))
    day, week = F.col("date") == cal.lit_date(yday), F.col("date").between(cal.lit_date(week_start), cal.lit_date(today))
    total = lambda when: (_sum_if(when, LP) + _sum_if(when, SP_BINS)).cast("double")
    return pivot.groupBy(F.col("warehouse_id").cast("bigint").alias("warehouse_id")).agg(
        total(day).alias("ob_fc_total_units_shipped_actuals_day"), total(week).alias("ob_fc_total_units_shipped_actuals_week"))


@model("metric_throughput_variance")
def metric_throughput_variance(p: Project) -> DataFrame:
    today = p.ctx.current_date
    yday = today - dt.timedelta(days=1)
    wtd = cal.py_week_to_date_window(yday)  # the week of yesterday
    a = received(p, yday, wtd)
    j = (a.join(capacity(p, today, yday, wtd), "warehouse_id", "left")
          .join(shipped(p, today, yday), "warehouse_id", "left"))
    wtd_u, day_u = F.col("inbound_receiving_units_wtd"), F.col("inbound_receiving_units_daily")
    wtd_c, day_c = F.col("sum_ib_unit_capacity_wtd"), F.col("sum_ib_unit_capacity_daily")
    out = j.select(
        cal.lit_date(p.ctx.report_date).alias("report_date"), "warehouse_id",
        wtd_u.alias("received_units_actual_week_to_date"),
        day_u.alias("received_units_actual_reporting_daily"),
        wtd_c.alias("inbound_unit_receiving_capacity_week_to_date"),
        day_c.alias("inbound_unit_capacity_reporting_daily"),
        (wtd_u - wtd_c).alias("throughput_variance_week_to_date_num"),
        F.nullif(wtd_c, F.lit(0)).alias("throughput_variance_week_to_date_denominator"),
        day_u.alias("throughput_variance_daily_num"),
        F.nullif(F.col("sum_ib_unit_capacity_daily_lag2"), F.lit(0)).alias("throughput_variance_daily_denominator"),
        ((wtd_u - wtd_c) / F.nullif(wtd_c, F.lit(0))).alias("throughput_variance_week_to_date"),
        ((day_u - day_c) / F.nullif(day_c, F.lit(0))).alias("throughput_variance_daily"),
        "ob_fc_total_units_shipped_actuals_day", "ob_fc_total_units_shipped_actuals_week",
    )
    return out
