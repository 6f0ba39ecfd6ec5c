"""M14 ``stg_yard_utilization`` and M19 ``metric_yard_utilization``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import calendar as cal
from quayside.operators import relops as R
from quayside.plans.project import Project, model

# Warehouse-name patterns → warehouse id, first match wins.
WAREHOUSE_NAME_RULES = [
    ("%Hebron%", 5), ("%Perris%", 9), ("%Erlanger%", 10), ("%13%", 13), ("%23%", 23),
    ("%McDonough%", 17), ("%Mississauga%", 21), ("%Lancaster%", 24), ("%Florence%", 22),
    ("%Port Wentworth%", 25), ("%Lathrop%", 26), ("%Jacksonville%", 28), ("%CranburySmall%", 31),
    ("%Aberdeen%", 35), ("%Romeoville%", 42), ("%Richmond%", 45), ("%Greensboro%", 15),
    ("%South Elgin%", 30),
]
# Warehouses reported with warehouse 9's capacity plus an uplift.
SHARED_CAPACITY_SITES = [18, 9]
SHARED_CAPACITY_SOURCE = 9
SHARED_CAPACITY_UPLIFT = 350
# Fixed value: the report keeps uploads from this date on (a parameter, see RunContext.params).
DEFAULT_MIN_REPORT_DATE = dt.date(2024, 1, 1)


def warehouse_of(name: str) -> F.Column:
    """Ordered LIKE rules; ``%13%`` and ``%23%`` match any name containing those digits."""
    return R.first_match(name, WAREHOUSE_NAME_RULES).cast("bigint")


@model("stg_yard_utilization")
def stg_yard_utilization(p: Project) -> DataFrame:
    """Distinct reservations per warehouse on yesterday's sheet upload vs this week's spot capacity.

    The reference's SELECT DISTINCT before COUNT(DISTINCT) changes nothing
    and is left out; the warehouse CASE is computed once and used both as the
    join key and as the output (J10).
    """
    yday = p.ctx.report_date
    sheet = (p.source("yard_sheet")
             .where(F.col("upload_date").isNotNull() & (F.col("upload_date") == cal.lit_date(yday)))  # S4
             .select(F.col("External_Reference").alias("ReservationID"), "upload_date",
                     warehouse_of("WarehouseName").alias("warehouse_id")))
    today = p.ctx.current_date
    cap = (p.source("spot_capacity")
           .where((cal.week_number_sunday("Week") == cal.py_week_number_sunday(today))
                  & (F.year("Week") == today.year))
           .select(F.col("FCID").alias("warehouse_id"), F.col("Yard_Capacity").alias("yard_capacity")))
    j = sheet.where(F.col("warehouse_id").isNotNull()).join(cap, "warehouse_id", "left")
    out = j.groupBy("upload_date", "warehouse_id", "yard_capacity").agg(
        F.count_distinct("ReservationID").alias("amount_of_units"))
    out = out.select("upload_date", "warehouse_id", "amount_of_units", "yard_capacity")
    return out


@model("metric_yard_utilization")
def metric_yard_utilization(p: Project) -> DataFrame:
    yu = p.ref("stg_yard_utilization")
    min_date = p.ctx.param("yard_report_min_date", DEFAULT_MIN_REPORT_DATE)
    day = cal.lit_date(p.ctx.report_date)
    a = yu.where((F.col("upload_date") >= cal.lit_date(min_date)) & (F.col("upload_date") == day)
                 & F.col("warehouse_id").isNotNull()).select(
        F.col("upload_date").alias("report_date"), "warehouse_id", "amount_of_units", "yard_capacity")
    c = yu.where((F.col("warehouse_id") == SHARED_CAPACITY_SOURCE) & (F.col("upload_date") == day)).select(
        F.col("upload_date").alias("report_date"), (F.col("yard_capacity") + SHARED_CAPACITY_UPLIFT).alias("c_capacity"))
    out = a.join(c, "report_date", "left").select(
        "report_date", "warehouse_id", "amount_of_units",
        F.when(F.col("warehouse_id").isin(SHARED_CAPACITY_SITES), F.col("c_capacity"))
         .otherwise(F.col("yard_capacity")).alias("yard_capacity"))
    return out
