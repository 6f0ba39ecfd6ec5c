"""M2 ``dim_date``: calendar dimension.

The reference builds the calendar row by row in pandas with a per-row Python
function for the retail events.  Here every attribute is a column expression
over a date column, so the same derivation serves a generated range
(``date_range``) and the distinct dates a fact table actually holds
(``calendar_for``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import calendar as cal
from quayside.plans.project import Project, model

# The reference calendar spans these days, both ends included.
CALENDAR_START = dt.date(2021, 1, 1)
CALENDAR_END = dt.date(2049, 1, 1)


def date_range(spark: SparkSession, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END) -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(
        F.explode(F.sequence(cal.lit_date(start), cal.lit_date(end), F.expr("INTERVAL 1 DAY"))).alias("date_actual"))


def date_range_of(df: DataFrame, col: str) -> DataFrame:
    """S5 over a data-derived span: every day from min(col) to max(col)."""
    bounds = df.agg(F.min(F.col(col).cast("date")).alias("lo"), F.max(F.col(col).cast("date")).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date_actual"))


def calendar_columns(d: Column, as_of: dt.datetime) -> list[Column]:
    """D1-D13 for the date column ``d``."""
    d = d.cast("date")
    month = F.month(d)
    q = F.quarter(d)
    wk_mon = cal.iso_week(d)
    wk_sun = cal.iso_week_of_sunday_week(d)
    dow_sun0 = F.dayofweek(d) - 1
    ts = cal.lit_ntz(as_of)
    return [
        F.date_format(d, "yyyyMMdd").alias("date_integer"),
        d.alias("date_actual"),
        F.year(d).cast("bigint").alias("year_actual"),
        F.when(month < 7, 1).otherwise(2).cast("bigint").alias("half_year_actual"),
        F.when(month < 7, "H1").otherwise("H2").alias("half_year_name"),
        F.concat(F.year(d).cast("string"), F.lit("Q"), q.cast("string")).alias("year_quarter"),
        q.cast("bigint").alias("quarter_actual"),
        F.concat(F.lit("Q"), q.cast("string")).alias("quarter_name"),
        F.concat(F.year(d).cast("string"), F.lit("/"), F.date_format(d, "MMM")).alias("year_month"),
        month.cast("bigint").alias("month_actual"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_name_abbreviated"),
        wk_mon.cast("bigint").alias("week_of_year_monday"),
        wk_sun.cast("bigint").alias("week_of_year_sunday"),
        cal.year_week_label(d, wk_sun).alias("year_week_sunday"),
        cal.year_week_label(d, wk_mon).alias("year_week_monday"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        dow_sun0.cast("bigint").alias("day_of_week_sunday"),
        F.weekday(d).cast("bigint").alias("day_of_week_monday"),
        F.dayofmonth(d).cast("bigint").alias("day_of_month"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "EEE").alias("day_name_abbreviated"),
        cal.week_start_sunday(d).alias("sunday_date"),
        cal.is_peak(d).alias("is_peak"),
        cal.is_cyber5(d).alias("is_cyber5"),
        ts.alias("dwh_creation_timestamp"),
        ts.alias("dwh_modified_timestamp"),
    ]


def calendar(dates: DataFrame, as_of: dt.datetime) -> DataFrame:
    return dates.select(*calendar_columns(F.col("date_actual"), as_of))


def calendar_for(df: DataFrame, col: str, as_of: dt.datetime) -> DataFrame:
    """Calendar rows for the distinct dates of ``df[col]``."""
    dates = df.select(F.col(col).cast("date").alias("date_actual")).where(F.col("date_actual").isNotNull()).distinct()
    return calendar(dates, as_of)


@model("dim_date")
def dim_date(p: Project) -> DataFrame:
    """The reference calendar: 2021-01-01..2049-01-01, sorted by date (O2)."""
    return calendar(date_range(p.spark), p.ctx.current_timestamp).orderBy("date_actual")
