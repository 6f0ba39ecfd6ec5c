"""Calendar facts over the whole 2021-2049 range."""
import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from quayside.functions import calendar as cal
from quayside.plans import dim_date as DD


def _cal_pdf(spark):
    return DD.calendar(DD.date_range(spark), dt.datetime(2024, 1, 1)).toPandas()


def test_date_range_rows(spark):
    assert DD.date_range(spark).count() == 10228


def test_week_functions_match_python(spark):
    pdf = _cal_pdf(spark)
    days = pd.to_datetime(pdf["date_actual"])
    # Sunday week number = strftime %U, week start = previous or same Sunday
    wk = DD.date_range(spark).select("date_actual", cal.week_number_sunday("date_actual").alias("w")).toPandas()
    assert (wk["w"] == pd.to_datetime(wk["date_actual"]).dt.strftime("%U").astype(int)).all()
    assert (pd.to_datetime(pdf["sunday_date"]) == days - pd.to_timedelta(days.dt.strftime("%w").astype(int), unit="D")).all()
    # ISO weeks of Monday and Sunday weeks, as pandas periods compute them
    assert (pdf["week_of_year_monday"] == days.dt.to_period("W-SUN").dt.week).all()
    assert (pdf["week_of_year_sunday"] == days.dt.to_period("W-SAT").dt.week).all()
    assert (pdf["day_of_week_sunday"] == days.dt.strftime("%w").astype(int)).all()
    assert (pdf["day_of_week_monday"] == days.dt.dayofweek).all()
    assert (pdf["is_weekend"] == (days.dt.dayofweek > 4)).all()


def test_year_week_labels(spark):
    pdf = _cal_pdf(spark)
    days = pd.to_datetime(pdf["date_actual"])
    for col, wcol in (("year_week_sunday", "week_of_year_sunday"), ("year_week_monday", "week_of_year_monday")):
        w = pdf[wcol]
        year = days.dt.year.where(~((days.dt.month == 1) & (w > 51)), days.dt.year - 1)
        year = year.where(~((days.dt.month == 12) & (w == 1)), days.dt.year + 1)
        expect = year.astype(str) + "W" + w.astype(str).str.pad(2, fillchar="0")
        assert (pdf[col] == expect).all(), col


def test_names_and_quarters(spark):
    pdf = _cal_pdf(spark)
    days = pd.to_datetime(pdf["date_actual"])
    assert (pdf["month_name"] == days.dt.strftime("%B")).all()
    assert (pdf["day_name_abbreviated"] == days.dt.strftime("%a")).all()
    assert (pdf["year_month"] == days.dt.year.astype(str) + "/" + days.dt.strftime("%b")).all()
    assert (pdf["year_quarter"] == days.dt.year.astype(str) + "Q" + days.dt.quarter.astype(str)).all()
    assert (pdf["date_integer"] == days.dt.strftime("%Y%m%d")).all()


def test_thanksgiving_and_events(spark):
    for y in range(2021, 2050):
        tg = cal.py_thanksgiving(y)
        assert tg.month == 11 and tg.weekday() == 3 and 22 <= tg.day <= 28
    pdf = _cal_pdf(spark)
    d = pd.to_datetime(pdf["date_actual"]).dt.date
    tg = d.map(lambda x: cal.py_thanksgiving(x.year))
    peak = (d >= tg) & (d <= d.map(lambda x: dt.date(x.year, 12, 31)))
    cyber = (d >= tg) & (d <= tg.map(lambda x: x + dt.timedelta(days=4)))
    assert (pdf["is_peak"] == peak).all()
    assert (pdf["is_cyber5"] == cyber).all()


def test_hour_boundaries_and_zones(spark):
    df = spark.createDataFrame([("2024-01-01 00:59:00", "2024-01-01 01:01:00")], "a string, b string").select(
        F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    r = df.select(cal.hour_boundaries("b", "a").alias("h"),
                  cal.utc_to_zone("a", "America/New_York").alias("ny")).first()
    assert r.h == 1
    assert r.ny == dt.datetime(2023, 12, 31, 19, 59)


def test_context_values():
    from quayside.plans.context import fixture_context
    ctx = fixture_context()
    assert ctx.report_date == dt.date(1998, 6, 16)
    assert ctx.current_datetime_hq == dt.datetime(1998, 6, 17, 8, 0)
    assert ctx.cutoff_hq == dt.datetime(1998, 6, 17, 4, 0)
    assert ctx.zone_offset_hours("Europe/London") == 5
    assert ctx.zone_offset_hours("Europe/Berlin") == 6
    assert cal.py_week_start_sunday(dt.date(1998, 6, 17)) == dt.date(1998, 6, 14)
