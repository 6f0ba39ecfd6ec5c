"""Property tests: calendar expressions against Python on random dates and times."""
import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.functions import calendar as cal

DATES = st.lists(st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2100, 12, 31)), min_size=1, max_size=60)
TIMES = st.lists(st.tuples(st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2060, 1, 1)),
                           st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2060, 1, 1))),
                 min_size=1, max_size=40)


@settings(max_examples=15, deadline=None)
@given(DATES)
def test_sunday_weeks(spark, days):
    df = spark.createDataFrame([(d.isoformat(),) for d in days], "s string").select(F.col("s").cast("date").alias("d"))
    rows = df.select("d", cal.week_number_sunday("d").alias("w"), cal.week_start_sunday("d").alias("ws"),
                     cal.thanksgiving(F.year("d")).alias("tg")).collect()
    for r in rows:
        assert r.w == int(r.d.strftime("%U"))
        assert r.ws == cal.py_week_start_sunday(r.d) and r.ws.isoweekday() == 7 and 0 <= (r.d - r.ws).days < 7
        assert r.tg == cal.py_thanksgiving(r.d.year)


@settings(max_examples=15, deadline=None)
@given(TIMES)
def test_hour_boundaries(spark, pairs):
    data = [(a.isoformat(sep=" "), b.isoformat(sep=" ")) for a, b in pairs]
    df = spark.createDataFrame(data, "a string, b string").select(
        F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    for r in df.select("a", "b", cal.hour_boundaries("a", "b").alias("h")).collect():
        assert r.h == cal.py_hour_boundaries(r.a, r.b)
