"""Calendar and clock expressions.

All functions return ``Column`` expressions built from Spark built-ins, so
they stay inside whole-stage codegen.  Python helpers prefixed ``py_`` compute
the same values for scalars derived from ``as_of`` on the driver.

Week conventions follow the warehouse SQL the models were written in:
* a week starts on **Sunday** (``DATE_TRUNC(d, WEEK)``);
* ``EXTRACT(WEEK)`` numbers Sunday weeks 0..53, days before the first Sunday
  of the year are week 0 (strftime ``%U``);
* ``DAYOFWEEK`` is 1 = Sunday .. 7 = Saturday (same as Spark ``dayofweek``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lit_date(d: dt.date) -> Column:
    """Date literal, independent of the session and Python time zones."""
    return F.lit(d.isoformat()).cast("date")


def lit_ntz(ts: dt.datetime) -> Column:
    """Wall-clock timestamp literal (``timestamp_ntz``), zone independent."""
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


# --- F22/F23: zones and offsets ------------------------------------------------------

def utc_to_zone(ts: ColumnOrName, zone: str) -> Column:
    """``DATETIME(ts, zone)``: an instant stored as UTC wall time → local wall time."""
    # both casts keep the wall time in the session's zone, which is UTC; the zone is looked up once, not per row
    return F.from_utc_timestamp(_c(ts).cast("timestamp_ntz").cast("timestamp"), zone).cast("timestamp_ntz")


def add_hours(ts: ColumnOrName, hours: ColumnOrName | int) -> Column:
    """``DATETIME_ADD(ts, INTERVAL CAST(h AS INT64) HOUR)``; NULL hours → NULL."""
    h = F.lit(hours) if isinstance(hours, int) else _c(hours)
    return F.timestamp_add("HOUR", h.cast("bigint"), _c(ts))


def add_days(ts: ColumnOrName, days: int) -> Column:
    return F.timestamp_add("DAY", F.lit(days), _c(ts))


# --- F25: hour difference counting boundaries ----------------------------------------

def hour_boundaries(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``DATETIME_DIFF(a, b, HOUR)``: number of hour boundaries between b and a.

    Truncating both sides first makes 00:59 → 01:01 count as 1 (Spark's
    ``timestampdiff`` counts whole elapsed hours and would give 0).
    """
    return F.timestamp_diff("HOUR", F.date_trunc("HOUR", _c(b)), F.date_trunc("HOUR", _c(a)))


def py_hour_boundaries(a: dt.datetime, b: dt.datetime) -> int:
    ta = a.replace(minute=0, second=0, microsecond=0)
    tb = b.replace(minute=0, second=0, microsecond=0)
    return int((ta - tb).total_seconds() // 3600)


# --- F29: cut-off times ----------------------------------------------------------------

def cutoff(d: ColumnOrName, hours: int) -> Column:
    """``DATETIME(d, TIME(0,0,0)) + INTERVAL h HOUR``."""
    return add_hours(_c(d).cast("date").cast("timestamp_ntz"), hours)


def py_cutoff(d: dt.date, hours: int) -> dt.datetime:
    return dt.datetime(d.year, d.month, d.day) + dt.timedelta(hours=hours)


# --- F30/F31/F33: Sunday weeks ------------------------------------------------------------

def week_start_sunday(d: ColumnOrName) -> Column:
    """``DATE_TRUNC(d, WEEK)``: the same or previous Sunday (Spark's ``trunc`` is Monday)."""
    dd = _c(d).cast("date")
    return F.date_sub(dd, F.dayofweek(dd) - 1)


def py_week_start_sunday(d: dt.date) -> dt.date:
    # isoweekday: Monday=1 .. Sunday=7
    return d - dt.timedelta(days=d.isoweekday() % 7)


def week_number_sunday(d: ColumnOrName) -> Column:
    """``EXTRACT(WEEK FROM d)``: Sunday-based week 0..53 (strftime %U)."""
    dd = _c(d).cast("date")
    return F.floor((F.dayofyear(dd) + 7 - F.dayofweek(dd)) / 7).cast("bigint")


def py_week_number_sunday(d: dt.date) -> int:
    return int(d.strftime("%U"))


def py_week_to_date_window(d: dt.date) -> tuple[dt.date, dt.date]:
    """Sunday..Saturday of the week that holds ``d``."""
    start = py_week_start_sunday(d)
    return start, start + dt.timedelta(days=6)


# --- F32: parts --------------------------------------------------------------------------

def day_of_week_sunday1(d: ColumnOrName) -> Column:
    """``EXTRACT(DAYOFWEEK)``: 1 = Sunday .. 7 = Saturday."""
    return F.dayofweek(_c(d).cast("date"))


# --- D12/D13: retail events ----------------------------------------------------------------

def thanksgiving(year: ColumnOrName) -> Column:
    """Fourth Thursday of November: the first Thursday after 31 October, plus 21 days."""
    oct31 = F.make_date(_c(year), F.lit(10), F.lit(31))
    return F.date_add(F.next_day(oct31, "THU"), 21)


def py_thanksgiving(year: int) -> dt.date:
    nov1 = dt.date(year, 11, 1)
    first_thu = nov1 + dt.timedelta(days=(3 - nov1.weekday()) % 7)
    return first_thu + dt.timedelta(days=21)


# Fixed value: peak and cyber-5 flags are False before this year.
RETAIL_EVENTS_FIRST_YEAR = 2002


def is_peak(d: ColumnOrName) -> Column:
    dd = _c(d).cast("date")
    y = F.year(dd)
    tg = thanksgiving(y)
    end = F.make_date(y, F.lit(12), F.lit(31))
    return F.when(y < RETAIL_EVENTS_FIRST_YEAR, F.lit(False)).otherwise(dd.between(tg, end))


def is_cyber5(d: ColumnOrName) -> Column:
    dd = _c(d).cast("date")
    y = F.year(dd)
    tg = thanksgiving(y)
    return F.when(y < RETAIL_EVENTS_FIRST_YEAR, F.lit(False)).otherwise(dd.between(tg, F.date_add(tg, 4)))


# --- D6-D8: week-of-year labels ---------------------------------------------------------------

def iso_week(d: ColumnOrName) -> Column:
    """Week of a Monday-start week (ISO)."""
    return F.weekofyear(_c(d).cast("date"))


def iso_week_of_sunday_week(d: ColumnOrName) -> Column:
    """ISO week number of the Saturday that ends the Sunday-start week."""
    dd = _c(d).cast("date")
    return F.weekofyear(F.date_add(dd, 7 - F.dayofweek(dd)))


def year_week_label(d: ColumnOrName, week: Column) -> Column:
    """'YYYYWww' where the year rolls back in early January (week > 51) and
    forward in late December (week 1)."""
    dd = _c(d).cast("date")
    y = F.year(dd)
    m = F.month(dd)
    label_year = (F.when((m == 1) & (week > 51), y - 1)
                  .when((m == 12) & (week == 1), y + 1)
                  .otherwise(y))
    return F.concat(label_year.cast("string"), F.lit("W"), F.lpad(week.cast("string"), 2, "0"))
