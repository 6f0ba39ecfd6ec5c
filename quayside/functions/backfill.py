"""Backfill windows as functions of the run context."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions import calendar as cal


def _lit(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, dt.datetime):
        return cal.lit_ntz(v)
    if isinstance(v, dt.date):
        return cal.lit_date(v)
    return F.lit(v)


def backfill_window(time_value: Column, regular_run_start, regular_run_end, regular_backfill_start,
                    regular_backfill_end, backfill_condition, manual_backfill: bool = False,
                    backfill_start=None, backfill_end=None) -> Column:
    """B1: a BETWEEN predicate.

    A manual backfill with both bounds set wins.  Otherwise the bounds are
    ``IF(condition, regular_run_*, regular_backfill_*)`` — note that the
    *run* bounds are used when the backfill condition holds, as written.
    """
    if manual_backfill and backfill_start is not None and backfill_end is not None:
        return time_value.between(_lit(backfill_start), _lit(backfill_end))
    cond = _lit(backfill_condition)
    lo = F.when(cond, _lit(regular_run_start)).otherwise(_lit(regular_backfill_start))
    hi = F.when(cond, _lit(regular_run_end)).otherwise(_lit(regular_backfill_end))
    return time_value.between(lo, hi)


def manual_bounds(ctx) -> dict:
    """The manual override of a run (``manual_backfill``, ``backfill_start``, ``backfill_end`` in its parameters)."""
    return {k: ctx.param(k) for k in ("manual_backfill", "backfill_start", "backfill_end")}


def regular_14_day_backfill(ctx) -> dt.date:
    """B2: 28 days back on the first of a month that falls on a Sunday, 14 days
    back when it is 20:00-23:59 in New York, else 7 days back."""
    today = ctx.current_date
    if today.day == 1 and today.isoweekday() == 7:
        return today - dt.timedelta(days=28)
    if ctx.current_datetime_hq.hour in (20, 21, 22, 23):
        return today - dt.timedelta(days=14)
    return today - dt.timedelta(days=7)


def regular_6_month_backfill(ctx) -> dt.date:
    """Six calendar months before today (day clamped to the month's end)."""
    d = ctx.current_date
    y, m = divmod(d.month - 1 - 6, 12)
    year, month = d.year + y, m + 1
    last = (dt.date(year + (month == 12), month % 12 + 1, 1) - dt.timedelta(days=1)).day
    return dt.date(year, month, min(d.day, last))
