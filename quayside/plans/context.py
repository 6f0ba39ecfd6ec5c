"""One explicit ``as_of`` instant per run.

Every model in the reference reads the wall clock (``CURRENT_DATE()``,
``CURRENT_DATETIME('America/New_York')``).  Here a run is pinned to one UTC
instant and every "current" value is derived from it, so results are
reproducible and a backfill is a loop over ``as_of`` values.  The derived
values are scalars computed once on the driver and enter the plans as
literals, which lets Catalyst push them into parquet scans.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from zoneinfo import ZoneInfo

from quayside.functions import calendar as cal

HQ_ZONE = "America/New_York"


@dataclass(frozen=True)
class RunContext:
    as_of: dt.datetime  # naive, UTC
    hq_zone: str = HQ_ZONE
    ci_limit: int | None = None  # S14: row cap applied only in CI runs
    params: dict = field(default_factory=dict)

    # --- "current" values in UTC -------------------------------------------------
    @property
    def current_timestamp(self) -> dt.datetime:
        return self.as_of

    @property
    def current_date(self) -> dt.date:
        return self.as_of.date()

    @property
    def current_datetime(self) -> dt.datetime:
        return self.as_of

    # --- "current" values on the New York wall clock --------------------------
    def wall_clock(self, zone: str) -> dt.datetime:
        aware = self.as_of.replace(tzinfo=dt.timezone.utc).astimezone(ZoneInfo(zone))
        return aware.replace(tzinfo=None)

    @property
    def current_datetime_hq(self) -> dt.datetime:
        return self.wall_clock(self.hq_zone)

    @property
    def current_date_hq(self) -> dt.date:
        return self.current_datetime_hq.date()

    # --- derived dates -----------------------------------------------------------
    @property
    def report_date(self) -> dt.date:
        """Yesterday on the UTC calendar (``DATE_SUB(CURRENT_DATE(), 1)``)."""
        return self.current_date - dt.timedelta(days=1)

    @property
    def report_date_hq(self) -> dt.date:
        """Yesterday on the New York calendar."""
        return self.current_date_hq - dt.timedelta(days=1)

    @property
    def cutoff_hq(self) -> dt.datetime:
        """Today's 04:00 on the New York calendar (the on-site snapshot time)."""
        return cal.py_cutoff(self.current_date_hq, hours=4)

    @property
    def appointment_cutoff_hq(self) -> dt.datetime:
        """Today's midnight on the New York calendar (appointment SLA)."""
        return cal.py_cutoff(self.current_date_hq, hours=0)

    def zone_offset_hours(self, zone: str) -> int:
        """DATETIME_DIFF(CURRENT_DATETIME(zone), CURRENT_DATETIME(NY), HOUR)."""
        return cal.py_hour_boundaries(self.wall_clock(zone), self.wall_clock(self.hq_zone))

    def param(self, name: str, default=None):
        return self.params.get(name, default)


# The instant used by the fixtures and the correctness checks.
FIXTURE_AS_OF = dt.datetime(1998, 6, 17, 12, 0, 0)


# The fixture events keep the unit count under this JSON path.
# The yard report keeps uploads from this date on (the reference's cut-off is
# 2024-01-01, later than every fixture date).
FIXTURE_PARAMS = {"units_json_path": "$.k", "yard_report_min_date": dt.date(1995, 1, 1)}


def fixture_context(**kw) -> RunContext:
    params = {**FIXTURE_PARAMS, **kw.pop("params", {})}
    return RunContext(as_of=FIXTURE_AS_OF, params=params, **kw)
