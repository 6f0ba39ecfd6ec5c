"""The stand-ins reach every branch: accountability buckets, the sentinel count, arrays of 0, 1 and 3 elements."""
import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE
from quayside.sources.tables import DRIVER_TABLES, table_path


@pytest.fixture(scope="module")
def run():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_ORACLE, t)}')")
    oracles = E.oracle_sql()
    return lambda key, sql: con.sql(f"WITH q AS ({oracles[key]}) {sql}").fetchall()


def test_every_accountability_bucket_occurs(run):
    for key in ("case_nested_bucket", "metric_on_yard_units"):
        assert {b for b, in run(key, "SELECT DISTINCT accountability_bucket FROM q")} >= {
            "appointed_later_this_week", "appointed_future_weeks", "arrived_late_within_48hr_unload_window",
            "arrived_late_not_within_48hr_unload_window", "within_48hr_window", "past_48hr_window"}


def test_the_sentinel_count_is_demoted(run):
    demoted = {r for r, in run("case_priority", "SELECT inbound_trailer_reservation_id FROM q WHERE priority = 2")}
    kept = dict(run("units_priority", "SELECT inbound_trailer_reservation_id, trailer_reservation_units FROM q"))
    assert len(demoted) > 10 and any(kept[r] != 400 for r in demoted) and any(kept[r] == 400 for r in demoted)


def test_arrays_multiply(run):
    assert {n for n, in run("join_lateral_unnest", "SELECT DISTINCT count(*) FROM q GROUP BY trailer_visit_id")} >= {1, 3, 9}
    assert run("join_lateral_unnest", "SELECT count(*) FROM q WHERE unnested_facility_id IS NULL")[0][0] > 0


def test_manual_bounds_win_over_the_condition(run):
    (n, lo, hi), = run("backfill_window_manual", "SELECT count(*), min(log_datetime_local)::DATE::VARCHAR, max(log_datetime_local)::DATE::VARCHAR FROM q")
    assert n > 100 and "1996-02-01" <= lo <= hi <= "1996-03-31"
