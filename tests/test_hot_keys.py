"""Joins by keys of few values: rows of the large side are not shuffled by them, and nothing large goes through the driver."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quayside.functions import calendar as cal
from quayside.operators import relops as R
from quayside.plans import operator_queries as OQ
from quayside.plans import units as U
from quayside.plans import yard_trailer as YT


@pytest.fixture
def no_small_joins(spark):
    """Plans as on tables too large for an automatic broadcast."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


class Given:
    """A project with the given tables."""

    def __init__(self, **tables):
        self.tables = tables

    def source(self, name):
        return self.tables[name]

    ref = source

    def dimension(self, name, *cols, source=False):
        return self.tables[name].select(*cols) if cols else self.tables[name]


def rows(df) -> list:
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_is_the_plain_join(spark, how):
    left = spark.createDataFrame([(1, 7), (2, 7), (3, None), (4, 9), (4, 9), (5, 8)], "id int, wh bigint")
    dim = spark.createDataFrame([(7, "a"), (7, "b"), (8, None), (None, "n"), (11, "z")], "held bigint, name string")
    assert rows(R.lookup_join(left, dim, "wh", "held", how)) == rows(left.join(dim, left.wh == dim.held, how))
    named = dim.withColumnRenamed("held", "wh")
    assert rows(R.lookup_join(left, named, "wh", "wh", how)) == rows(left.join(named, "wh", how))


def test_reservations_are_not_shuffled_by_warehouse(spark, no_small_joins):
    now = dt.datetime(1998, 6, 14)
    res = spark.createDataFrame([(k, k % 2, "S", 1, "T", 1, now, True, False) for k in range(6)],
                                "ReservationID bigint, WarehouseID bigint, subwarehouse string, CarrierID bigint, TrailerNumber string, "
                                "siteID bigint, ScheduledStartDate timestamp_ntz, IsInbound boolean, IsTerminated boolean")
    warehouses = spark.createDataFrame([(0, "zero", 5, 1), (2, "two", 6, 1)],
                                       "warehouse_id bigint, warehouse_name string, country_id bigint, time_zone_hours_offset bigint")
    events = spark.createDataFrame([(1, 28, now)], "ReservationID bigint, ActionID int, EventDate timestamp_ntz")
    gates = spark.createDataFrame([(2, 20, now)], "reservationID bigint, load_id bigint, shipperGateOutTimestamp timestamp_ntz")
    cards = YT.reservation_cards(res, warehouses, events, gates)
    hashed = [x for x in plan(cards).splitlines() if "hashpartitioning(WarehouseID" in x]
    assert not hashed
    named = {r.ReservationID: r.card.warehouse_name for r in cards.collect()}
    assert named == {k: None if k % 2 else "zero" for k in range(6)}


def test_freight_log_is_summed_before_its_classes_join(spark, no_small_joins):
    day = dt.datetime(1998, 6, 1, 5)
    log = spark.createDataFrame([(1, day, 0, 3, 0), (1, day, 0, 4, None), (1, day, 2, None, 5), (1, day, None, 9, 9), (1, day, 1, 1, 2),
                                 (1, day, 3, 7, 0), (2, None, 1, None, None)],
                                "warehouse_id bigint, log_datetime_local timestamp_ntz, freight_class_id bigint, bulk_pick_units bigint, bins_pick_units bigint")
    classes = spark.createDataFrame([(0, "1"), (1, "2"), (2, None), (3, "1")], "freight_class_id bigint, freight_class_number string")
    fine = OQ._freight_fine(Given(tran_log_units_freight=log, freight_class=classes))
    of = optimized(fine)
    assert "Aggregate" in of[of.index("Join"):]
    d = day.date()
    assert rows(fine) == sorted([(1, d, "Bulk_Picks_SP_Bins", 14), (1, d, "Bulk_Picks_SP_Bins", None), (1, d, "Bulk_Picks_LP", 3),
                                 (2, None, "Bulk_Picks_LP", None)], key=repr)


def test_content_lines_are_not_broadcast_by_truck(spark):
    base = spark.createDataFrame([(1, "10", 2, 2), (1, "x", 2, 1), (2, "10", 3, 1), (3, None, 2, 1)],
                                 "inbound_trailer_reservation_id bigint, CleanSpoID string, ContentType int, w bigint")
    trucks = spark.createDataFrame([(10,), (11,)], "SlmTruckID bigint")
    volume = spark.createDataFrame([(10, 0, 6), (10, 4, 9)], "truck_id bigint, loaded_carton_count bigint, total_cartons bigint")
    loaded = U.loaded_cartons(Given(units_base=base, shipping_load_manifest=trucks, truckload_volume=volume))
    assert "strategy=merge" in optimized(loaded)
    assert rows(loaded) == [(1, 4), (2, 4)]


def test_wall_time_of_a_zone_looks_the_zone_up_once(spark):
    times = [dt.datetime(1998, 4, 5, 6, 59), dt.datetime(1998, 4, 5, 7), dt.datetime(1998, 10, 25, 5, 30), dt.datetime(1998, 10, 25, 6, 30),
             dt.datetime(1883, 11, 18, 17, 0, 1), dt.datetime(1500, 1, 1), dt.datetime(1998, 1, 1, 0, 0, 0, 123456), None]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    for zone in ("America/New_York", "Europe/Berlin"):
        got = df.select("t", cal.utc_to_zone("t", zone).alias("l"))
        assert "convert_timezone" not in optimized(got)
        assert rows(got) == rows(df.select("t", F.convert_timezone(F.lit("UTC"), F.lit(zone), "t").alias("l")))
