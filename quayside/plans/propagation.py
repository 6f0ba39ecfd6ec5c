"""A run of the trailer dimension that recomputes what changed, and nothing else.

A run keeps, beside the targets, the slim tables it went through (``_state``): what each source row said, the first
events (M3), the loads' matches (M4) and the gate-outs (M5).  The next run finds the source rows that changed, and
carries sets of dirty keys down the models, with what the rows said before and what they say now:

    reservations  changed themselves, in their content, their bills of lading, their warehouse's offset, or with new events
    → first events of these reservations (M3)
    loads         changed themselves, or named, by bill of lading or by trailer and day, by such a reservation, or by one
                  whose bill of lading is among those and so may have gained or lost its load
    → matches of these loads (M4)
    reservations  matched by these loads, before or now, or by a load whose journey changed
    → gate-outs of these reservations (M5)
    visits        new, at a warehouse that changed, of a reservation from either set, or due by the clock
    → rows of these visits (M6)

Events and visits are found by their creation time (``LATE_DAYS`` before the last run); sources without one by comparing
hashes of their rows.  Dirty sets are written before anything is merged, and a run that died leaves them to
the next, which adds its own: what was merged already is merged again with the same result.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import calendar as cal
from quayside.operators import relops as R
from quayside.operators import sinks
from quayside.plans import yard_trailer as YT
from quayside.plans.project import Project

LATE_DAYS = 1  # rows created up to so long before the last run may have arrived after it

# state table → (key, columns a merge updates)
TABLES = {
    "reservations": (["ReservationID"], ["said", "n"]),
    "contents": (["ReservationID", "ContentRefID"], []),
    "bols": (["ContentRefID"], ["BolNumber"]),
    "loads": (["load_id", "reference_number", "tkey", "day"], []),
    "journeys": (["loadId"], ["shipperGateOutTimestamp"]),
    "warehouses": (["warehouse_id"], ["warehouse_name", "country_id", "time_zone_hours_offset"]),
    "first_events": (["ReservationID", "ActionID"], ["EventDate", "BolNumber", "TrailerNumber", "trailer_loading_complete_datetime"]),
    "matches": (["load_id", "reservationID"], []),
    "gates": (["reservationID"], ["load_id", "shipperGateOutTimestamp"]),
}
GROUPS = {"contents": ["ReservationID"], "first_events": ["ReservationID"], "loads": ["load_id"], "matches": ["load_id"]}  # else the key
RUN = "run"  # the state's table of one row: when the last run was


class State:
    """The tables of the last finished run, and the dirty sets of unfinished ones."""

    def __init__(self, p: Project, root: str):
        self.p, self.spark, self.root = p, p.spark, root

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def table(self, name: str) -> DataFrame | None:
        sinks.recover_pending(self.spark, self.path(name))
        return sinks.read_table(self.spark, self.path(name))

    def last_run(self) -> dt.datetime | None:
        runs = self.table(RUN)
        return None if runs is None else runs.agg(F.max("as_of")).first()[0]  # one row

    def put(self, name: str, rows: DataFrame, groups: DataFrame | None = None) -> None:
        key, columns = TABLES[name]
        sinks.merge_upsert(self.spark, rows, self.path(name), key, columns, cluster_by=key[:1],
                           group_key=GROUPS.get(name, key), groups=groups)

    def finish(self) -> None:
        """Everything is merged: the run is the last one, and its dirty sets are done with."""
        run = self.spark.createDataFrame([(1, self.p.ctx.as_of)], "id int, as_of timestamp_ntz")
        sinks.merge_upsert(self.spark, run, self.path(RUN), ["id"], ["as_of"])
        sinks.delete_path(self.spark, self.path("_dirty"))

    def dirty(self, name: str, keys: DataFrame) -> DataFrame:
        """``keys`` and those an unfinished run found, written down."""
        keys.distinct().write.parquet(os.path.join(self.path("_dirty"), name, uuid.uuid4().hex))
        return self.spark.read.option("recursiveFileLookup", "true").parquet(os.path.join(self.path("_dirty"), name)).distinct()


def sources_now(p: Project) -> dict[str, DataFrame]:
    """What the sources without a creation time say, as the state holds it."""
    res = p.source("reservation")
    return {
        "reservations": res.where("ReservationID is not null").groupBy("ReservationID").agg(
            F.bit_xor(F.xxhash64(*YT.RESERVATION_COLUMNS)).alias("said"), F.count(F.lit(1)).alias("n")),
        "contents": p.source("reservation_content").select("ReservationID", "ContentRefID").where("ReservationID is not null").distinct(),
        "bols": YT.content_bols(p.source("content_detail")),
        "loads": YT.load_keys(p.source("load_master")).where("load_id is not null").distinct(),
        "journeys": p.source("journey").where("loadId is not null").groupBy("loadId").agg(F.min("shipperGateOutTimestamp").alias("shipperGateOutTimestamp")),
        "warehouses": YT._dim_offsets(p),
    }


def changed(now: DataFrame, before: DataFrame, key: list[str]) -> DataFrame:
    """The keys whose rows differ, or that only one side has: rows that both sides have in equal number cancel out."""
    side = lambda df, n: df.select(*key, F.xxhash64(*sorted(df.columns)).alias("__h"), F.lit(n).alias("__n"))
    both = side(now, 1).unionByName(side(before, -1))
    return both.groupBy(*key, "__h").agg(F.sum("__n").alias("n")).where("n <> 0").select(*key).distinct()


def full(p: Project, state: State) -> tuple[DataFrame, Callable[[], None]]:
    """All rows, and the state they leave."""
    def keep() -> None:
        tables = sources_now(p) | {"first_events": p.ref("first_reservation_event"), "matches": p.ref("load_reservation_match"),
                                   "gates": p.ref("load_gate_out")}
        for name, rows in tables.items():
            sinks.delete_path(p.spark, state.path(name))
            state.put(name, rows)
        state.finish()

    return YT.keyed_visits(p), keep


def incremental(p: Project, state: State, target: DataFrame) -> tuple[DataFrame, DataFrame, Callable[[], None]] | None:
    """The rows of the visits that may have changed, these visits, and what writes the new state; None without a state."""
    last = state.last_run()
    if last is None:
        return None
    since = cal.lit_ntz(last - dt.timedelta(days=LATE_DAYS))
    before = {name: state.table(name) for name in TABLES}
    now = sources_now(p)
    diff = {name: changed(now[name], before[name], TABLES[name][0][:1]) for name in now}
    keys = {name: state.dirty(f"changed_{name}", diff[name]) for name in ("loads", "journeys", "warehouses")}
    all_events = p.source("reservation_event").select("EventQueueID", "ReservationID", "ActionID", "EventDate", "CreatedDate")
    warehouses = keys["warehouses"]
    one = lambda df, name, alias: df.select(F.col(name).alias(alias)).where(F.col(alias).isNotNull())

    # M3: reservations to rank again
    res = p.source("reservation")
    dirty = R.union_all([
        diff["reservations"], diff["contents"],
        R.semi_join(now["contents"].unionByName(before["contents"]), diff["bols"], "ContentRefID").select("ReservationID"),
        all_events.where(F.col("CreatedDate") >= since).select("ReservationID"),
        R.semi_join(res.select("ReservationID", F.col("WarehouseID").alias("warehouse_id")), warehouses, "warehouse_id").select("ReservationID"),
    ]).where("ReservationID is not null")
    reservations = state.dirty("reservations", dirty)
    old_events = R.semi_join(before["first_events"], reservations, "ReservationID")
    mine = R.semi_join(now["contents"], reservations, "ReservationID")
    events = p.stage("dirty_first_events", YT.first_events(
        R.semi_join(res, reservations, "ReservationID"), R.semi_join(all_events, reservations, "ReservationID"), now["warehouses"],
        mine, R.semi_join(now["bols"], mine.select("ContentRefID"), "ContentRefID")))
    first_events = R.anti_join(before["first_events"], reservations, "ReservationID").unionByName(events)

    # M4: loads to match again
    old_loads = R.semi_join(before["loads"], keys["loads"], "load_id")
    new_loads = R.semi_join(now["loads"], keys["loads"], "load_id")
    bills = R.union_all([one(old_events, "BolNumber", "BolNumber"), one(events, "BolNumber", "BolNumber"),
                         one(old_loads, "reference_number", "BolNumber"), one(new_loads, "reference_number", "BolNumber")]).distinct()
    either = before["first_events"].unionByName(events)
    of_bills = R.semi_join(either, bills, "BolNumber").select("ReservationID").unionByName(reservations).distinct()
    days = YT.event_days(R.semi_join(either, of_bills, "ReservationID")).select("tkey", "day").distinct()
    loads = state.dirty("loads", R.union_all([
        keys["loads"], R.semi_join(now["loads"], bills.withColumnRenamed("BolNumber", "reference_number"), "reference_number").select("load_id"),
        now["loads"].join(days, ["tkey", "day"], "left_semi").select("load_id")]))
    again = R.semi_join(now["loads"], loads, "load_id")
    by_bol = R.semi_join(first_events, one(again, "reference_number", "BolNumber"), "BolNumber")
    by_day = YT.event_days(first_events).join(again.select("tkey", "day").distinct(), ["tkey", "day"], "left_semi")
    matches = p.stage("dirty_matches", YT.match_loads(again, by_bol, by_day, lambda picked: YT.matched_by_bill(
        R.semi_join(first_events, picked.select(F.col("reservationID").alias("ReservationID")), "ReservationID"), now["loads"])))
    all_matches = R.anti_join(before["matches"], loads, "load_id").unionByName(matches)

    # M5: reservations whose gate-out may differ
    journeys = keys["journeys"].withColumnRenamed("loadId", "load_id")
    gated = state.dirty("gates", R.union_all([
        R.semi_join(before["matches"], loads, "load_id"), matches, R.semi_join(all_matches, journeys, "load_id")]).select("reservationID"))
    of_gated = R.semi_join(all_matches, gated, "reservationID")
    gates = p.stage("dirty_gates", YT.gate_outs(of_gated, R.semi_join(
        p.source("journey"), of_gated.select(F.col("load_id").alias("loadId")), "loadId")))
    all_gates = R.anti_join(before["gates"], gated, "reservationID").unionByName(gates)

    # M6: visits of these reservations, new ones, those at changed warehouses, those that have become due
    source = p.source("trailer_visit")
    dirty_reservations = reservations.unionByName(gated.withColumnRenamed("reservationID", "ReservationID")).distinct()
    named = source.select("trailer_visit_id", F.explode(F.concat(
        F.coalesce("trailer_reservation_id", F.array().cast("array<bigint>")),
        F.coalesce("trailer_unload_reservation_id", F.array().cast("array<bigint>")))).alias("ReservationID"))
    at = source.select("trailer_visit_id", F.explode("facility_id").alias("warehouse_id"))
    due = target.where(F.col("trailer_arrival_datetime_local").isNull()
                       & F.col("trailer_scheduled_start_datetime_local").between(cal.lit_ntz(last), cal.lit_ntz(p.ctx.current_datetime)))
    visits = state.dirty("visits", R.union_all([
        R.semi_join(named, dirty_reservations, "ReservationID").select("trailer_visit_id"),
        R.semi_join(at, warehouses, "warehouse_id").select("trailer_visit_id"),
        source.where(F.col("event_created_timestamp") >= since).select("trailer_visit_id"), due.select("trailer_visit_id")]))
    changed_visits = R.semi_join(source, visits, "trailer_visit_id")
    wanted = R.semi_join(named, visits, "trailer_visit_id").select("ReservationID").where("ReservationID is not null").distinct()
    cards = YT.reservation_cards(
        R.semi_join(res, wanted, "ReservationID"), YT._dim_offsets(p), R.semi_join(first_events, wanted, "ReservationID"),
        R.semi_join(all_gates, wanted.withColumnRenamed("ReservationID", "reservationID"), "reservationID"))

    def keep() -> None:
        updates = {"reservations": reservations, "loads": keys["loads"], "journeys": keys["journeys"], "warehouses": warehouses,
                   "contents": diff["contents"], "bols": diff["bols"]}
        # differences that are read from the tables to be merged are settled first
        updates = {name: p.stage(f"keys_{name}", k.distinct()) for name, k in updates.items()}
        for name, k in updates.items():
            state.put(name, R.semi_join(now[name], k, k.columns[0]), groups=k)
        state.put("first_events", events, groups=reservations)
        state.put("matches", matches, groups=loads)
        state.put("gates", gates, groups=gated)
        state.finish()

    return YT.visit_rows(p, changed_visits, cards), visits, keep
