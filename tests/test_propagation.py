"""Change propagation: a later run merges the visits that changed, and its target equals a full run's."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quayside.operators import sinks
from quayside.plans import propagation as PG
from quayside.plans.context import RunContext, fixture_context
from quayside.plans.project import Project
from quayside.plans.run import run_models
from quayside.sources.registry import Sources

EARLY, LATE = dt.datetime(1998, 3, 20, 12), dt.datetime(1998, 6, 17, 12)  # Europe's clocks change in between
CLOCKS = ["dwh_creation_timestamp", "dwh_modified_timestamp", "refresh_datetime_local"]  # say when a row was written


class Before(Sources):
    """The sources as they were before a day's changes; ``kinds`` names the changes that came since."""

    def __init__(self, spark, sf_dir, kinds):
        super().__init__(spark, sf_dir)
        self.kinds = kinds

    def get(self, name):
        df = super().get(name)
        early = F.lit(str(EARLY)).cast("timestamp_ntz")
        if name == "reservation_event" and "late events" in self.kinds:
            # the first arrivals of some reservations come late: created now, though they happened long ago
            return df.where((F.col("CreatedDate") < early) & (F.col("ReservationID") % 3 != 0))
        if name == "trailer_visit" and "visits" in self.kinds:
            return df.where(F.col("event_created_timestamp") < early)
        if name == "reservation" and "reservations" in self.kinds:
            return df.where("ReservationID % 41 <> 0").withColumn("TrailerNumber", F.when(F.col("ReservationID") % 17 == 0, "TR-9").otherwise(F.col("TrailerNumber"))) \
                .withColumn("IsTerminated", F.col("IsTerminated") != (F.col("ReservationID") % 29 == 0))
        if name == "load_master" and "loads" in self.kinds:
            other = F.concat(F.lit("BOL"), (F.col("load_id") + 4).cast("string"))
            return df.where("load_id % 14 <> 0").withColumn("reference_number", F.when(F.col("load_id") % 5 == 0, other).otherwise(F.col("reference_number"))) \
                .withColumn("actual_ship_date", F.when(F.col("load_id") % 3 == 0, F.timestamp_add("DAY", F.lit(2), F.col("actual_ship_date"))).otherwise(F.col("actual_ship_date")))
        if name == "journey" and "journeys" in self.kinds:
            return df.where("loadId % 8 <> 0")
        if name == "content_detail" and "contents" in self.kinds:
            return df.withColumn("BolNumber", F.when(F.col("ContentRefID") % 9 == 0, F.lit("BOL6")).otherwise(F.col("BolNumber")))
        if name == "reservation_content" and "contents" in self.kinds:
            return df.where("ContentRefID % 21 <> 0")
        return df


class Since(Sources):
    """The stand-in sources; late events say when they were created."""

    def __init__(self, spark, sf_dir, kinds):
        super().__init__(spark, sf_dir)
        self.kinds = kinds

    def get(self, name):
        df = super().get(name)
        if name == "reservation_event" and "late events" in self.kinds:
            late = F.col("ReservationID") % 3 == 0
            return df.withColumn("CreatedDate", F.when(late, F.lit(str(LATE)).cast("timestamp_ntz")).otherwise(F.col("CreatedDate")))
        return df


def project(spark, sources, as_of):
    return Project(spark, sources, RunContext(as_of=as_of, params=fixture_context().params))


def visits(spark, root):
    df = spark.read.parquet(os.path.join(root, "dim_yard_trailer"))
    return sorted(str(tuple(r)) for r in df.select(*sorted(c for c in df.columns if c not in CLOCKS)).collect())


NAMES = ["dim_warehouse", "dim_yard_trailer"]
EVERYTHING = ("late events", "visits", "reservations", "loads", "journeys", "contents")


@pytest.fixture(scope="module")
def full_target(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("full"))
    run_models(project(spark, Sources(spark, SF_SMALL), LATE), NAMES, root)
    return visits(spark, root)


@pytest.mark.parametrize("kinds", [EVERYTHING, ("loads",)])
def test_next_run_equals_a_full_one(spark, tmp_dir, full_target, kinds):
    run_models(project(spark, Before(spark, SF_SMALL, kinds), EARLY), NAMES, tmp_dir)
    assert visits(spark, tmp_dir) != full_target
    run_models(project(spark, Since(spark, SF_SMALL, kinds), LATE), NAMES, tmp_dir)
    assert visits(spark, tmp_dir) == full_target


def test_only_what_changed_is_recomputed(spark, tmp_dir, full_target, monkeypatch):
    """Three late events and a load that changed its bill: their visits alone are merged, and other files stay."""
    class Changed(Sources):
        def get(self, name):
            df = super().get(name)
            if name == "reservation_event":  # earlier events come late; no other event is as new as that
                old = df.withColumn("CreatedDate", F.least(F.col("CreatedDate"), F.lit("1998-06-01").cast("timestamp_ntz")))
                first = old.where("ReservationID in (7, 8, 9)").withColumns({
                    "EventQueueID": -F.col("EventQueueID"), "EventDate": F.timestamp_add("DAY", F.lit(-1), F.col("EventDate")),
                    "CreatedDate": F.lit(str(LATE)).cast("timestamp_ntz"), "ActionID": F.lit(28)})
                return old.unionByName(first) if self.later else old
            if name == "trailer_visit":
                return df.withColumn("event_created_timestamp", F.least(F.col("event_created_timestamp"), F.lit("1998-06-01").cast("timestamp_ntz")))
            if name == "journey" and self.later:
                return df.withColumn("shipperGateOutTimestamp", F.when(F.col("loadId") == 14, F.lit("1998-06-16").cast("timestamp_ntz")).otherwise(F.col("shipperGateOutTimestamp")))
            return df

    def run(root, later, as_of):
        sources = Changed(spark, SF_SMALL)
        sources.later = later
        run_models(project(spark, sources, as_of), NAMES, root)

    run(tmp_dir, False, LATE - dt.timedelta(hours=1))
    merged = []
    real = sinks.merge_upsert
    monkeypatch.setattr(sinks, "merge_upsert", lambda spark, df, path, *a, **k: (merged.append((os.path.basename(path), df.count())), real(spark, df, path, *a, **k))[1])
    run(tmp_dir, True, LATE)
    rows = dict(merged)
    assert 0 < rows["dim_yard_trailer"] < 60 and rows["first_events"] < 20 and rows["matches"] < 40
    assert rows["journeys"] == 1 and rows["loads"] == rows["contents"] == 0 and rows["reservations"] == 3
    again = os.path.join(tmp_dir, "again")
    monkeypatch.setattr(sinks, "merge_upsert", real)
    run(again, True, LATE)
    assert visits(spark, tmp_dir) == visits(spark, again)


@pytest.mark.parametrize("dies_at", ["dim_yard_trailer", "matches"])
def test_a_run_that_died_is_made_up_for(spark, tmp_dir, full_target, monkeypatch, dies_at):
    run_models(project(spark, Before(spark, SF_SMALL, EVERYTHING), EARLY), NAMES, tmp_dir)
    real = sinks.merge_upsert

    def dying(spark, df, path, *a, **k):
        if os.path.basename(path) == dies_at:
            raise KeyboardInterrupt
        return real(spark, df, path, *a, **k)

    monkeypatch.setattr(sinks, "merge_upsert", dying)
    with pytest.raises(KeyboardInterrupt):
        run_models(project(spark, Since(spark, SF_SMALL, EVERYTHING), LATE), NAMES, tmp_dir)
    monkeypatch.setattr(sinks, "merge_upsert", real)
    run_models(project(spark, Since(spark, SF_SMALL, EVERYTHING), LATE), NAMES, tmp_dir)
    assert visits(spark, tmp_dir) == full_target


def test_changed_keys(spark):
    now = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, None), (5, "e")], "k int, v string")
    before = spark.createDataFrame([(1, "a"), (2, "c"), (2, "b"), (3, "x"), (4, "d")], "v_k int, v string").withColumnRenamed("v_k", "k")
    assert sorted(r.k for r in PG.changed(now, before, ["k"]).collect()) == [3, 4, 5]
