"""Hot keys: one trailer number / reservation holding most rows must not make
any operator emit per-group pairs, and results must equal brute force."""
import datetime as dt
import os

import pandas as pd
from pyspark.sql import functions as F

from quayside.catalog import shared_project
from quayside.operators import relops as R
from quayside.plans.yard_trailer import _sad_matches
from quayside.sources.registry import Sources
from conftest import SF_SMALL


def _events(spark, n_res=3000, hot_share=3):
    base = dt.datetime(1998, 6, 1)
    rows = []
    for r in range(n_res):
        trailer = "TR-7" if r % hot_share == 0 else f"TR-{1000 + r}"  # a third share one trailer number
        rows.append((r, 28, base + dt.timedelta(hours=7 * r % 480), None, trailer,
                     base + dt.timedelta(hours=7 * r % 480)))
    return spark.createDataFrame(rows, "ReservationID long, ActionID int, EventDate timestamp_ntz, BolNumber string, "
                                       "TrailerNumber string, trailer_loading_complete_datetime timestamp_ntz")


def test_band_join_on_hot_trailer_is_one_match_per_load(spark, tmp_dir):
    base = dt.datetime(1998, 6, 1)
    load_rows = [(i, None, "7" if i % 2 == 0 else str(1000 + i), base + dt.timedelta(hours=11 * i % 500))
                 for i in range(2000)]
    path = os.path.join(tmp_dir, "loads")
    spark.createDataFrame(load_rows, "load_id long, reference_number string, trailer_number string, "
                                     "actual_ship_date timestamp_ntz").write.parquet(path)
    p = shared_project(spark, SF_SMALL).fork()
    p.src = Sources(spark, SF_SMALL, paths={"load_master": path})
    ev = _events(spark)
    p._built["first_reservation_event"] = ev
    loads = p.source("load_master").select("load_id", "trailer_number", "actual_ship_date")
    got = _sad_matches(p).toPandas()
    assert got["load_id"].is_unique
    # brute force: every (load, event) pair within the band, smallest reservation per load
    e = ev.toPandas()
    e["tkey"] = e["TrailerNumber"].str.replace(r"^[a-zA-Z_-]+([0-9]+)$", r"\1", regex=True)
    e["d"] = pd.to_datetime(e["trailer_loading_complete_datetime"]).dt.normalize()
    lo = loads.toPandas()
    lo["tkey"] = lo["trailer_number"].str.replace(r"^[a-zA-Z_-]+([0-9]+)$", r"\1", regex=True)
    lo["d"] = pd.to_datetime(lo["actual_ship_date"]).dt.normalize()
    pairs = lo.merge(e, on="tkey")
    pairs = pairs[(pairs["d_x"] >= pairs["d_y"] - pd.Timedelta(days=1)) & (pairs["d_x"] <= pairs["d_y"] + pd.Timedelta(days=1))]
    want = pairs.groupby("load_id")["ReservationID"].min().reset_index().rename(columns={"ReservationID": "reservationID"})
    got = got.sort_values("load_id").reset_index(drop=True)
    want = want.sort_values("load_id").reset_index(drop=True)
    assert len(want) > 0
    pd.testing.assert_frame_equal(got[["load_id", "reservationID"]], want[["load_id", "reservationID"]], check_dtype=False)


def test_pick_first_on_hot_key_forwards_local_winners(spark):
    df = spark.range(200_000).select((F.col("id") % 3 == 0).cast("int").alias("k"), F.col("id").alias("v"))
    out = R.pick_first(df.repartition(8), ["k"], [F.col("v").desc()])
    assert sorted((r.k, r.v) for r in out.collect()) == [(0, 199_999), (1, 199_998)]
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    plan = buf.getvalue()
    # a partial top-1 runs before the exchange, so a hot key ships one row per task
    assert plan.count("WindowGroupLimit") >= 2


def test_clustered_write_splits_a_hot_key(spark, tmp_dir):
    """A clustering value holding a third of the rows is written by several tasks."""
    from quayside.operators import sinks
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("warehouse_id"),
                                    F.col("id").alias("v"))
    path = os.path.join(tmp_dir, "clustered")
    # at this size AQE would merge every range into one partition; without coalescing
    # the ranges stand in for the large partitions of a real table
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        sinks.write_table(df, path, cluster_by=["warehouse_id"])
    finally:
        spark.conf.set(key, old)
    back = spark.read.parquet(path)
    files = back.where(F.col("warehouse_id") == 7).select(F.input_file_name()).distinct().count()
    assert back.count() == 60_000 and files > 1


def test_null_heavy_keys_are_salted_not_dropped(spark):
    """Anti and left joins on keys that are mostly NULL equal the plain joins."""
    left = spark.range(20_000).select(F.when(F.col("id") % 4 != 0, F.lit(None)).otherwise(F.col("id") % 100).alias("k"),
                                      F.col("id").alias("v"))
    right = spark.range(50).select(F.col("id").alias("rk"), (F.col("id") * 10).alias("w"))
    def rows(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, x or 0) for x in t))

    plain_anti = left.join(right, left.k == right.rk, "left_anti")
    salted_anti = R.anti_join(left, right.withColumnRenamed("rk", "k"), "k")
    assert rows(plain_anti) == rows(salted_anti)
    plain_left = left.join(right, left.k == right.rk, "left")
    salted_left = R.left_join_nullable(left, right, "k", "rk")
    assert rows(plain_left) == rows(salted_left.select(*plain_left.columns))
