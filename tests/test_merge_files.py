"""Keyed merges rewrite the files that hold a key of the updates, and finish after any interruption."""
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quayside.operators import sinks

SCHEMA = "k long, g long, v double, created string"


def files(path):
    return {f for f in os.listdir(path) if f.endswith(".parquet")}


def rows(path, spark):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("k", "g", "v", "created").collect())


def table(spark, n=20000):
    return spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 7).alias("g"), F.lit(0.0).alias("v"), F.lit("first").alias("created"))


@pytest.fixture()
def sixteen_files(spark, tmp_dir):
    """A table of 16 files, clustered by k."""
    path = os.path.join(tmp_dir, "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    sinks.merge_upsert(spark, table(spark), path, ["k"], ["v"], ["k"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(files(path)) == 16
    return path


def test_one_percent_of_clustered_keys_rewrites_their_files(spark, sixteen_files):
    path, before = sixteen_files, files(sixteen_files)
    updates = spark.range(5000, 5200).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("g"), F.lit(1.0).alias("v"), F.lit("second").alias("created"))
    out = sinks.merge_upsert(spark, updates, path, ["k"], ["v"], ["k"])
    after = files(path)
    assert 14 <= len(before & after) < 16  # 200 neighbouring keys lie in one file or two
    changed = spark.read.parquet(*[os.path.join(path, f) for f in after - before])
    assert changed.count() < 3 * 20000 / 16
    assert out.count() == 20000 and out.where("v = 1").count() == 200
    assert out.where("created <> 'first' or (k between 5000 and 5199 and g <> k % 7)").count() == 0  # unlisted columns stay


def test_new_keys_touch_no_file(spark, sixteen_files):
    before = files(sixteen_files)
    new = spark.createDataFrame([(30000, 1, 1.0, "second"), (None, 2, 1.0, "second")], SCHEMA)
    out = sinks.merge_upsert(spark, new, sixteen_files, ["k"], ["v"], ["k"])
    assert before < files(sixteen_files) and out.count() == 20002
    again = sinks.merge_upsert(spark, new.withColumn("v", F.lit(2.0)), sixteen_files, ["k"], ["v"], ["k"])
    assert again.count() == 20002 and again.where("v = 2").count() == 2 and before < files(sixteen_files)


def test_rows_of_a_group_that_are_not_emitted_again_go(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    sinks.merge_upsert(spark, spark.createDataFrame([(0, 1, 1.0, "a"), (1, 1, 1.0, "a"), (2, 1, 1.0, "a"), (0, 2, 1.0, "a"), (5, None, 1.0, "a")], SCHEMA),
                       path, ["g", "k"], ["v"], ["g"], group_key=["g"])
    sinks.merge_upsert(spark, spark.createDataFrame([(0, 1, 2.0, "b"), (7, None, 2.0, "b"), (9, 3, 2.0, "b")], SCHEMA),
                       path, ["g", "k"], ["v"], ["g"], group_key=["g"])
    assert sorted(rows(path, spark), key=str) == sorted([(0, 1, 2.0, "a"), (0, 2, 1.0, "a"), (7, None, 2.0, "b"), (9, 3, 2.0, "b")], key=str)


class Died(Exception):
    pass


@pytest.mark.parametrize("survives", range(5))
def test_a_publish_that_dies_anywhere_is_completed(spark, sixteen_files, monkeypatch, survives):
    """The driver dies after ``survives`` file operations of the publish; the next run finishes it."""
    path = sixteen_files
    updates = spark.range(4000, 6000).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("g"), F.lit(1.0).alias("v"), F.lit("second").alias("created"))
    left, real = [survives], sinks._fs

    class Dying:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            def call(*args):
                if name in ("rename", "delete"):
                    if not left[0]:
                        raise Died
                    left[0] -= 1
                return getattr(self.fs, name)(*args)
            return call

    monkeypatch.setattr(sinks, "_fs", lambda s, p: (real(s, p)[0], Dying(real(s, p)[1])))
    with pytest.raises(Died):
        sinks.merge_upsert(spark, updates, path, ["k"], ["v"], ["k"])
    monkeypatch.setattr(sinks, "_fs", real)
    spark.catalog.refreshByPath(path)
    assert sinks.recover_pending(spark, path) == (survives > 0)  # before the first rename nothing had changed
    out = spark.read.parquet(path)
    assert out.count() == out.select("k").distinct().count() == 20000
    assert out.where("v = 1").count() == (2000 if survives else 0)
    assert not sinks.recover_pending(spark, path)


def test_first_run_writes_the_rows_once(spark, tmp_dir, monkeypatch):
    written = []
    path = os.path.join(tmp_dir, "t")
    real = sinks._clustered
    monkeypatch.setattr(sinks, "_clustered", lambda df, *a: written.append(1) or real(df, *a))
    monkeypatch.setattr(sinks, "staged_updates", lambda *a: pytest.fail("a first run stages nothing"))
    assert sinks.merge_upsert(spark, table(spark, 100), path, ["k"], ["v"], ["k"]).count() == 100 and written == [1]


def test_a_table_without_the_key_columns_is_refused_by_name(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    spark.createDataFrame([(1, 1.0)], "k long, v double").write.parquet(path)
    with pytest.raises(ValueError, match="without the columns \\['g', 'created'\\]"):
        sinks.merge_upsert(spark, table(spark, 5), path, ["k", "g"], ["v"])


def test_models_and_written_targets_agree_on_visits_with_several_elements(spark, tmp_dir):
    from quayside.plans.context import fixture_context
    from quayside.plans.project import Project
    from quayside.plans.run import run_models
    built = Project.for_sf_dir(spark, SF_SMALL, fixture_context()).build("dim_yard_trailer")
    p = Project.for_sf_dir(spark, SF_SMALL, fixture_context())
    seen = {}
    real = p.drop_scratch
    p.drop_scratch = lambda: (seen.update(ref=p._built["dim_yard_trailer"]), real())
    path = run_models(p, ["dim_yard_trailer"], os.path.join(tmp_dir, "targets"))["dim_yard_trailer"]
    target = spark.read.parquet(path)
    n = target.groupBy("trailer_visit_id").count().groupBy("count").count().collect()
    assert {r[0] for r in n} >= {1, 3, 9}  # rows per visit
    order = built.columns
    as_text = lambda df: sorted(str(tuple(r)) for r in df.select(*order).collect())
    assert as_text(target) == as_text(built) and seen["ref"].columns == order
    visits = spark.read.parquet(f"{SF_SMALL}/orders.parquet").where("o_orderkey % 23 = 0")
    assert target.join(visits, F.col("o_orderkey") == F.col("trailer_visit_id")).count() == 0  # no facility, no row
