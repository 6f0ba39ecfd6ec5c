"""Discrete percentiles against DuckDB's, and a group of very many distinct values over many ranges."""
import glob
import os
import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayside.operators.percentiles import discrete_percentile
from quayside.session import checkpoint_dir


@pytest.mark.parametrize("percent", [0, 1, 33, 50, 90, 100])
@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_against_another_engine(spark, percent, ranges):
    rng = random.Random(percent * 100 + ranges)
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), rng.choice([None, *range(12), -5.5, 1e9])) for _ in range(500)]
    rows += [("nulls", None), ("nulls", None), ("one", 4), ("even", 1), ("even", 2)]
    rows = [(k, None if v is None else float(v)) for k, v in rows]
    t = pa.table({"k": [r[0] for r in rows], "v": pa.array([r[1] for r in rows], pa.float64())})
    con = duckdb.connect()
    con.register("t", t)
    want = con.execute(f"SELECT k, quantile_disc(v, {percent / 100}) FROM t GROUP BY k").fetchall()
    df = spark.createDataFrame(rows, "k string, v double")
    got = [(r.k, r.p) for r in discrete_percentile(df, "k", "v", "p", percent, ranges).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_and_bounds(spark):
    df = spark.createDataFrame([], "k string, v long")
    assert discrete_percentile(df, "k", "v", "p").collect() == []
    with pytest.raises(ValueError):
        discrete_percentile(df, "k", "v", "p", 101)


def test_hot_group_of_distinct_values_is_cut(spark):
    n = 300_000
    before = set(glob.glob(os.path.join(checkpoint_dir(spark), "quayside-percentiles", "*")))
    df = spark.range(n).select((F.col("id") % 100 == 0).alias("k"), (F.col("id") * 7919 % n).alias("v"))
    got = {r.k: r.p for r in discrete_percentile(df, "k", "v", "p", 50, 16).collect()}
    rows = [(i % 100 == 0, i * 7919 % n) for i in range(n)]
    for k in (True, False):
        values = sorted(v for g, v in rows if g == k)
        assert got[k] == values[-(-len(values) // 2) - 1]
    path, = set(glob.glob(os.path.join(checkpoint_dir(spark), "quayside-percentiles", "*"))) - before
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy("__range").count().collect()]
    assert len(sizes) >= 15 and max(sizes) < n / 8  # the hot group has 99 % of the rows
