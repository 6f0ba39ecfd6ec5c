"""The newest snapshot of a table partitioned by upload date is all that the scan reads."""
import contextlib
import datetime as dt
import io
import os

from pyspark.sql import functions as F

from quayside.operators import relops as R


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_newest_upload_is_a_partition_filter(spark, tmp_dir):
    path = os.path.join(tmp_dir, "uploads")
    days = F.expr("date_add(DATE'2025-01-01', cast(id % 20 as int))")
    spark.range(2000).select(F.col("id").alias("v"), days.alias("upload_date")).write.partitionBy("upload_date").parquet(path)
    table = spark.read.parquet(path)
    got = R.newest(table, "upload_date")
    scans = [part for part in _plan(got).split("\n\n") if "Scan parquet" in part]
    assert any("PartitionFilters" in s and "upload_date" in s and "Subquery" in s and "ReadSchema: struct<v:bigint>" in s for s in scans)
    assert any("ReadSchema: struct<>" in s for s in scans)  # the maximum reads no data column
    opened = got.select(F.input_file_name().alias("f")).distinct().collect()
    assert opened and all("upload_date=2025-01-20" in r.f for r in opened)
    assert sorted(r.v for r in got.collect()) == list(range(19, 2000, 20))


def test_ties_nulls_and_empty_tables(spark):
    day = dt.date(2025, 1, 1)
    df = spark.createDataFrame([(1, day), (2, day), (3, None), (4, day - dt.timedelta(1))], "k long, d date")
    assert sorted(r.k for r in R.newest(df, "d").collect()) == [1, 2]
    assert R.newest(df.where("k = 3"), "d").collect() == []
    assert R.newest(df.limit(0), "d").collect() == []
