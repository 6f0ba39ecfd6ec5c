"""Declared sources: a dropped or retyped column fails by name; catalogue tables are read."""
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quayside.operators import sinks
from quayside.plans.context import fixture_context
from quayside.plans.project import Project
from quayside.sources.declared import DECLARED, SchemaError, check
from quayside.sources.registry import STAND_INS, Sources


def test_every_stand_in_has_the_declared_columns(spark):
    src = Sources(spark, SF_SMALL)
    assert set(DECLARED) == set(STAND_INS)
    for name, declared in DECLARED.items():
        check(name, src.get(name).schema, declared.schema())


def test_a_dropped_or_retyped_column_fails_by_name(spark, tmp_dir):
    path = os.path.join(tmp_dir, "reservation")
    good = Sources(spark, SF_SMALL).get("reservation").withColumn("extra", F.lit(1))
    good.write.parquet(path)
    assert Sources(spark, SF_SMALL, paths={"reservation": path}).get("reservation").count() == good.count()
    good.drop("siteID").withColumn("IsInbound", F.col("IsInbound").cast("string")).write.mode("overwrite").parquet(path)
    with pytest.raises(SchemaError, match="source reservation: column siteID is missing; column IsInbound is string, not boolean"):
        Sources(spark, SF_SMALL, paths={"reservation": path}).get("reservation")


def test_a_table_of_other_types_is_not_merged_into(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    sinks.merge_upsert(spark, spark.createDataFrame([(1, 1.0)], "k long, v double"), path, ["k"], ["v"])
    with pytest.raises(SchemaError, match="column v is double, not string"):
        sinks.merge_upsert(spark, spark.createDataFrame([(1, "x")], "k long, v string"), path, ["k"], ["v"])
    assert spark.read.parquet(path).collect()[0].v == 1.0


def test_models_read_catalogue_tables(spark, tmp_dir):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS yard_test LOCATION '{tmp_dir}/db'")
    try:
        stand_ins = Sources(spark, SF_SMALL)
        for name in ("yard_sheet", "spot_capacity"):
            stand_ins.get(name).write.mode("overwrite").saveAsTable(f"yard_test.{name}")
        want = sorted(map(str, Project.for_sf_dir(spark, SF_SMALL, fixture_context()).build("stg_yard_utilization").collect()))
        for src in (Sources(spark, databases={"curated": "yard_test"}),
                    Sources(spark, paths={n: f"table:yard_test.{n}" for n in ("yard_sheet", "spot_capacity")})):
            assert sorted(map(str, Project(spark, src, fixture_context()).build("stg_yard_utilization").collect())) == want and want
        with pytest.raises(KeyError, match="country"):
            Sources(spark).get("country")
    finally:
        spark.sql("DROP DATABASE yard_test CASCADE")
