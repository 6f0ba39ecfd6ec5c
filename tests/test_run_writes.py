"""A run writes every model it names, also those its project built before."""

from __future__ import annotations

import os

from conftest import SF_SMALL
from quayside.catalog import shared_project
from quayside.plans.run import run_models


def test_a_run_writes_a_model_built_before(spark, tmp_dir):
    p = shared_project(spark, SF_SMALL).fork()
    built = p.ref("dim_warehouse").count()
    path = run_models(p, ["dim_warehouse"], tmp_dir)["dim_warehouse"]
    assert os.path.isdir(path) and spark.read.parquet(path).count() == built
