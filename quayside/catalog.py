"""Registered queries: one per operator / pipeline of SURVEY §2.

Each entry is ``(spark, sf_dir) -> DataFrame`` and reads the driver tables
of ``sf_dir`` (through the stand-in sources) with the fixed ``as_of`` of the
fixtures.  Operator entries exercise one operator over whole tables; the
``M*`` entries are the full pipelines.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from quayside.plans.context import fixture_context
from quayside.plans.project import Project
from quayside.session import configure

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


_SHARED: dict[tuple[str, str], Project] = {}


def shared_project(spark: SparkSession, sf_dir: str) -> Project:
    """One project per (Spark application, data folder): upstream models are
    materialised once and reused by every query of the session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SHARED:
        _SHARED[key] = Project.for_sf_dir(spark, sf_dir, fixture_context())
    return _SHARED[key]


def query(key: str):
    def register(fn: Callable[[Project], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(shared_project(spark, sf_dir))
        run.__name__ = f"q_{key}"
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        return fn
    return register


def model_query(key: str, model_name: str | None = None) -> None:
    name = model_name or key

    def fn(p: Project) -> DataFrame:
        return p.build(name)
    fn.__doc__ = f"Pipeline {name}."
    query(key)(fn)


def load() -> dict[str, QueryFn]:
    from quayside.plans import operator_queries  # noqa: F401  (registers operator entries)
    for key in PIPELINE_KEYS:
        if key not in QUERIES:
            model_query(key)
    return QUERIES


# M1-M21 (model name = key)
PIPELINE_KEYS = [
    "dim_warehouse", "first_reservation_event", "load_reservation_match", "load_gate_out", "dim_yard_trailer",
    "units_happy_sad", "units_json_fallback", "units_priority", "units_carton_qc_xd", "units_median_backup",
    "stg_units_reservation", "stg_unit_snapshot", "stg_yard_utilization", "metric_fill_rate",
    "metric_inbound_trailers", "metric_on_yard_units", "metric_throughput_variance", "metric_yard_utilization",
    "report_inbound", "report_outbound",
]
