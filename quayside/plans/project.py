"""Model registry and ``ref()`` resolution.

A model is a function ``(project) -> DataFrame``.  ``Project.ref(name)`` gives
an upstream model once per project.  In a run with targets, a model that has
one is its written target, after this run's merge or overwrite (a model that
the run does not write is read as it stands).  Other models are materialised
as parquet in the session's shared checkpoint folder, which cuts lineage
between layers the way the reference's tables do.
"""

from __future__ import annotations

import os
import threading
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from quayside.plans.context import RunContext, fixture_context
from quayside.session import checkpoint_dir
from quayside.sources.registry import Sources

MODELS: dict[str, Callable[["Project"], DataFrame]] = {}


def model(name: str):
    def register(fn):
        MODELS[name] = fn
        return fn
    return register


class Project:
    def __init__(self, spark: SparkSession, sources: Sources, ctx: RunContext,
                 materialize: bool = True, materialize_dir: str | None = None):
        self.spark = spark
        self.src = sources
        self.ctx = ctx
        self.materialize = materialize
        self._materialize_dir = materialize_dir
        self.run_id = uuid.uuid4().hex[:12]
        self._built: dict[str, DataFrame] = {}
        self._locks: dict[str, threading.Lock] = {}
        self._locks_guard = threading.Lock()
        # previous versions of incremental targets ({{ this }}), by model name
        self.targets: dict[str, DataFrame] = {}
        # results of the row checks counted while a run wrote its models
        self.write_checks: list[dict] = []
        # set by a run: gives the target of a model, written first if the run is to write it, or None
        self.target_of: Callable[[str], DataFrame | None] = lambda name: None

    @classmethod
    def for_sf_dir(cls, spark: SparkSession, sf_dir: str, ctx: RunContext | None = None, **kw) -> "Project":
        return cls(spark, Sources(spark, sf_dir), ctx or fixture_context(), **kw)

    def fork(self) -> "Project":
        """A project that reuses the models built so far but keeps its own
        incremental targets and later builds (for runs that set ``targets``)."""
        child = Project(self.spark, self.src, self.ctx, materialize=self.materialize,
                        materialize_dir=os.path.join(self.materialize_dir, "fork-" + uuid.uuid4().hex[:8]))
        child._built = dict(self._built)
        return child

    def source(self, name: str) -> DataFrame:
        return self.src.get(name)

    @property
    def materialize_dir(self) -> str:
        if self._materialize_dir is None:
            self._materialize_dir = os.path.join(checkpoint_dir(self.spark), "quayside", self.run_id)
        return self._materialize_dir

    def build(self, name: str) -> DataFrame:
        """The model as a lazy DataFrame; its upstream models come through ``ref``."""
        _load_models()
        return MODELS[name](self)

    def ref(self, name: str) -> DataFrame:
        """An upstream model.  With ``materialize`` it is written once as parquet
        under the shared checkpoint folder and read back (a table, as in the
        reference): later plans scan it with column pruning and pushdown
        instead of recomputing its lineage, and the result survives executor loss."""
        if name in self._built:
            return self._built[name]
        with self._locks_guard:
            lock = self._locks.setdefault(name, threading.Lock())
        with lock:  # concurrent runs build each model once; models form a DAG, so no lock cycle
            if name not in self._built:
                df = self.target_of(name)
                if df is not None:
                    self._built[name] = df
                    return df
                df = self.build(name)
                if self.materialize:
                    path = os.path.join(self.materialize_dir, name)
                    df.write.mode("overwrite").parquet(path)
                    df = self.spark.read.parquet(path)
                self._built[name] = df
        return self._built[name]

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` written once as a scratch table of this run and read back."""
        path = os.path.join(self.materialize_dir, f"{name}-{uuid.uuid4().hex[:8]}")
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def dimension(self, name: str, *cols, source: bool = False) -> DataFrame:
        """Columns of a dimension (model or source) for joining; statistics and AQE decide whether it is broadcast."""
        df = self.source(name) if source else self.ref(name)
        return df.select(*cols) if cols else df

    def drop_scratch(self) -> None:
        """Delete the scratch tables of this run; models that were read from them are built anew when asked for."""
        from quayside.operators.sinks import delete_path
        delete_path(self.spark, self.materialize_dir)
        self._built = {}

    def this(self, name: str) -> DataFrame | None:
        """Previous content of an incremental target, if one was registered."""
        return self.targets.get(name)


def _load_models() -> None:
    # import for the side effect of @model registration
    from quayside.plans import (  # noqa: F401
        dim_date, dim_warehouse, fill_rate, inbound_trailers, on_yard, reporting,
        snapshot, throughput, units, yard_trailer, yard_utilization,
    )
