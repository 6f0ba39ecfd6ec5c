"""Materialise models into their targets with the sink each one is configured for.

The configuration mirrors the reference's model configs (SURVEY S6-S10):
full-refresh tables, ``report_date`` insert-overwrite metrics, and keyed
merges for the dimensions and the tall reports.  ``run_models`` builds each
requested model once, from the written targets of its upstream models, and
writes it to its own; running it twice leaves the targets unchanged.
"""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import DataFrame

from quayside.functions import backfill as B
from quayside.operators import metrics as M
from quayside.operators import quality as Q
from quayside.operators import sinks
from quayside.plans import dim_warehouse as DW
from quayside.plans import propagation as PG
from quayside.plans import range_runs as RR
from quayside.plans import reporting as RP
from quayside.plans import yard_trailer as YT
from quayside.plans.project import Project


@dataclass(frozen=True)
class Materialization:
    kind: str                                   # table | insert_overwrite | merge
    cluster_by: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    unique_key: tuple[str, ...] = ()
    update_columns: tuple[str, ...] = field(default_factory=tuple)
    group_key: tuple[str, ...] = ()             # rows of a group that a run does not emit again are removed
    target_only: tuple[str, ...] = ()           # key columns that the target has beside the model's


_METRIC = Materialization("insert_overwrite", cluster_by=("warehouse_id",), partition_by=("report_date",))
_REPORT_KEY = ("surrogate_key", "time_base_date", *RP.ROW_KEY)

# How each model is materialised.
MATERIALIZATIONS: dict[str, Materialization] = {
    "dim_warehouse": Materialization("merge", unique_key=(DW.UNIQUE_KEY,), update_columns=tuple(DW.MERGE_UPDATE_COLUMNS)),
    "dim_date": Materialization("table", cluster_by=("date_actual",)),
    "dim_yard_trailer": Materialization("merge", cluster_by=("trailer_visit_id",), unique_key=YT.UNIQUE_KEY,
                                        update_columns=tuple(YT.MERGE_UPDATE_COLUMNS), group_key=YT.GROUP_KEY,
                                        target_only=("visit_element",)),
    "stg_units_reservation": Materialization("table"),
    "stg_unit_snapshot": Materialization("table"),
    "stg_yard_utilization": Materialization("table"),
    "metric_fill_rate": _METRIC,
    "metric_inbound_trailers": _METRIC,
    "metric_on_yard_units": _METRIC,
    "metric_throughput_variance": _METRIC,
    "metric_yard_utilization": _METRIC,
    "report_inbound": Materialization("merge", partition_by=("time_base_date",), unique_key=_REPORT_KEY,
                                      update_columns=tuple(M.MERGE_UPDATE_COLUMNS)),
    "report_outbound": Materialization("merge", partition_by=("time_base_date",), unique_key=_REPORT_KEY,
                                       update_columns=tuple(M.MERGE_UPDATE_COLUMNS)),
}


# Models whose rows are keyed by more columns than they show.
KEYED = {**RP.KEYED, "dim_yard_trailer": YT.keyed_visits}
# Models whose incremental run emits only rows with a new record hash.
HASH_DIFF_MODELS = {"dim_warehouse"}
# Models whose later runs recompute only what changed, from a state kept beside the targets.
PROPAGATED_MODELS = {"dim_yard_trailer"}


def _frame(p: Project, name: str, target: DataFrame | None) -> DataFrame:
    """The model as this run computes it; incrementally where ``target`` exists."""
    if target is not None and name in HASH_DIFF_MODELS:
        p.targets[name] = target
    return KEYED[name](p) if name in KEYED else p.build(name)


def _propagated(p: Project, name: str, path: str, target: DataFrame | None) -> None:
    """Merge what changed since the last run, or, without its state, all rows, into the target at ``path``."""
    m = MATERIALIZATIONS[name]
    parent, table = os.path.split(path.rstrip("/"))
    state = PG.State(p, os.path.join(parent, "_state", table))
    found = None if target is None else PG.incremental(p, state, target)
    if found is None:
        (rows, keep), visits = PG.full(p, state), None
    else:
        rows, visits, keep = found
    sinks.merge_upsert(p.spark, rows, path, m.unique_key, m.update_columns, m.cluster_by, group_key=m.group_key, groups=visits)
    keep()


def materialize(p: Project, name: str, path: str) -> DataFrame:
    """Build ``name``, write it to its target and give the target as it then is."""
    m = MATERIALIZATIONS[name]
    target = None
    if m.kind == "merge":
        sinks.recover_pending(p.spark, path)  # before the target is read
        target = sinks.read_table(p.spark, path)
    if name in PROPAGATED_MODELS:
        _propagated(p, name, path, target)
        return p.spark.read.parquet(path)
    df = _frame(p, name, target)
    checks = Q.WriteChecks(name)
    if m.kind == "table":
        df = sinks.ci_limit(df, p.ctx.ci_limit, df.columns)
        sinks.write_table(df, path, cluster_by=m.cluster_by, watch=checks.watch)
    elif m.kind == "insert_overwrite":
        sinks.insert_overwrite(df, path, partition_by=m.partition_by, cluster_by=m.cluster_by, watch=checks.watch)
    else:
        if m.partition_by:
            sinks.merge_upsert_partitions(p.spark, df, path, m.unique_key, m.update_columns, m.partition_by, m.cluster_by)
        else:
            sinks.merge_upsert(p.spark, df, path, m.unique_key, m.update_columns, m.cluster_by, group_key=m.group_key)
    p.write_checks.extend(checks.results())
    return p.spark.read.parquet(path)


def backfill_metrics(p: Project, names: Sequence[str], target_root: str) -> dict[str, str]:
    """Write the report dates of the run's manual bounds (``backfill_start`` to ``backfill_end``, run days) of each metric
    in one pass per metric, over the written targets of its upstream models as they stand."""
    bounds = B.manual_bounds(p.ctx)
    if not all(bounds.values()):
        raise ValueError("a backfill needs manual_backfill, backfill_start and backfill_end among the run's parameters")

    def target_of(name: str) -> DataFrame | None:
        if name not in MATERIALIZATIONS:
            return None
        path = os.path.join(target_root, name)
        sinks.recover_pending(p.spark, path)
        df = sinks.read_table(p.spark, path)
        return df if df is None else df.drop(*MATERIALIZATIONS[name].target_only)

    p.target_of = target_of
    try:
        rows = RR.rows_of_range(p, list(names), bounds["backfill_start"], bounds["backfill_end"])
        paths = {name: os.path.join(target_root, name) for name in names}
        for name, df in rows.items():
            m, checks = MATERIALIZATIONS[name], Q.WriteChecks(name)
            sinks.insert_overwrite(df, paths[name], partition_by=m.partition_by, cluster_by=m.cluster_by, watch=checks.watch)
            p.write_checks.extend(checks.results())
    finally:
        p.target_of = lambda name: None
        p.drop_scratch()
    return paths


def run_models(p: Project, names: Sequence[str], target_root: str, threads: int = 1) -> dict[str, str]:
    """Write each model to ``target_root/<name>``; returns the paths.

    Every model is built once: ``ref`` of a model in ``names`` writes its target
    first and reads it back, so kept columns and merged history reach the models
    downstream; ``ref`` of another model that has a target reads it as it stands.
    Scratch tables of models without a target are deleted at the end.

    ``threads`` > 1 submits independent models concurrently (the reference's run
    profile has the same setting); Spark interleaves their jobs, and a shared
    upstream model is still built once.  ``p.write_checks`` then holds what the row
    checks of the written models counted during the writes.
    """
    paths = {name: os.path.join(target_root, name) for name in names}

    def target_of(name: str) -> DataFrame | None:
        if name in paths:
            df = materialize(p, name, paths[name])
        elif name in MATERIALIZATIONS:
            path = os.path.join(target_root, name)
            sinks.recover_pending(p.spark, path)
            df = sinks.read_table(p.spark, path)
        else:
            return None
        return df if df is None else df.drop(*MATERIALIZATIONS[name].target_only)

    p.target_of = target_of
    for name in names:
        p._built.pop(name, None)  # built before the run, not written by it
    try:
        if threads <= 1:
            for name in names:
                p.ref(name)
        else:
            with ThreadPoolExecutor(max_workers=threads) as pool:
                for f in [pool.submit(p.ref, name) for name in names]:
                    f.result()
    finally:
        p.target_of = lambda name: None
        p.drop_scratch()
    return paths
