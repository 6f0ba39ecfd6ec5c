"""Data-quality checks as Spark jobs that return violating rows.

A check passes when it returns no rows.  ``run_suite`` evaluates many checks
as one union of small aggregates: one job, one row per check.  ``WriteChecks``
counts the violations of a model's row checks while its rows are written.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Q1: rows where ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Q2: values of ``column`` that occur more than once (NULLs ignored)."""
    return compound_unique(df, [column], ignore_nulls=True)


def accepted_values(df: DataFrame, column: str, values: Sequence, allow_null: bool = False) -> DataFrame:
    """Q3: rows whose value is outside ``values``."""
    return df.where(_outside(column, values, allow_null))


def _outside(column: str, values: Sequence, allow_null: bool) -> Column:
    ok = F.col(column).isin(list(values))
    if allow_null:
        ok = ok | F.col(column).isNull()
    return ~F.coalesce(ok, F.lit(False))


def compound_unique(df: DataFrame, columns: Sequence[str], ignore_nulls: bool = False) -> DataFrame:
    """Q4: key combinations that occur more than once, with their count.

    A partial aggregate per task runs before the shuffle, so a hot key costs
    one row per task in the exchange.
    """
    src = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])) if ignore_nulls else df
    return (src.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
               .where(F.col("n_records") > 1))


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Q5: child rows whose non-NULL key has no parent row."""
    keys = parent.select(F.col(parent_column).alias("__parent_key")).distinct()
    child = df.where(F.col(column).isNotNull())
    return child.join(keys, child[column] == keys["__parent_key"], "left_anti")


@dataclass(frozen=True)
class Check:
    kind: str              # not_null | unique | accepted_values | compound_unique | relationships
    model: str
    columns: tuple[str, ...]
    values: tuple = ()
    allow_null: bool = False
    parent: str | None = None
    parent_column: str | None = None


def violations(check: Check, frames: dict[str, DataFrame]) -> DataFrame:
    df = frames[check.model]
    if check.kind == "not_null":
        return not_null(df, check.columns[0])
    if check.kind == "unique":
        return unique(df, check.columns[0])
    if check.kind == "accepted_values":
        return accepted_values(df, check.columns[0], check.values, check.allow_null)
    if check.kind == "compound_unique":
        return compound_unique(df, check.columns)
    if check.kind == "relationships":
        return relationships(df, check.columns[0], frames[check.parent], check.parent_column)
    raise ValueError(check.kind)


def run_suite(checks: Sequence[Check], frames: dict[str, DataFrame]) -> DataFrame:
    """One row per check: (check, model, columns, n_violations).  All not-null checks of a
    model share one scan and aggregate."""
    null_columns: dict[str, list[str]] = {}
    rows = []
    for c in checks:
        if c.kind == "not_null":
            null_columns.setdefault(c.model, []).append(c.columns[0])
        else:
            rows.append(violations(c, frames).agg(F.count(F.lit(1)).alias("n_violations")).select(
                F.lit(c.kind).alias("check"), F.lit(c.model).alias("model"),
                F.lit(",".join(c.columns)).alias("columns"), "n_violations"))
    for model, columns in null_columns.items():
        counted = frames[model].agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
        rows.append(counted.select(F.explode(F.array(*[F.struct(
            F.lit("not_null").alias("check"), F.lit(model).alias("model"), F.lit(c).alias("columns"),
            F.col(c).alias("n_violations")) for c in columns])).alias("r")).select("r.*"))
    return reduce(lambda a, b: a.unionByName(b), rows)


class WriteChecks:
    """The checks of a model that look at one row at a time, counted by the tasks that write the rows.

    ``watch`` goes on the rows as the last step before the write, above every
    exchange: each written partition counts once, whatever is tried again or
    sampled below.  The target is not read for it.
    """

    def __init__(self, model: str, checks: Sequence[Check] | None = None):
        declared = MODEL_CHECKS if checks is None else checks
        self.checks = [c for c in declared if c.model == model and c.kind in ("not_null", "accepted_values")]
        self._watched: Observation | None = None

    def watch(self, df: DataFrame) -> DataFrame:
        if not self.checks:
            return df
        self._watched = Observation()
        violated = [F.col(c.columns[0]).isNull() if c.kind == "not_null" else _outside(c.columns[0], c.values, c.allow_null)
                    for c in self.checks]
        return df.observe(self._watched, F.count(F.lit(1)).alias("n_rows"),
                          *[F.count(F.when(v, 1)).alias(f"check_{k}") for k, v in enumerate(violated)])

    def results(self) -> list[dict]:
        """After the write, one entry per check, named as in ``run_suite``, with the number of rows written."""
        if self._watched is None:
            return []
        seen = self._watched.get
        return [{"check": c.kind, "model": c.model, "columns": ",".join(c.columns), "n_violations": seen[f"check_{k}"],
                 "n_rows": seen["n_rows"]} for k, c in enumerate(self.checks)]


# The checks declared on the models (grains of SURVEY §1.4).
MODEL_CHECKS = [
    Check("compound_unique", "metric_fill_rate", ("warehouse_id", "report_date", "cadence", "ship_class")),
    Check("not_null", "metric_fill_rate", ("warehouse_id",)),
    Check("not_null", "metric_fill_rate", ("report_date",)),
    Check("not_null", "metric_fill_rate", ("ship_class",)),
    Check("compound_unique", "metric_inbound_trailers", ("inbound_reservation_id", "report_date")),
    Check("not_null", "metric_inbound_trailers", ("warehouse_id",)),
    Check("not_null", "metric_inbound_trailers", ("report_date",)),
    Check("compound_unique", "metric_yard_utilization", ("warehouse_id", "report_date")),
    Check("not_null", "metric_yard_utilization", ("warehouse_id",)),
    Check("not_null", "metric_yard_utilization", ("report_date",)),
    Check("compound_unique", "metric_throughput_variance", ("warehouse_id", "report_date")),
    Check("not_null", "metric_throughput_variance", ("warehouse_id",)),
    Check("not_null", "stg_unit_snapshot", ("inbound_trailer_reservation_id",)),
    Check("unique", "stg_unit_snapshot", ("inbound_trailer_reservation_id",)),
    Check("accepted_values", "stg_unit_snapshot", ("arrival_status",),
          values=("arrived_early", "arrived_on_time", "arrived_late"), allow_null=True),
    Check("compound_unique", "stg_yard_utilization", ("warehouse_id", "upload_date", "yard_capacity")),
    Check("not_null", "stg_yard_utilization", ("warehouse_id",)),
    Check("compound_unique", "report_inbound", ("metric_id", "metric_name", "time_base_date", "warehouse_name", "country_long")),
    Check("compound_unique", "report_outbound", ("metric_id", "metric_name", "time_base_date", "warehouse_name", "country_long")),
]
