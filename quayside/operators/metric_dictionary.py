"""Metric dictionaries: files of metric definitions, evaluated with one pass per model.

A dictionary is a YAML (or JSON) mapping of metric ids to entries.  A metric is ``final_aggregation`` over
``agg(numerator)`` and ``agg(denominator)``, per time base and grain of its model.  Under ``variation`` an entry holds
further metrics by letter, which take what they do not set from the entry; their ids are ``id.letter``.  ``filter``
(an SQL predicate) limits the rows a metric sees.

Metrics that share a model, a time base and a level (rows as they are, or aggregated) are evaluated together: one scan and one
aggregate that computes each distinct side once, then one row per group and metric by ``explode``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, fields
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F

# The names of a dictionary entry's fields.
DESCRIPTIVE = ("technical_definition", "unit_concept", "is_cdl_sourced")
FIELDS = ("metric_name", "unit", "reporting_time_base", "numerator_aggregation_function", "numerator",
          "denominator_aggregation_function", "denominator", "final_aggregation", "model")
AS_IS = "already_aggregated"
AGGREGATIONS: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum, "count": F.count, "count_distinct": F.count_distinct, "avg": F.avg, "max": F.max, "min": F.min,
    "median": F.median}


@dataclass(frozen=True)
class Metric:
    """One metric of a dictionary; sides are SQL expressions over the model's columns, or numbers."""
    metric_id: str
    metric_name: str
    model: str
    numerator: str | float
    denominator: str | float = 1
    numerator_aggregation_function: str = AS_IS
    denominator_aggregation_function: str = AS_IS
    final_aggregation: str = "safe_divide(numerator,denominator)"
    reporting_time_base: str = "report_date"
    unit: str | None = None
    filter: str | None = None

    def __post_init__(self):
        for side in ("numerator", "denominator"):
            how = getattr(self, f"{side}_aggregation_function")
            if how != AS_IS and how not in AGGREGATIONS:
                raise ValueError(f"metric {self.metric_id}: unknown aggregation {how!r} of its {side}")
            if self.aggregated and how == AS_IS and isinstance(getattr(self, side), str):
                raise ValueError(f"metric {self.metric_id}: its {side} is not aggregated, the other side is")

    @property
    def aggregated(self) -> bool:
        return {self.numerator_aggregation_function, self.denominator_aggregation_function} != {AS_IS}


def parse(dictionary: Mapping) -> list[Metric]:
    """The metrics of a loaded dictionary, variations after their entry.  Unknown and missing fields are refused by name."""
    metrics: list[Metric] = []
    for number, entry in dictionary.items():
        base = {k: v for k, v in entry.items() if k != "variation"}
        for letter, own in [("", {}), *(entry.get("variation") or {}).items()]:
            metric_id = f"{number}.{letter}" if letter else str(number)
            values = {**base, **own}
            if unknown := sorted(set(values) - {*FIELDS, *DESCRIPTIVE, "filter"}):
                raise ValueError(f"metric {metric_id}: unknown fields {unknown}")
            if missing := [k for k in ("metric_name", "model", "numerator") if values.get(k) is None]:
                raise ValueError(f"metric {metric_id}: missing fields {missing}")
            known = {f.name for f in fields(Metric)}
            metrics.append(Metric(metric_id, **{k: v for k, v in values.items() if k in known and v is not None}))
    if len({m.metric_id for m in metrics}) < len(metrics):
        raise ValueError("metric ids repeat")
    return metrics


def load(path: str | Path) -> list[Metric]:
    """The metrics of a dictionary file: JSON if so named, else YAML."""
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith(".json"):
        return parse(json.loads(text))
    import yaml  # only files in YAML need it
    return parse(yaml.safe_load(text) or {})


def plan(metrics: Sequence[Metric]) -> dict[tuple[str, str, bool], list[Metric]]:
    """Metrics by what they can share: (model, time base, aggregated)."""
    passes: dict[tuple[str, str, bool], list[Metric]] = {}
    for m in metrics:
        passes.setdefault((m.model, m.reporting_time_base, m.aggregated), []).append(m)
    return passes


def evaluate_all(metrics: Sequence[Metric], model_of: Callable[[str], DataFrame], by: Sequence[str]) -> DataFrame:
    """``(*by, time_base_date, metric_id, metric_name, unit, numerator, denominator, metric_value)``, one pass per entry of ``plan``.

    Aggregated metrics have a row per group in which their filter holds for some row; metrics of rows as they are have a row per row
    that their filter lets through.  ``safe_divide`` by zero or null is null; null group values are a group."""
    if not metrics:
        raise ValueError("no metrics")
    return reduce(DataFrame.unionByName, [
        _one_pass(model_of(model), time_base, aggregated, together, by)
        for (model, time_base, aggregated), together in plan(metrics).items()])


def _one_pass(frame: DataFrame, time_base: str, aggregated: bool, metrics: Sequence[Metric], by: Sequence[str]) -> DataFrame:
    computed: dict[tuple, Column] = {}  # each distinct side, and each filter, once

    def named(key: tuple, value: Callable[[], Column]) -> Column:
        if key not in computed:
            computed[key] = value().alias(f"__m{len(computed)}")
        return F.col(f"__m{list(computed).index(key)}")

    def side(m: Metric, which: str) -> Column:
        expr, how = getattr(m, which), getattr(m, f"{which}_aggregation_function")
        value = F.expr(expr) if isinstance(expr, str) else F.lit(expr)
        if how == AS_IS:
            return named((expr,), lambda: value) if isinstance(expr, str) else value
        seen = value if m.filter is None else F.when(F.expr(m.filter), value)
        return named((how, expr, m.filter), lambda: AGGREGATIONS[how](seen))

    def holds(m: Metric) -> Column:
        if m.filter is None:
            return F.lit(True)
        kept = F.coalesce(F.expr(m.filter), F.lit(False))
        return named(("filter", m.filter), lambda: F.count_if(kept) > 0 if aggregated else kept)

    rows = [F.when(holds(m), F.struct(
        F.lit(m.metric_id).alias("metric_id"), F.lit(m.metric_name).alias("metric_name"), F.lit(m.unit).cast("string").alias("unit"),
        side(m, "numerator").cast("double").alias("numerator"), side(m, "denominator").cast("double").alias("denominator")))
        for m in metrics]
    keys = [*[F.col(c) for c in by], F.col(time_base).alias("time_base_date")]
    sides = list(computed.values())
    if aggregated:
        wide = frame.groupBy(*keys).agg(*sides)
    else:
        wide = frame.select(*keys, *sides)
    tall = wide.select(*by, "time_base_date", F.explode(F.filter(F.array(*rows), lambda r: r.isNotNull())).alias("__m")) \
        .select(*by, "time_base_date", "__m.*")
    finals: dict[str, list[str]] = {}
    for m in metrics:
        finals.setdefault(m.final_aggregation, []).append(m.metric_id)
    value = F.lit(None).cast("double")
    for final, ids in finals.items():
        value = F.when(F.col("metric_id").isin(ids), F.expr(final.replace("safe_divide", "try_divide")).cast("double")).otherwise(value)
    return tall.withColumn("metric_value", value)
