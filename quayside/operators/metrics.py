"""Metric dictionary and the tall metric table.

A metric is ``final_aggregation(agg(numerator), agg(denominator))`` over a
model.  The reporting tables stack many metrics into one tall table keyed by
a surrogate key over (metric_id, metric_name, time_base_date,
warehouse_name, country_long).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions import calendar as cal
from quayside.functions import scalar as S

KEY_COLUMNS = ["metric_id", "metric_name", "time_base_date", "warehouse_name", "country_long"]
TALL_COLUMNS = ["surrogate_key", "dwh_creation_timestamp", "dwh_modified_timestamp", *KEY_COLUMNS,
                "metric_numerator", "metric_denominator"]
# The columns a merge updates.
MERGE_UPDATE_COLUMNS = ["dwh_modified_timestamp", "metric_numerator", "metric_denominator"]


@dataclass(frozen=True)
class MetricBranch:
    """One branch of the tall table: a labelled numerator/denominator pair."""
    metric_id: str
    metric_name: str
    numerator: str        # column of the per-group frame
    denominator: str | float = 1.0


def stack_branches(grouped: DataFrame, dims: Sequence[str], branches: Sequence[MetricBranch]) -> DataFrame:
    """Turn one wide row per group into one tall row per branch.

    ``explode`` of an array of structs: one pass, no shuffle, duplicates of
    repeated branches kept (a UNION ALL of identical branches does the same).
    """
    def branch(b: MetricBranch) -> Column:
        den = F.col(b.denominator) if isinstance(b.denominator, str) else F.lit(b.denominator)
        return F.struct(F.lit(b.metric_id).alias("metric_id"), F.lit(b.metric_name).alias("metric_name"),
                        F.col(b.numerator).cast("double").alias("metric_numerator"),
                        den.cast("double").alias("metric_denominator"))
    exploded = grouped.select(*dims, F.explode(F.array(*[branch(b) for b in branches])).alias("m"))
    return exploded.select(*dims, "m.*")


def tall_rows(df: DataFrame, as_of, also: Sequence[str] = ()) -> DataFrame:
    """K2: add the surrogate key and audit columns, in the tall column order, then the columns ``also``."""
    ts = cal.lit_ntz(as_of)
    return df.select(
        S.surrogate_key(KEY_COLUMNS).alias("surrogate_key"),
        ts.alias("dwh_creation_timestamp"), ts.alias("dwh_modified_timestamp"),
        *KEY_COLUMNS, "metric_numerator", "metric_denominator", *also)


@dataclass(frozen=True)
class MetricDefinition:
    """K1: an entry of the metric dictionary."""
    metric_name: str
    numerator: str
    denominator: str | float
    numerator_aggregation: str = "already_aggregated"   # or sum / count / avg / max / min
    denominator_aggregation: str = "already_aggregated"
    final_aggregation: str = "safe_divide"
    model: str = ""
    reporting_time_base: str = "report_date"


_AGG = {"sum": F.sum, "count": F.count, "avg": F.avg, "max": F.max, "min": F.min}


def _side(expr: str | float, how: str) -> Column:
    c = F.expr(expr) if isinstance(expr, str) else F.lit(expr)
    return c if how == "already_aggregated" else _AGG[how](c)


def evaluate(defn: MetricDefinition, df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Evaluate a dictionary metric over ``df`` per ``by`` (plus the time base)."""
    keys = [*by, defn.reporting_time_base]
    num = _side(defn.numerator, defn.numerator_aggregation)
    den = _side(defn.denominator, defn.denominator_aggregation)
    if defn.numerator_aggregation == "already_aggregated" and defn.denominator_aggregation == "already_aggregated":
        out = df.select(*keys, num.alias("numerator"), den.alias("denominator"))
    else:
        out = df.groupBy(*keys).agg(num.alias("numerator"), den.alias("denominator"))
    if defn.final_aggregation != "safe_divide":
        raise ValueError(f"unsupported final aggregation {defn.final_aggregation!r}")
    return out.select(*keys, F.lit(defn.metric_name).alias("metric_name"),
                      F.col("numerator").cast("double").alias("numerator"),
                      F.col("denominator").cast("double").alias("denominator"),
                      S.safe_divide(F.col("numerator").cast("double"), F.col("denominator").cast("double")).alias("metric_value"))


# The daily fill-rate dictionary entry and its variation.
DAILY_FILL_RATE = MetricDefinition("Daily FR", numerator="fill_rate_mm", denominator=1.0, model="metric_fill_rate")
WEEKLY_FILL_RATE = MetricDefinition("Weekly FR", numerator="fill_rate_mm", denominator=1.0, model="metric_fill_rate")
