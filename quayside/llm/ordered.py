"""Running sums over a total order of all rows, computed in ranges: no task holds more than one range."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from quayside.llm.common import stored


def running_sums(rows: DataFrame, order: Sequence[Column], sums: Mapping[str, Column]) -> DataFrame:
    """``rows`` with, per entry of ``sums``, the sum (a long) of its column over all rows before the row in ``order``.

    Rows are sorted into ranges, which are written with their numbers to the shared folder, so a range keeps its rows
    whatever is computed again.  A range's sums are added up where it lies; only these, one row per range, are summed in one
    task, and each row adds the sum within its range.  ``order`` must be a total order, but for rows that are equal
    throughout.  A value that holds many rows is cut into ranges where later columns of ``order`` tell its rows apart."""
    names = {name: f"__v{k}" for k, name in enumerate(sums)}
    valued = rows.withColumns({v: sums[name].cast("long") for name, v in names.items()})
    ranged = stored(valued.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("__range").agg(*[F.sum(v).alias(f"{v}s") for v in names.values()])
    starts = starts.select("__range", *[F.coalesce(F.sum(f"{v}s").over(earlier), F.lit(0)).alias(f"{v}s") for v in names.values()])
    within = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.join(starts, "__range")
    return out.withColumns({name: F.col(f"{v}s") + F.coalesce(F.sum(v).over(within), F.lit(0)) for name, v in names.items()}) \
        .drop("__range", *names.values(), *[f"{v}s" for v in names.values()])
