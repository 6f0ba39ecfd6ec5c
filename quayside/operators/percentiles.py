"""Discrete percentiles of groups of any size.

Rows are counted per (group, value) and the counted values sorted into ranges
over all groups, which are written once with their numbers.  A group with
many distinct values is cut into several ranges.  Sums of ranges (one row per
group and range) tell which range of a group holds its percentile; only that
range's values are summed up one by one, so no task holds more than a range.
"""

from __future__ import annotations

import os
import uuid
from typing import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import checkpoint_dir


def _stored(df: DataFrame) -> DataFrame:
    path = os.path.join(checkpoint_dir(df.sparkSession), "quayside-percentiles", uuid.uuid4().hex)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def discrete_percentile(df: DataFrame, key: str, value: str, alias: str, percent: int = 50, ranges: int | None = None,
                        store: Callable[[DataFrame], DataFrame] = _stored) -> DataFrame:
    """``PERCENTILE_DISC(value, percent / 100)`` per ``key``, as a double: the smallest value whose running count reaches that share.

    NULL values do not count; a group of NULLs alone has the percentile NULL; the NULL key is a group.  ``percent`` is a whole number
    from 0 (the smallest value) to 100.  ``ranges`` defaults to the session's shuffle partitions.  ``store`` writes
    the counted values and reads them back, by default in the shared checkpoint folder; this starts a job.
    """
    if not 0 <= percent <= 100:
        raise ValueError("percent must lie between 0 and 100")
    counted = df.select(F.col(key).alias("__k"), F.col(value).alias("__v")).groupBy("__k", "__v").agg(F.count("__v").alias("__n"))
    order = [F.col("__k"), F.col("__v")]
    split = counted.repartitionByRange(ranges, *order) if ranges else counted.repartitionByRange(*order)
    ranged = store(split.withColumn("__range", F.spark_partition_id()))

    of = Window.partitionBy("__k")
    earlier = of.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("__k", "__range").agg(F.sum("__n").alias("__in")).select(
        "__k", "__range", "__in", F.coalesce(F.sum("__in").over(earlier), F.lit(0)).alias("__before"), F.sum("__in").over(of).alias("__all"))
    # the rank looked for: the first whose share of the values is not below the percentile
    rank = F.greatest(F.lit(1).cast("bigint"), F.expr(f"(__all * {int(percent)} + 99) div 100"))
    sums = sums.withColumn("__rank", F.when(F.col("__all") > 0, rank))
    holding = sums.where((F.col("__before") < F.col("__rank")) & (F.col("__rank") <= F.col("__before") + F.col("__in")))

    inside = holding.select(F.col("__k").alias("__hk"), F.col("__range").alias("__hr"), "__before", "__rank")
    rows = ranged.where("__n > 0").join(inside, F.col("__k").eqNullSafe(F.col("__hk")) & (F.col("__range") == F.col("__hr")))
    running = Window.partitionBy("__k", "__range").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    reached = rows.withColumn("__run", F.col("__before") + F.sum("__n").over(running)).where(F.col("__run") >= F.col("__rank"))
    found = reached.groupBy("__k").agg(F.min("__v").alias("__v"))
    without = sums.where("__all = 0").select("__k").distinct().withColumn("__v", F.lit(None))
    return found.unionByName(without).select(F.col("__k").alias(key), F.col("__v").cast("double").alias(alias))
