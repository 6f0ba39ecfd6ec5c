"""Comparing the members of candidate buckets in bounded tiles.

A bucket of at most ``TILE`` members is one tile; a larger one is cut into parts of about ``TILE`` members, and every
two parts meet in one tile.  Small buckets are dealt many to a task.  So no task holds a bucket whatever its size, and
tiles of a hot bucket spread over the cluster.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from quayside.llm.common import durable

TILE = 512
ROWS_PER_GROUP = 8192


def shared(members: DataFrame, bucket: list[str], wanted: str = "n >= 2") -> DataFrame:
    """``members`` of buckets that fulfil ``wanted`` (over ``n``, the members, and ``n_stored`` if there is a column
    ``stored``), with ``n``."""
    counts = [F.count("*").alias("n")]
    if "stored" in members.columns:
        counts.append(F.sum(F.col("stored").cast("long")).alias("n_stored"))
    sizes = members.groupBy(*bucket).agg(*counts).where(wanted).select(*bucket, "n")
    return members.join(sizes, bucket)


def tiles(members: DataFrame, bucket: list[str], member: str) -> DataFrame:
    """``members`` (with ``n``) dealt to tiles: columns ``deal`` (the group to work on), ``part`` (the member's own),
    ``one`` and ``two`` (the parts that meet in the tile).  A member of part p of k parts is in k tiles."""
    members = durable(members)
    deals = max(1, members.count() // ROWS_PER_GROUP)
    parts = F.ceil(F.col("n") / TILE).cast("long")
    cut = members.withColumn("part", F.pmod(F.xxhash64(member), parts))
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))) \
        .withColumn("one", F.least("part", "other")).withColumn("two", F.greatest("part", "other")).drop("other")
    return met.withColumn("deal", F.when(parts == 1, F.pmod(F.xxhash64(*bucket), F.lit(deals)))
                          .otherwise(F.xxhash64(*bucket, "one", "two")))


def each_tile(rows: pd.DataFrame, bucket: list[str]) -> Iterator[tuple[int, int]]:
    """Row ranges of the tiles in ``rows``, which must be sorted by bucket, ``one``, ``two``."""
    keys = rows[[*bucket, "one", "two"]].to_numpy()
    cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
    yield from zip(np.concatenate(([0], cuts)).tolist(), np.concatenate((cuts, [len(rows)])).tolist())


def for_tiles(tiled: DataFrame, bucket: list[str], fn: Callable[[pd.DataFrame, int, int], tuple | None],
              schema: str) -> DataFrame:
    """``fn(rows, from, to)`` for each tile; it gives a tuple of equally long arrays in the order of ``schema``."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([*bucket, "one", "two"], kind="stable", ignore_index=True)
        found = [out for lo, hi in each_tile(rows, bucket) if (out := fn(rows, lo, hi)) is not None]
        if not found:
            return pd.DataFrame({n: np.empty(0, "int64") for n in names})
        return pd.DataFrame({n: np.concatenate(c) for n, c in zip(names, zip(*found))})

    return tiled.groupBy("deal").applyInPandas(run, schema)


def met_in_tile(parts: np.ndarray, one: int, two: int) -> np.ndarray | None:
    """Mask of the pairs a tile is in charge of: within one part above the diagonal, or across its two parts; None
    where the tile has no such pair."""
    n = len(parts)
    if one == two:
        return np.triu(np.ones((n, n), bool), 1) if n > 1 else None
    first = parts == one
    return first[:, None] & ~first[None, :] if 0 < first.sum() < n else None


def lowest_linked(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For items ``0..n-1`` with links ``i - j``: the smallest item reachable."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
        if (label == before).all():
            return label
