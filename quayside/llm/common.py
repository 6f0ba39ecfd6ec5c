"""Helpers the operators share: table access, Arrow batch mapping, bounded caches,
and connected components over an edge table."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quayside.session import checkpoint_dir

# Bytes of one Arrow batch handed to Python: bounds a task's memory when texts are long.
BATCH_BYTES = "4194304"
# The white space that separates words in every contract here, as Spark (Java) and Python regular expressions.
WORD_RE = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"
# The longest key a cache keeps, in characters (or bytes, for keys of bytes).
LONGEST_KEY = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Bounds Arrow batches in bytes, and sends this package to the executors' Python workers (once per application)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for f in (package / "__init__.py", package / "session.py", *sorted((package / "llm").glob("*.py"))):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(spark.sparkContext.applicationId)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` over Arrow batches of ``df``; batches are bounded in bytes, so a batch of very long texts stays small."""
    prepare(df.sparkSession)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            if batch.num_rows:
                yield fn(batch)

    return df.mapInArrow(batches, schema)


def durable(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder: lineage is cut, and lost executors cost no recomputation."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as parquet to the shared checkpoint folder and read back: joins with it are planned by its size."""
    path = f"{checkpoint_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


class TwoGenerationCache(dict):
    """``cache[key]`` computes a missing value with ``make``; at most two generations of ``limit`` keys stay in memory.

    A full young generation retires when the next key is missed, also in the midst of a document; a retired key that is asked for again moves
    back.  Keys met often therefore stay.  Keys longer than ``LONGEST_KEY`` characters are computed each time and never kept, so where a value is at most
    in proportion to its key, the bytes are bounded by the number of keys as well."""

    def __init__(self, make: Callable, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        if len(key) > LONGEST_KEY:
            return self.make(key)
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of the undirected ``edges (a, b)``; ``component`` is the smallest node reachable.

    Alternating large-star and small-star rounds: in each, the neighbours of a node are linked to the smallest of
    them.  A round is one grouping by node and one join; rows never exceed the edges.  The edges of one centre meet in
    one task, so a component with a large share of the nodes is one task's share of a round.  Both round results are checkpointed in the shared folder.  Edges with a null end are ignored."""
    e = (edges.where("a is not null and b is not null and a <> b")
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = durable(e)
    seen = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large star: neighbours larger than the node hang on the smallest of the neighbourhood
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # small star: smaller neighbours and the node itself hang on the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = (joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        e = durable(small)
        now = e.agg(F.count("*").alias("n"), F.sum(F.hash("u", "v").cast("decimal(30,0)")).alias("h"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("x")).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("connected components did not settle")
    # settled: a forest of stars (every edge hangs a node on its component's smallest node)
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
