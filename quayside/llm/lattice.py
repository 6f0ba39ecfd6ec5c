"""Near-duplicate vectors by lattice hashing.

Each of several tables projects a vector to eight dimensions and decodes it to the nearest point of the E8 lattice, its
cell.  A vector is stored in its own cell and probes the nearest neighbouring ones, so two close vectors meet where one
is stored in a cell the other is stored in or probes.  Pairs that meet are verified by cosine in double precision.  A pair
that meets often is counted once, at the first table and cell it meets in.  Equal vectors are one node with a count of
copies.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations, product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quayside.llm import buckets
from quayside.llm.common import arrow_map, connected_components, durable

THRESHOLD = 0.95
TABLES, PROBES = 8, 4
# Standard deviation of projected coordinates, in units of the lattice: at cosine 0.95 a pair meets in one table with a
# probability of about 0.47, so in some of eight with 0.99; cells number some 10^5.
SCALE = 1.0
SEED = 20


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer point with an even sum."""
    r = np.rint(x)
    e = x - r
    odd = np.flatnonzero(r.sum(1).astype(np.int64) & 1)
    k = np.abs(e[odd]).argmax(1)
    r[odd, k] += np.where(e[odd, k] >= 0, 1, -1)
    return r


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8: D8, or D8 shifted by one half."""
    whole, half = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1))[:, None], whole, half)


@cache
def e8_neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    found = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            v = [0.0] * 8
            v[i], v[j] = a, b
            found.append(v)
    found += [list(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(found)


@cache
def projections(dim: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per table: a random projection of ``dim`` dimensions to eight, and a shift."""
    rng = np.random.default_rng([SEED, dim])
    return [(rng.normal(size=(dim, 8)) * SCALE, rng.uniform(0, 1, 8)) for _ in range(TABLES)]


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def cells(unit: np.ndarray) -> np.ndarray:
    """Cell numbers ``[vector, table, 1 + PROBES]``: the own cell first, then the nearest neighbouring cells."""
    mixer = np.random.default_rng(SEED).integers(1, 1 << 62, 8).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.empty((len(unit), TABLES, 1 + PROBES), np.int64)
    for t, (matrix, shift) in enumerate(projections(unit.shape[1])):
        y = unit @ matrix + shift
        own = nearest_e8(y)
        near = np.argsort(-((y - own) @ e8_neighbours().T), axis=1, kind="stable")[:, :PROBES]
        points = np.concatenate([own[:, None, :], own[:, None, :] + e8_neighbours()[near]], axis=1)
        doubled = np.rint(2 * points).astype(np.int64).astype(np.uint64)
        out[:, t] = (doubled * mixer).sum(2, dtype=np.uint64).view(np.int64)
    return out


def _by_length(vectors: list) -> dict[int, np.ndarray]:
    """Positions of the vectors of each length."""
    lengths = np.array([len(v) for v in vectors])
    return {int(d): np.flatnonzero(lengths == d) for d in np.unique(lengths)}


def _index(batch: pa.RecordBatch) -> pa.RecordBatch:
    ids = batch.column(0).to_numpy()
    vectors = [np.asarray(v.values) for v in batch.column(1)]
    out = []
    for dim, at in _by_length(vectors).items():
        found = cells(units(np.stack([vectors[i] for i in at])))
        n = len(at)
        out.append((np.repeat(ids[at], TABLES * (1 + PROBES)), np.full(found.size, dim),
                    np.tile(np.repeat(np.arange(TABLES), 1 + PROBES), n), found.reshape(-1),
                    np.tile(np.arange(1 + PROBES) == 0, n * TABLES)))
    columns = [np.concatenate(c) for c in zip(*out)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in (columns[0], columns[1].astype("int32"), columns[2].astype("int32"),
                                                            columns[3], columns[4])],
                                      names=["class_id", "dim", "tab", "cell", "stored"])


def first_meetings(i: np.ndarray, j: np.ndarray, found: np.ndarray, tab: int, cell: int) -> np.ndarray:
    """For pairs ``i, j`` that meet in ``cell`` of table ``tab``: whether this is the first table and cell they meet in."""
    first = np.ones(len(i), bool)
    for t in range(tab + 1):
        a, b = found[i, t], found[j, t]
        there = (a[:, :1] == b).any(1)  # a is stored where b is stored or probes
        back = (b[:, :1] == a).any(1)
        if t < tab:
            first &= ~(there | back)
        else:
            high = np.iinfo(np.int64).max
            first &= np.minimum(np.where(there, a[:, 0], high), np.where(back, b[:, 0], high)) == cell
    return first


def _verify(threshold: float):
    def fn(rows: pd.DataFrame, lo: int, hi: int):
        part = rows.iloc[lo:hi]
        mask = buckets.met_in_tile(part["part"].to_numpy(), part["one"].iat[0], part["two"].iat[0])
        if mask is None:
            return None
        stored = part["stored"].to_numpy()
        unit = units(np.stack(part["embedding"].to_numpy()))
        i, j = np.nonzero(mask & (stored[:, None] | stored[None, :]) & (unit @ unit.T >= threshold))
        if not len(i):
            return None
        linked = np.unique(np.concatenate((i, j)))
        found = np.empty((len(part), TABLES, 1 + PROBES), np.int64)
        found[linked] = cells(unit[linked])
        first = first_meetings(i, j, found, int(part["tab"].iat[0]), int(part["cell"].iat[0]))
        copies, counted = part["copies"].to_numpy(), np.zeros(len(part), np.int64)
        np.add.at(counted, i[first], copies[j[first]])
        np.add.at(counted, j[first], copies[i[first]])
        ids, low = part["class_id"].to_numpy(), buckets.lowest_linked(len(part), i, j)
        return ids[linked], counted[linked], ids[low[linked]]

    return fn


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row of ``vectors (vec_id, embedding)``.

    ``n_links`` counts the other rows with a cosine of ``threshold`` or more that share or neighbour a cell; none below
    it is linked.  Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, also not
    with copies of themselves; vectors of different lengths never link.  Repeated rows are copies, each a row of its own.
    ``component_id`` is the smallest non-null ``vec_id`` reachable; a null ``vec_id`` is linked like others and never
    kept.  Other columns are ignored; an empty table gives an empty result."""
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding")
    sound = F.expr("embedding is not null and size(embedding) > 0 and not exists(embedding, x -> x is null or isnan(x) "
                   "or abs(x) = double('infinity')) and exists(embedding, x -> x <> 0)")
    valid = rows.where(sound)
    classes = durable(valid.groupBy("embedding").agg(F.min("vec_id").alias("lowest"), F.count("*").alias("copies"))
                      .withColumn("class_id", F.monotonically_increasing_id()))
    index = arrow_map(classes.select("class_id", "embedding"), _index,
                      "class_id long, dim int, tab int, cell long, stored boolean")
    key = ["dim", "tab", "cell"]
    tiled = buckets.tiles(buckets.shared(index, key, "n >= 2 and n_stored >= 1"), key, "class_id")
    tiled = tiled.join(classes.select("class_id", "embedding", "copies"), "class_id").select(
        *key, "deal", "part", "one", "two", "stored", "class_id", "embedding", "copies")
    found = durable(buckets.for_tiles(tiled, key, _verify(threshold), "class_id long, links long, partner long"))
    counts = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    joined = connected_components(found.select(F.col("class_id").alias("a"), F.col("partner").alias("b")))
    of = (classes.join(counts, "class_id", "left")
          .join(joined.withColumnRenamed("node", "class_id"), "class_id", "left")
          .withColumn("component", F.coalesce("component", "class_id")))
    lowest = of.groupBy("component").agg(F.min("lowest").alias("component_id"))
    by_vector = of.join(lowest, "component").select(
        "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = valid.join(by_vector, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(sound, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
