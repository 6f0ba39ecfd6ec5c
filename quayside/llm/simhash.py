"""SimHash near-duplicates by pigeonhole blocks.

Fingerprints that differ in at most ``distance`` bits agree in at least ``blocks - distance`` of the blocks they are
split into.  So every set of ``blocks - distance`` blocks is a join key: close pairs share at least one.  Members of a key are
verified by their Hamming distance, and links are closed to components.  Equal fingerprints are one node throughout.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from quayside.llm import buckets
from quayside.llm.common import arrow_map, connected_components, durable

BITS = 64
SHINGLE, DISTANCE = 4, 4
BLOCKS = 6        # 15 keys of two blocks, 20 to 22 bits each
SEED = 42
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the text's word shingles (A-Z lower-cased; words end at ASCII white space)."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    counts, total = np.zeros(BITS, np.int64), 0
    digest = xxhash.xxh64_intdigest
    for at in range(0, max(1, len(words) - shingle + 1), HASHES_AT_ONCE):
        part = words[at:at + HASHES_AT_ONCE + shingle - 1]
        data = b" ".join(part)
        lengths = np.fromiter(map(len, part), np.int64, len(part))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        if len(part) < shingle:
            hashes = [digest(data, SEED)]
        else:
            hashes = [digest(data[a:b], SEED) for a, b in zip(starts.tolist(), ends[shingle - 1:].tolist())]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
        total += len(hashes)
    return int.from_bytes(np.packbits(2 * counts > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, carry: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, fp)`` and the long columns ``carry`` per row; ``fp`` holds the 64 bits as a signed long."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps), *batch.columns[2:]], names=["doc_id", "fp", *carry])

    return arrow_map(docs.select(docs["doc_id"].cast("long"), docs["text"], *carry), fn,
                     ", ".join(["doc_id long, fp long", *(f"{c} long" for c in carry)]))


def block_keys(fp: Column, distance: int, blocks: int) -> Column:
    """One key per choice of ``blocks - distance`` blocks: ``struct(choice, bits)`` with the bits of those blocks."""
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    masks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    keys = []
    for n, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        mask = sum(masks[b] for b in chosen)
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        keys.append(F.struct(F.lit(n).alias("choice"), fp.bitwiseAND(F.lit(signed).cast("long")).alias("bits")))
    return F.array(*keys)


def _close(distance: int):
    def fn(rows: pd.DataFrame, lo: int, hi: int):
        part = rows.iloc[lo:hi]
        fps = part["fp"].to_numpy().view(np.uint64)
        mask = buckets.met_in_tile(part["part"].to_numpy(), part["one"].iat[0], part["two"].iat[0])
        if mask is None:
            return None
        i, j = np.nonzero(mask & (np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance))
        if not len(i):
            return None
        low = buckets.lowest_linked(len(fps), i, j)
        moved = np.flatnonzero(low != np.arange(len(fps)))
        return part["fp"].to_numpy()[moved], part["fp"].to_numpy()[low[moved]]

    return fn


def links(fps: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """``(a, b)``: links that connect what the close pairs of the distinct ``fps (fp)`` connect."""
    if not 0 <= distance < blocks:
        raise ValueError("distance must be under the number of blocks")
    keyed = fps.select("fp", F.explode(block_keys(F.col("fp"), distance, blocks)).alias("k")).select("fp", "k.choice", "k.bits")
    key = ["choice", "bits"]
    tiled = buckets.tiles(buckets.shared(keyed, key), key, "fp").select(*key, "deal", "part", "one", "two", "fp")
    return buckets.for_tiles(tiled, key, _close(distance), "a long, b long")


def _lowest(rows: DataFrame, pick: Column, distance: int, blocks: int) -> DataFrame:
    """``(fp, component, lowest)``: the component of each fingerprint, and the least ``pick`` among all its rows."""
    classes = durable(rows.groupBy("fp").agg(F.min(pick).alias("lowest")))
    joined = connected_components(links(classes.select("fp"), distance, blocks)).withColumnRenamed("node", "fp")
    of = classes.join(joined, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    lowest = of.groupBy("component").agg(F.min("lowest").alias("lowest"))
    return of.select("fp", "component").join(lowest, "component")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row of ``docs (doc_id, text)``; the fingerprint in 16 hex digits.

    A null or wordless text has fingerprint zero and links like any other.  ``component_id`` is the smallest non-null
    ``doc_id`` reachable over links (null where a component has only null ids).  Repeated rows stay rows of their own
    and are copies of each other.  Other columns are ignored; an empty table gives an empty result."""
    rows = durable(fingerprints(docs, shingle))
    found = _lowest(rows, F.col("doc_id"), distance, blocks)
    return rows.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                         F.col("lowest").alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """One row of ``docs`` per component, with its columns as they are: the one with the smallest non-null ``doc_id``; of
    rows that share it, the one with the smallest hash (rows equal throughout are one); null ids come after all others."""
    hashed = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    keys = {"__k1": F.xxhash64(*hashed), "__k2": F.xxhash64(F.lit("second"), *hashed)}  # 128 bits name a row
    rows = durable(fingerprints(docs.withColumns(keys), shingle, tuple(keys)))
    pick = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", *keys)
    chosen = _lowest(rows, pick, distance, blocks).select("component", "lowest").distinct().select("lowest.__k1", "lowest.__k2")
    return docs.withColumns(keys).join(chosen, list(keys), "left_semi").dropDuplicates(list(keys)).drop(*keys)
