"""Whitening components of embeddings by shifted CholeskyQR.

Entries are put on a grid of whole numbers; each distinct grid vector counts once.  Let A be the centred grid vectors, a
row each.  A pass adds up the Gram matrix of the rows over all tasks, a part per task and entry, and takes its Cholesky
factor R; the next pass solves the rows against the factors so far (a triangular solve per factor) and goes on from there.  The first
Gram matrix is shifted by a multiple of the rounding error, so its factor exists however ill-conditioned A is; the rows
are orthonormal to rounding after a pass or two more.  The factors multiply to the R of A = QR, whose singular values and right vectors, a
small problem, are those of A: squared and divided by the number of rows the eigenvalues of the covariance, to an accuracy
that its own Gram matrix does not have.  Only matrices of dimension x dimension reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quayside.llm.common import prepare, stored

STEP, OFFSET = 64, 1_000_000
COMPONENTS = 16
MAX_PASSES = 8
BLOCK = 4096  # rows of one matrix product
EXACT = 1 << 62
GRID_END = 1 << 40  # grid values are held within +-this, so sums over 4 million rows and more are exact in 64 bits


def grid(vectors: DataFrame, vector: str = "embedding", keep: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """``keep`` and the grid vector ``x`` of every row whose vector has only finite entries, and as many as most rows have
    (of equally frequent lengths the smallest; a vector without entries is dropped)."""
    v = F.col(vector)
    usable = vectors.where(v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: F.coalesce(
        ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False))))
    lengths = usable.groupBy(F.size(v).alias("length")).count().orderBy(F.desc("count"), "length").first()
    whole = F.transform(v, lambda c: F.greatest(F.least(F.floor(F.least(F.greatest(
        c.cast("double") * STEP, F.lit(-1.0 * GRID_END)), F.lit(1.0 * GRID_END))), F.lit(GRID_END)), F.lit(-GRID_END)) + OFFSET)
    return usable.where(F.size(v) == (lengths.length if lengths else 0)).select(*keep, whole.alias("x"))


def matrix(column: pa.ListArray) -> np.ndarray:
    """The rows of a batch of equally long lists."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        x = matrix(batch.column(0)) if batch.num_rows else None
        for lo in range(0, batch.num_rows, BLOCK):
            yield x[lo:lo + BLOCK]


def summed_products(fit: DataFrame, rows: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all grid vectors of the products of every two entries of ``rows`` of them, and of its entries in the
    last column: each task adds up its part, and the parts are summed entry by entry."""
    prepare(fit.sparkSession)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in _blocks(batches):
            q = rows(x)
            q1 = np.column_stack([q, np.ones(len(q))])
            total = q.T @ q1 if total is None else total + q.T @ q1
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()),
                                              pa.array(total.ravel(), pa.float64())], names=["i", "j", "v"])

    parts = fit.select("x").mapInArrow(part, "i int, j int, v double")
    found = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()  # dimension x (dimension + 1) numbers
    out = np.zeros((int(found["i"].max()) + 1, int(found["j"].max()) + 1))
    out[found["i"], found["j"]] = found["v"]
    return out


def solve(factors: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """``rows`` times the inverses of the upper triangular ``factors``, one by one, by substitution."""
    q = np.asarray(rows, float)
    for r in factors:
        out = np.empty_like(q)
        for k in range(r.shape[0]):
            out[:, k] = (q[:, k] - out[:, :k] @ r[:k, k]) / r[k, k]
        q = out
    return q


@dataclass(frozen=True)
class Whitening:
    """n distinct grid vectors with sums S; unit eigenvectors (columns) and eigenvalues, falling; the trace; a bound of error."""
    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float
    passes: int

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.sums)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """x - S/n: whole parts are subtracted as whole numbers, so nothing is lost to the size of x."""
    whole = [divmod(s, n) for s in sums]
    return (x - np.array([w for w, _ in whole], np.int64)) - np.array([r / n for _, r in whole])


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors of ``vectors (x)``; None for an empty table.

    Repeated vectors count once.  Components without variance beyond rounding cannot be scaled and are left out, so fewer than
    ``components`` may come back (none where all vectors are equal)."""
    rows = stored(vectors.select("x").distinct())
    d = rows.select(F.size("x").alias("d")).first()
    if d is None:
        return None
    entries = rows.select(F.posexplode("x").alias("at", "c")).groupBy("at").agg(
        F.sum(F.col("c").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")).collect()  # one row per dimension
    n = entries[0].n
    sums = tuple(int(r.s) for r in sorted(entries, key=lambda r: r.at))
    unit, eps = np.eye(d.d), np.finfo(float).eps
    factors: list[np.ndarray] = []
    trace, final = 0.0, None
    for k in range(MAX_PASSES):
        gram = summed_products(rows, lambda x: solve(factors, _centred(x, n, sums)))[:, :-1]
        gram = (gram + gram.T) / 2
        if k == 0:
            trace = float(np.trace(gram))
            if trace <= 0:
                return Whitening(n, sums, np.empty((d.d, 0)), np.empty(0), 0.0, 0.0, 1)
        elif np.abs(gram - unit).max() < 100 * d.d * eps:
            final = np.linalg.cholesky(gram).T
            break
        shift = 11 * (n * d.d + d.d * (d.d + 1)) * eps / 2 * np.linalg.norm(gram, 2)
        factor = _cholesky(gram, shift if k == 0 else 0.0, shift)
        factors = [*factors, factor]
    if final is None:  # dimensions that others determine keep rows from becoming orthonormal: the Gram matrix's root is used
        value, vector = np.linalg.eigh(gram)
        final = np.sqrt(np.maximum(value, 0))[:, None] * vector.T
        factors = factors[:-1]
    r = final
    for factor in reversed(factors):
        r = r @ factor
    _, sigma, right = np.linalg.svd(r)
    used = min(components, int((sigma > d.d * eps * sigma[0]).sum()))
    found = Whitening(n, sums, right[:used].T, sigma[:used] ** 2 / n, trace / n, 0.0, k + 1)
    products = summed_products(rows, found.whitened)
    mean = products[:, -1] / n
    error = float(np.abs(products[:, :-1] / n - np.outer(mean, mean) - np.eye(used)).max())
    return Whitening(n, sums, found.vectors, found.values, found.trace, error, k + 1)


def _cholesky(gram: np.ndarray, shift: float, otherwise: float) -> np.ndarray:
    """The upper factor of ``gram`` with ``shift`` on the diagonal, or, where there is none, with ``otherwise``."""
    try:
        return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
    except np.linalg.LinAlgError:
        return np.linalg.cholesky(gram + max(otherwise, np.finfo(float).tiny) * np.eye(len(gram))).T


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sum over the dimensions of (n x - S)^2 per row, exactly; None where it does not fit a long."""
    span = max(abs(int(v) * n - s) for s, lo, hi in zip(sums, x.min(0), x.max(0)) for v in (lo, hi))
    if span * span * len(sums) < EXACT:
        off = x * n - np.array(sums, np.int64)
        return (off * off).sum(1).tolist()
    exact = [sum((int(v) * n - s) ** 2 for v, s in zip(row, sums)) for row in x]
    return [e if e < 1 << 63 else None for e in exact]


SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` per usable row and component.

    ``vectors (vec_id, embedding)``: rows whose vector is null, empty, of a rare length, or holds null or non-finite entries are
    dropped; entries over ``GRID_END`` / ``STEP`` in size count as that.  Repeated rows are rows of their own and get equal values.
    Components of equal eigenvalues come in any order, but the same one for all rows.  Components without variance have no
    rows, nor has a table of equal vectors.  Other columns are ignored; an empty table gives an empty result."""
    rows = grid(vectors.select(F.col("vec_id").cast("long"), "embedding"))
    w = fit(rows, components)
    if w is None:
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    count, explained = len(w.values), w.values / w.trace if w.trace else w.values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows if count else 0, BLOCK):
                part = batch.slice(lo, BLOCK)
                x = matrix(part.column(1))
                rows = len(x)
                times = np.repeat(np.arange(rows), count)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(times)),
                    pa.array(np.tile(np.arange(1, count + 1), rows), pa.int32()),
                    pa.array(np.full(rows * count, w.n), pa.int64()),
                    pa.array(deviations(x, w.n, w.sums), pa.int64()).take(pa.array(times)),
                    pa.array(w.whitened(x).ravel(), pa.float64()),
                    pa.array(np.tile(explained, rows), pa.float64()),
                    pa.array(np.full(rows * count, w.identity_error), pa.float64())],
                    names=[c.split()[0] for c in SCHEMA.split(", ")])

    return rows.mapInArrow(run, SCHEMA)
