"""Whitening against a decomposition in exact and in higher precision."""
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quayside.llm import whitening as W

SCHEMA = "vec_id long, embedding array<double>, x string, n int, component string"


def frame(spark, vectors):
    return spark.createDataFrame([(k, None if v is None else [None if c is None else float(c) for c in v], "x", 1, "c")
                                  for k, v in enumerate(vectors)], SCHEMA).repartition(3)


def on_grid(vectors) -> list[tuple[int, ...]]:
    return [tuple(int(np.floor(64 * c)) + 1_000_000 for c in v) for v in vectors]


def check(rows, vectors, ids=None):
    """Every value of ``rows`` against the definitions over the distinct grid vectors."""
    ids = range(len(vectors)) if ids is None else ids
    x = dict(zip(ids, on_grid(vectors)))
    distinct = sorted(set(x.values()))
    n, d = len(distinct), len(distinct[0])
    sums = [sum(v[k] for v in distinct) for k in range(d)]
    a = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums)] for v in distinct])
    left, sigma, right = np.linalg.svd(a, full_matrices=False)
    value = sigma ** 2 / n
    got = {}
    for r in rows:
        got.setdefault(r.component, {}).setdefault(r.vec_id, []).append(r)
    used = min(16, int((sigma > d * np.finfo(float).eps * sigma[0]).sum()))
    assert sorted(got) == list(range(1, used + 1))
    for c, of in got.items():
        assert set(of) == set(x)
        b = {i: np.array([float(Fraction(n * e - s, n)) for e, s in zip(v, sums)]) for i, v in x.items()}
        want = {i: b[i] @ right[c - 1] / np.sqrt(value[c - 1]) for i in x}
        first = max(want, key=lambda i: abs(want[i]))
        sign = np.sign(of[first][0].whitened * want[first])
        for i, found in of.items():
            for r in found:
                assert r.n == n and r.deviation == sum((n * e - s) ** 2 for e, s in zip(x[i], sums))
                assert r.whitened * sign == pytest.approx(want[i], rel=1e-7, abs=1e-7)
                assert r.explained == pytest.approx(value[c - 1] / value.sum(), rel=1e-6)
                assert r.identity_error < 1e-4
    z = np.array([[got[c][next(i for i in x if x[i] == v)][0].whitened for c in sorted(got)] for v in distinct])
    assert np.abs(z.T @ z / n - np.eye(used)).max() < 1e-6


def test_against_a_direct_decomposition(spark):
    g = np.random.default_rng(1)
    vectors = (g.normal(size=(300, 20)) * np.geomspace(9, 0.2, 20)) @ np.linalg.qr(g.normal(size=(20, 20)))[0] + 3
    vectors = [*vectors, *vectors[:50]]  # repeats count once in the fit
    check(W.whiten(frame(spark, vectors)).collect(), vectors)


def test_ill_conditioned_and_dependent_dimensions(spark):
    g = np.random.default_rng(2)
    base = g.integers(-20000, 20000, size=(120, 4)).astype(float)
    near = base[:, :1] + g.integers(0, 2, size=(120, 1)) / 64  # differs by a grid step at most
    vectors = np.hstack([base, near, base[:, 1:2], np.full((120, 1), 7.0)])  # one repeats, one is constant
    rows = W.whiten(frame(spark, vectors)).collect()
    check(rows, vectors)
    assert max(r.component for r in rows) == 5


def test_rows_that_are_dropped_and_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1, 2], None, [1, None], [nan, 1], [inf, 1], [-inf, 1], [], [1, 2, 3], [2, 5], [4, 4], [1, 2]]
    usable = [0, 8, 9, 10]
    rows = W.whiten(frame(spark, vectors)).collect()
    check(rows, [vectors[k] for k in usable], usable)
    assert W.whiten(frame(spark, [[1, 2], [1, 2]])).collect() == []  # no variance
    assert W.whiten(frame(spark, [])).collect() == [] and W.whiten(frame(spark, [None])).collect() == []
    assert W.whiten(frame(spark, [[1e300, 0], [0, 1], [2, 2]])).count() == 6
    assert sorted(W.whiten(frame(spark, [])).columns) == sorted(W.whiten(frame(spark, [[1, 2], [1, 2]])).columns)


def test_deviation_is_exact_beyond_64_bits():
    x = np.array([[1_000_000, 5_000_000], [3_000_000_000, 1]], np.int64)
    n, sums = 3_000_000_000, (3_000_000_000_000_000 + 7, 15_000_000_000_000_000 - 1)
    assert W.deviations(x, n, sums)[0] == 7 ** 2 + 1 and W.deviations(x, n, sums)[1] is None


def test_first_factor_exists_though_the_gram_matrix_is_singular(spark):
    """Condition 1e9: the Gram matrix loses the small direction, the passes do not."""
    g = np.random.default_rng(3)
    big = g.integers(-2**33, 2**33, size=(200, 2)).astype(float)
    vectors = np.column_stack([big, big @ [1, 1] + g.integers(0, 3, size=200)])
    w = W.fit(W.grid(frame(spark, vectors)))
    x = np.array(on_grid(vectors), float) - np.array(on_grid(vectors), float).mean(0)
    sigma = np.linalg.svd(x, compute_uv=False)
    assert len(w.values) == 3 and w.passes >= 3 and w.identity_error < 1e-4
    assert np.sqrt(w.values * w.n) == pytest.approx(sigma, rel=1e-4)


def test_given_table(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    pairs = [(r.vec_id, r.embedding) for r in rows.collect()]
    check(W.whiten(rows).collect(), [v for _, v in pairs], [i for i, _ in pairs])
