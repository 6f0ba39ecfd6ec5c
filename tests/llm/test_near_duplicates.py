"""Near-duplicate operators against brute force."""
import random
import re

import numpy as np
import pytest
import xxhash

from quayside.llm import buckets, lattice, simhash
from quayside.llm.common import connected_components


def reachable(nodes, links):
    low = {n: n for n in nodes}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("edges", [
    [], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)], [(5, 3), (3, 5), (7, 7), (9, 3), (20, 21)],
    [(random.Random(1).randint(0, 60), random.Random(i).randint(0, 60)) for i in range(50)]])
def test_components(spark, edges):
    df = spark.createDataFrame(edges + [(None, 4)], "a long, b long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    assert got == reachable(nodes, [e for e in edges if e[0] != e[1]])


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_copies(rng, n, words, changes):
    base = [rng.choice(words) for _ in range(400)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, changes)):
            w[rng.randrange(len(w))] = rng.choice(words)
        out.append(" ".join(w))
    return out


def test_simhash_against_all_pairs(spark):
    rng = random.Random(7)
    words = ["w%d" % i for i in range(500)] + ["É", "Straße", "A\x1cB"]
    texts = near_copies(rng, 25, words, 6) + near_copies(rng, 10, words, 30) + [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(60)]
    texts += ["", None, "  \n", "one", "ONE", "one\ttwo  three", "One Two Three", "x", "x"]
    rows = [(i, t, "s", 1) for i, t in enumerate(texts)] + [(None, "x", "s", 2), (None, "only null id", "s", 3), (3, texts[3], "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, component int").repartition(4)
    fps = [brute_fingerprint(t) for _, t, _, _ in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    of = reachable(range(len(rows)), links)
    lowest = {}
    for k, (i, *_) in enumerate(rows):
        ids = lowest.setdefault(of[k], [])
        if i is not None:
            ids.append(i)
    want = sorted(str((i, f"{fps[k]:016x}", min(lowest[of[k]], default=None))) for k, (i, *_) in enumerate(rows))
    assert sorted(str(tuple(r)) for r in simhash.near_duplicates(df).collect()) == want
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(min(v, default=None)) for v in lowest.values())


def test_long_text_is_hashed_in_parts(monkeypatch):
    text = " ".join(f"t{i % 97} q{i % 31}" for i in range(3000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 100)
    assert simhash.fingerprint(text) == whole == brute_fingerprint(text)


def test_hot_bucket_is_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(buckets, "TILE", 8)
    rng = random.Random(1)
    fps = {0}
    while len(fps) < 120:  # a chain of close fingerprints that share most blocks
        fps.add(rng.choice(sorted(fps)) ^ (1 << rng.randrange(10)))
    fps |= {rng.getrandbits(63) for _ in range(50)}
    df = spark.createDataFrame([(f,) for f in sorted(fps)], "fp long")
    links = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4]
    got = {r.node: r.component for r in connected_components(simhash.links(df)).collect()}
    assert got == reachable({n for e in links for n in e}, links)


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 4, 5])
def test_close_pairs_share_a_key(bits):
    rng = random.Random(bits)
    from itertools import combinations
    edges = [64 * k // simhash.BLOCKS for k in range(simhash.BLOCKS + 1)]
    for _ in range(200):
        flips = rng.sample(range(64), bits)
        touched = {b for b in range(simhash.BLOCKS) for f in flips if edges[b] <= f < edges[b + 1]}
        shared = any(not touched & set(c) for c in combinations(range(simhash.BLOCKS), simhash.BLOCKS - 4))
        assert shared or bits > 4


def planted_vectors(seed, groups=((1, 6), (1, 40), (12, 2)), lone=400, dim=64):
    rng = np.random.default_rng(seed)
    out = [rng.normal(size=dim) for _ in range(lone)]
    for cosine_noise in (0.01, 0.1, 0.28):
        for count, size in groups:
            for _ in range(count):
                base = rng.normal(size=dim)
                base /= np.linalg.norm(base)
                out += [base + cosine_noise / np.sqrt(dim) * rng.normal(size=dim) for _ in range(size)]
    return [v.astype(np.float32) for v in out]


@pytest.mark.parametrize("tile", [512, 16])
def test_vectors_against_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(buckets, "TILE", tile)
    vectors = planted_vectors(3)
    vectors += [vectors[0], vectors[0], vectors[-1], 2 * vectors[5]]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    bad = [None, [], [0.0] * 64, [float("nan")] * 64, [float("inf")] + [1.0] * 63, [None] + [1.0] * 63]
    rows += [(1000 + i, v, 0) for i, v in enumerate(bad)] + [(1000, None, 1), (2000, [1.0, 2.0], 1), (2001, [1.0, 2.1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell int").repartition(3)
    got = lattice.near_duplicates(df).collect()
    assert len(got) == len(rows)
    unit = lattice.units(np.stack(vectors))
    close = unit @ unit.T >= 0.95
    np.fill_diagonal(close, False)
    n_links = {r.vec_id: r.n_links for r in got}
    found = sum(n_links[i] for i in range(len(vectors)))
    assert all(n_links[i] <= close[i].sum() for i in range(len(vectors)))
    assert found >= 0.98 * close.sum()  # recall
    low = reachable(range(len(vectors)), zip(*np.nonzero(close)))
    component = {r.vec_id: r.component_id for r in got}
    assert np.mean([component[i] == low[i] for i in range(len(vectors))]) >= 0.99
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    for r in got:
        if 1000 <= r.vec_id < 2000:
            assert (r.n_links, r.component_id) == (0, r.vec_id)
    assert n_links[2000] == n_links[2001] == 1 and component[2001] == 2000
    assert lattice.near_duplicates(df.limit(0)).collect() == []


def test_e8_decoder_finds_the_nearest_point():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 8)) * 2
    near = lattice.nearest_e8(x)
    assert ((np.rint(2 * near) == 2 * near).all() and (near.sum(1) % 2 == 0).all())
    own = ((x - near) ** 2).sum(1)
    for m in lattice.e8_neighbours():
        assert (own <= ((x - near - m) ** 2).sum(1) + 1e-9).all()
    assert (own <= 1 + 1e-9).all()  # the covering radius
