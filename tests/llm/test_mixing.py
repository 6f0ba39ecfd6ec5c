"""Mixing against resharing step by step and a walk through each source's documents."""
import hashlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from quayside.llm import mixing
from quayside.llm.ordered import running_sums

SCHEMA = "doc_id long, text string, source string, key string, size int, n string, budget string, target int"


def reshared(source_sizes: dict, weights, epochs: int) -> dict:
    """Targets by giving out the words by weight and sharing what is over anew until none is above its end."""
    names = sorted((s for s in source_sizes if s is not None), key=lambda s: s.encode()) + [s for s in source_sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, free, pool = dict.fromkeys(names, Fraction(0)), set(names), Fraction(sum(source_sizes.values()))
    while pool and free:
        share = pool / sum(weight[s] for s in free)
        for s in free:
            target[s] += share * weight[s]
        pool = Fraction(0)
        for s in names:
            if target[s] > epochs * source_sizes[s]:
                pool += target[s] - epochs * source_sizes[s]
                target[s] = Fraction(epochs * source_sizes[s])
        free = {s for s in free if target[s] < epochs * source_sizes[s]}
    return target


def walked(rows, weights, epochs) -> Counter:
    """(doc_id, source, size, taken) by walking through each source's documents in order, epoch after epoch."""
    of, copies = defaultdict(list), Counter()
    for doc_id, text, source in rows:
        size = len((text or "").split())
        part = copies[doc_id, source, size] // mixing.COPIES
        copies[doc_id, source, size] += 1
        key = hashlib.md5(f"{'' if doc_id is None else doc_id}:{size}:{part}".encode()).hexdigest()
        of[source].append((key, doc_id, size))
    target = reshared({s: sum(d[2] for d in docs) for s, docs in of.items()}, weights, epochs)
    out = Counter()
    for source, docs in of.items():
        docs.sort(key=lambda d: d[0])
        left, taken = int(target[source] + Fraction(1, 2)), [0] * len(docs)
        while left and any(d[2] for d in docs):
            for k, (_, _, size) in enumerate(docs):
                more = min(size, left)
                taken[k] += more
                left -= more
        out.update((doc_id, source, size, t) for (_, doc_id, size), t in zip(docs, taken))
    return out


CASES = {
    "plain": [(k, "w " * (k % 7 + 1), f"s{k % 5}") for k in range(200)],
    "ends": [(k, "w " * 50, "huge") for k in range(100)] + [(1000 + k, "a b", f"tiny{k % 9}") for k in range(40)],
    "nulls": [(None, "a b c", None), (None, None, None), (None, "", "x"), (1, "a\tb\x0bc\n", "x"), (2, " \n", None), (3, "one", "é"), (4, "two words", "z")],
    "repeated": [(7, "a b c", "s")] * 2600 + [(8, "d", "s"), (9, "e f", "t")] + [(10, "g", "t")] * 3,
    "wordless": [(1, None, "a"), (2, "  ", "b"), (2, "", "b")],
    "empty": [],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("weights, epochs", [((1, 2, 3), 3), ((5, 1), 2)])
def test_mix_against_a_walk(spark, name, weights, epochs):
    if weights == (5, 1) and name not in ("ends", "repeated"):
        pytest.skip("other weights are tried where they matter")
    rows = CASES[name]
    docs = spark.createDataFrame([(*r, "k", 5, "n", "b", 1) for r in rows], SCHEMA).repartition(3)
    out = mixing.mix(docs, weights, epochs).collect()
    assert Counter((r.doc_id, r.source, r.size, r.taken) for r in out) == walked(rows, weights, epochs)
    size_of = Counter()
    for r in out:
        size_of[r.source] += r.size
    want = reshared(size_of, weights, epochs)
    for r in out:
        assert r.source_size == size_of[r.source] and r.target == pytest.approx(float(want[r.source]), rel=1e-12)
        assert r.taken <= epochs * r.size


def test_ends_are_reached_in_the_case_of_that_name():
    sizes = {"huge": 5000, **{f"tiny{k}": 10 for k in range(9)}}
    target = reshared(sizes, (1, 2, 3), 3)
    assert all(target[f"tiny{k}"] == 30 for k in range(9)) and sum(target.values()) == sum(sizes.values())


def test_reruns_agree_however_the_input_is_split(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    first = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(7, "text")).collect()
    assert sorted(first) == sorted(again)
    assert sum(r.taken for r in first) == pytest.approx(sum(r.size for r in first), abs=20)


def test_a_hot_value_is_cut_into_ranges(spark):
    rows = spark.range(20000).select(F.when(F.col("id") % 3 == 0, "cold").otherwise("hot").alias("source"), "id")
    plan = running_sums(rows, [F.col("source").asc(), F.col("id").asc()], {"before": F.lit(1)})
    got = plan.orderBy("source", "id").collect()
    assert [r.before for r in got] == list(range(20000))
    ranged = rows.repartitionByRange(8, F.col("source").asc(), F.col("id").asc()).groupBy(F.spark_partition_id()).count().collect()
    assert len(ranged) > 1 and max(r["count"] for r in ranged) < 2 * 20000 // len(ranged)


def test_main_path_is_native(spark):
    plan = mixing.mix(spark.read.parquet(f"{SF_ORACLE}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
