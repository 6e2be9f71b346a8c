import math

import numpy as np
import pytest

from siftworks.llm import topk


def brute(vectors, k, step=20):
    v = [(i, [math.floor(64 * x) for x in e]) for i, e in vectors]
    out = set()
    for n, (q, a) in enumerate(v):
        if q is None or q % step:
            continue
        scores = [(-sum(x * y for x, y in zip(a, b)), i) for m, (i, b) in enumerate(v) if m != n]
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)}
    return out


def run(spark, vectors, k=3, condition="vec_id % 20 = 0", **kw):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    return {tuple(r) for r in topk.top_k(df, condition, k, **kw).collect()}


@pytest.mark.parametrize("spread", [0.0, 2.0])
def test_brute_force_over_many_buckets(spark, spread):
    rng = np.random.default_rng(5)
    e = rng.normal(size=(400, 6)) * np.exp(rng.normal(size=(400, 1)) * spread)
    e[100:160] = e[100]  # ties
    vectors = [(i, [float(np.float32(x)) for x in row]) for i, row in enumerate(e)]
    assert run(spark, vectors, 5, bucket_rows=32, query_rows=7) == brute(vectors, 5)


def test_unusable_vectors_and_few_candidates(spark):
    vectors = [(0, [1.0, 0.5]), (20, [0.5, -0.5]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [])]
    assert run(spark, vectors) == {(0, 1, 20, 1024), (20, 1, 0, 1024)}
    assert run(spark, [(0, [1.0])]) == set()
    assert run(spark, [(1, [1.0])]) == set()


def test_repeated_and_null_ids(spark):
    vectors = [(0, [1.0]), (0, [1.0]), (None, [1.0])]
    got = run(spark, vectors)
    assert got == {(0, 1, 0, 4096), (0, 2, None, 4096)}


def test_large_components_are_exact(spark):
    vectors = [(0, [2.0**24, 1.0]), (1, [2.0**24, 3.0]), (2, [2.0**24, 2.0])]
    assert [r[2] for r in sorted(run(spark, vectors))] == [1, 2]
    huge = [(0, [1e30, 1.0]), (1, [1e30, 3.0]), (2, [-1e30, 2.0])]
    assert {(r[1], r[2], r[3]) for r in run(spark, huge)} == {(1, 1, 2**63 - 1), (2, 2, -(2**63))}


def test_pruning_keeps_all_that_reach_the_threshold():
    rng = np.random.default_rng(6)
    c = rng.normal(size=(500, 4)) * rng.uniform(0.1, 9, size=(500, 1))
    norms = np.linalg.norm(c, axis=1)
    pruned = 0
    for q in rng.normal(size=(60, 4)):
        scores = c @ q
        for t in np.quantile(scores, [0.5, 0.9, 0.99, 1.0]):
            keep = topk.candidates(q, float(np.linalg.norm(q)), c, norms, float(t))
            assert keep[scores >= t].all()
            pruned += (~keep).sum()
    assert pruned


def test_empty_table_and_extra_columns(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, score int, row int")
    assert topk.top_k(df, "vec_id % 20 = 0").count() == 0
