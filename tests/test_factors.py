import hashlib
import math
import random

import numpy as np
import pytest

from conftest import rows
from siftworks.operators import factors, projection
from siftworks.plans.clustering import mixture_of_corpus

RATED = "user long, item long, rating double"
FACTORS = "item long, factors array<double>"


def some_ratings(users, items, share, seed):
    rnd = random.Random(seed)
    return [(u, i, float(rnd.randint(1, 5))) for u in range(users) for i in range(items) if rnd.random() < share]


@pytest.mark.parametrize("rank", [1, 3, 6])
def test_half_step_against_numpy(spark, rank):
    data = some_ratings(30, 20, 0.4, rank)
    rnd = random.Random(rank)
    known = {i: [rnd.gauss(0, 1) for _ in range(rank)] for i in range(18)}  # two items without factors
    got = factors.half_step(
        spark.createDataFrame(data, RATED), spark.createDataFrame(list(known.items()), FACTORS), "user", "item", rank, reg=0.2
    )
    want = {}
    for u in {u for u, i, _ in data if i in known}:
        mine = [(known[i], r) for v, i, r in data if v == u and i in known]
        v, r = np.array([m[0] for m in mine]), np.array([m[1] for m in mine])
        want[u] = np.linalg.solve(v.T @ v + 0.2 * len(mine) * np.eye(rank), v.T @ r)
    found = {x.user: x for x in got.collect()}
    assert found.keys() == want.keys()
    for u, x in found.items():
        assert np.allclose(x.factors, want[u], atol=1e-9)


def test_a_system_without_a_solution_is_null(spark):
    one = spark.createDataFrame([(1, 1, 3.0)], RATED)
    flat = spark.createDataFrame([(1, [1.0, 2.0])], FACTORS)
    assert rows(factors.half_step(one, flat, "user", "item", 2, reg=0.0), "user", "n")[0] == (1, 1)
    assert factors.half_step(one, flat, "user", "item", 2, reg=0.0).first().factors == [None, None]
    assert factors.half_step(one.limit(0), flat, "user", "item", 2).count() == 0


def test_residuals_tell_a_solution_from_other_factors(spark):
    data = spark.createDataFrame(some_ratings(20, 10, 0.6, 5), RATED)
    items = factors.hashed_start(data, "item")
    users = factors.half_step(data, items, "user", "item").select("user", "factors")
    assert max(r.residual for r in factors.residuals(data, users, items).collect()) < 1e-12
    moved = users.selectExpr("user", "transform(factors, x -> x * 1.01D) AS factors")
    assert min(r.residual for r in factors.residuals(data, moved, items).collect()) > 0.005


def test_a_hot_item_is_combined_before_the_shuffle(spark):
    data = spark.createDataFrame(some_ratings(20, 10, 0.6, 5), RATED)
    plan = factors.half_step(data, factors.hashed_start(data, "item"), "user", "item")._jdf.queryExecution().toString()
    assert "partial_sum" in plan and "Python" not in plan


def sign(term, d):
    digest = hashlib.md5(f"42-{d // 32}-{term}".encode()).hexdigest()
    return 1 if digest[d % 32] >= "8" else -1


@pytest.mark.parametrize("width", [1, 16, 70])
def test_projection_against_a_loop(spark, width):
    entries = [(1, "a", 2.0), (1, "b", -1.0), (2, "b", 0.5), (2, "é", 1.0), (2, "", 4.0)]
    vecs = spark.createDataFrame(entries, "doc_id long, term string, weight double")
    docs = spark.createDataFrame([(1,), (2,), (3,)], "doc_id long")
    got = {r.doc_id: r.projection for r in projection.project(vecs, docs, width).collect()}
    for doc in (1, 2, 3):
        want = [sum(w * sign(t, d) for i, t, w in entries if i == doc) / math.sqrt(width) for d in range(width)]
        assert np.allclose(got[doc], want)


def test_projection_keeps_distances_in_the_mean(spark):
    rnd = random.Random(3)
    entries = [(d, f"t{t}", rnd.random()) for d in range(12) for t in rnd.sample(range(400), 40)]
    vecs = spark.createDataFrame(entries, "doc_id long, term string, weight double")
    got = {r.doc_id: np.array(r.projection) for r in projection.project(vecs, vecs.select("doc_id").distinct(), 512).collect()}
    full = {d: np.zeros(400) for d in range(12)}
    for d, t, w in entries:
        full[d][int(t[1:])] = w
    ratios = [
        np.sum((got[a] - got[b]) ** 2) / np.sum((full[a] - full[b]) ** 2) for a in range(12) for b in range(a)
    ]
    assert 0.9 < np.mean(ratios) < 1.1 and min(ratios) > 0.6


def test_mixture_of_a_corpus(spark):
    rnd = random.Random(1)
    words = ["north south east west", "red green blue black"]
    texts = [(i, " ".join(rnd.choice(words[i % 2].split()) for _ in range(12))) for i in range(60)]
    found = mixture_of_corpus(spark.createDataFrame(texts, "doc_id long, text string"), 2, 10, width=4).collect()
    assert sorted(round(r.weight, 1) for r in found) == [0.5, 0.5]
