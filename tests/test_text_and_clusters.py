import hashlib
import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from siftworks.operators import kmeans as K
from siftworks.operators import models as M
from siftworks.operators import text as T
from siftworks.operators.vectors import cosine, euclidean
from siftworks.plans.clustering import bisect, cluster_corpus, cluster_corpus_with, lloyd

ODD = [(1, ""), (2, "   "), (3, " a"), (4, "a  b "), (5, "a b a"), (6, None)]


def corpus(spark, data=ODD):
    return spark.createDataFrame(data, "doc_id bigint, text string")


def vectors(spark, data):
    return spark.createDataFrame(data, "doc_id bigint, term string, weight double")


def centroids(spark, data):
    return spark.createDataFrame(data, "cluster int, term string, weight double")


def ids(spark, n):
    return spark.range(n).select(F.col("id").alias("doc_id"))


# --- text ---


def test_tokens_keep_leading_and_inner_blanks_and_drop_trailing_ones(spark):
    assert rows(T.term_counts(corpus(spark))) == [
        (1, "", 1), (3, "", 1), (3, "a", 1), (4, "", 1), (4, "a", 1), (4, "b", 1), (5, "a", 2), (5, "b", 1),
    ]


def test_term_weights(spark):
    c = corpus(spark)
    tf = {(r.doc_id, r.term): r.tf for r in T.term_frequency(c).collect()}
    assert tf[5, "a"] == pytest.approx(2 / 3) and tf[4, ""] == pytest.approx(1 / 3)
    idf = {r.term: (r.df, r.idf) for r in T.idf(c).collect()}
    # the blank and the missing text count as documents
    assert idf["a"] == (3, pytest.approx(1 + math.log(6 / 3)))
    assert idf["b"] == (2, pytest.approx(1 + math.log(6 / 2)))
    weight = {(r.doc_id, r.term): r.weight for r in T.tfidf(c).collect()}
    assert weight[5, "a"] == pytest.approx(2 / 3 * (1 + math.log(2)))


def test_vocabulary_is_sorted_and_dense(spark):
    words = [f"w{i}" for i in range(500)]
    random.Random(1).shuffle(words)
    c = corpus(spark, [(i, " ".join(words[i::7])) for i in range(7)])
    assert rows(T.vocabulary(c), "idx", "term") == list(enumerate(sorted(words)))


def test_unknown_feature(spark):
    with pytest.raises(ValueError):
        T.features(corpus(spark), "X")


# --- distances ---


def test_distance_and_cosine_with_a_document_without_terms(spark):
    v = vectors(spark, [(0, "x", 3.0), (0, "y", 4.0), (1, "z", 2.0)])
    c = centroids(spark, [(0, "x", 3.0), (0, "y", 4.0), (1, "y", 1.0)])
    got = {(r.doc_id, r.cluster): r.distance for r in euclidean(v, ids(spark, 3), c, 3).collect()}
    assert got[0, 0] == 0.0 and got[2, 0] == 5.0 and got[2, 1] == 1.0
    assert got[1, 1] == pytest.approx(math.sqrt(5)) and got[0, 1] == pytest.approx(math.sqrt(18))
    assert got[0, 2] == 5.0, "a centroid without terms is the zero vector"
    sim = {(r.doc_id, r.cluster): r.similarity for r in cosine(v, ids(spark, 3), c, 3).collect()}
    assert sim[0, 0] == pytest.approx(1.0) and sim[0, 1] == pytest.approx(0.8) and sim[1, 0] == 0.0
    assert sim[2, 0] is None and sim[0, 2] is None


# --- k-means ---

POINTS = [(0, "x", 1.0), (1, "x", 2.0), (2, "x", 9.0), (3, "x", 10.0)]


def test_one_round_measures_the_start(spark):
    start = centroids(spark, [(0, "x", 1.0), (1, "x", 9.0), (2, "x", 100.0)])
    found = lloyd(vectors(spark, POINTS), ids(spark, 4), 3, 1, start=start)
    assert rows(found.assignment, "doc_id", "cluster", "sqdist") == [(0, 0, 0.0), (1, 0, 1.0), (2, 1, 0.0), (3, 1, 1.0)]
    assert rows(K.sse(found.assignment, 3)) == [(0, 2, 1.0), (1, 2, 1.0), (2, 0, 0.0)]
    assert K.wsse(found.assignment).first().wsse == 2.0


def test_a_cluster_nobody_chooses_keeps_its_centroid(spark):
    start = centroids(spark, [(0, "x", 1.0), (1, "x", 9.0), (2, "x", 100.0)])
    found = lloyd(vectors(spark, POINTS), ids(spark, 4), 3, 2, start=start)
    assert rows(found.centroids) == [(0, "x", 1.5), (1, "x", 9.5), (2, "x", 100.0)]
    report = rows(K.cluster_report(vectors(spark, POINTS), found.assignment, 3))
    assert report[2] == (2, 0, 0.0, [])
    assert report[0] == (0, 2, 0.5, ["x"])


def test_equal_distances_go_to_the_lower_cluster(spark):
    start = centroids(spark, [(0, "x", 3.0), (1, "x", 1.0)])
    v = vectors(spark, [(0, "x", 2.0)])
    assert rows(K.assign(v, ids(spark, 1), start, 2), "doc_id", "cluster") == [(0, 0)]


def test_no_rounds_is_an_error(spark):
    with pytest.raises(ValueError):
        lloyd(vectors(spark, POINTS), ids(spark, 4), 2, 0)


def test_centroid_shift(spark):
    old = centroids(spark, [(0, "x", 1.0), (0, "y", 2.0)])
    new = centroids(spark, [(0, "x", 4.0), (0, "z", 0.5)])
    assert rows(K.centroid_shift(old, new)) == [(0, 5.5)]


def dense_lloyd(x, start, iters):
    """Plain k-means with the result before the last update."""
    c = x[start].astype(float)
    for i in range(iters):
        d = np.round(np.sqrt(((x[:, None, :] - c[None]) ** 2).sum(-1)), 9)
        nearest = d.argmin(1)
        if i < iters - 1:
            c = np.array([x[nearest == j].mean(0) if (nearest == j).any() else c[j] for j in range(len(c))])
    return nearest


@pytest.mark.parametrize("feature", ["W", "T"])
def test_rounds_against_dense_arrays(spark, feature):
    rnd = random.Random(2)
    words = "ab cd ef gh ij kl mn op".split()
    data = [(i, " ".join(rnd.choices(words[i % 3 * 2 :], k=rnd.randint(1, 12)))) for i in range(30)] + [(30, "  ")]
    c = corpus(spark, data)
    vocabulary = {t: i for i, t in enumerate(sorted(words))}
    x = np.zeros((31, len(words)))
    for r in T.features(c, feature).collect():
        x[r.doc_id, vocabulary[r.term]] = r.weight
    start = [r[1] for r in rows(K.choose_start(c, 4, 42))]
    previous = math.inf
    for iters in (1, 2, 4):
        found = cluster_corpus(c, feature, 4, iters)
        assert [r[1] for r in rows(found.assignment, "doc_id", "cluster")] == list(dense_lloyd(x, start, iters))
        wsse = K.wsse(found.assignment).first().wsse
        assert wsse <= previous + 1e-6
        previous = wsse


def test_cluster_terms_are_the_most_common(spark):
    v = vectors(spark, [(d, t, 1.0) for d in range(4) for t in "abcdefghijklm"[: 13 - d]])
    members = spark.createDataFrame([(d, 0) for d in range(4)], "doc_id bigint, cluster int")
    got = rows(K.cluster_terms(v, members), "rank", "term", "n_docs")
    assert [t for _, t, _ in got] == list("abcdefghij") and got[0][2] == 4


# --- Spark ML ---


def blobs(spark):
    rnd = random.Random(0)
    data = [
        (i, [rnd.gauss(10 * (i % 3), 0.3), rnd.gauss(-5 * (i % 3), 0.3)])
        for i in range(90)
    ]
    return spark.createDataFrame(data, "vec_id bigint, embedding array<double>")


@pytest.mark.parametrize("fit", [M.kmeans_model, M.bisecting_model])
def test_blobs_are_found_and_the_cost_is_that_of_the_final_centres(spark, fit):
    f = M.dense_features(blobs(spark), "vec_id", "embedding")
    model = fit(f, 3, 20, 7) if fit is M.bisecting_model else best_of(fit, f)
    members = M.member_distances(model, f, "vec_id").collect()
    groups = {}
    for r in members:
        groups.setdefault(r.vec_id % 3, set()).add(r.cluster)
    assert all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == 3
    points = {r.vec_id: r.features.toArray() for r in f.collect()}
    centers = model.clusterCenters()
    for r in members:
        assert r.sqdist == pytest.approx(((points[r.vec_id] - centers[r.cluster]) ** 2).sum())


def best_of(fit, f):
    # a random start may leave a blob without a centre
    return min((fit(f, 3, 20, seed) for seed in range(6)), key=lambda m: m.summary.trainingCost)


def test_text_clusters_have_the_distances_of_dense_vectors(spark):
    data = [(i, ("sun moon star " if i % 2 else "fish salt sea ") * (1 + i % 3) + f"n{i}") for i in range(12)]
    data.append((12, "  "))
    for algorithm in "KB":
        found = cluster_corpus_with(corpus(spark, data), algorithm, 2, 10)
        x, c = {}, {}
        for r in found.vectors.collect():
            x.setdefault(r.doc_id, {})[r.term] = r.weight
        for r in found.centroids.collect():
            c.setdefault(r.cluster, {})[r.term] = r.weight
        members = found.assignment.collect()
        assert len(members) == 13
        for r in members:
            a, b = x.get(r.doc_id, {}), c.get(r.cluster, {})
            expected = sum((a.get(t, 0) - b.get(t, 0)) ** 2 for t in a.keys() | b.keys())
            assert r.sqdist == pytest.approx(expected, abs=1e-9)


def dense_bisect(x, k, iters, seed=42):
    """Plain bisecting k-means: the leaf of every row."""
    order = sorted(range(len(x)), key=lambda d: (hashlib.md5(f"{seed}-{d}".encode()).hexdigest(), d))
    leaf, whole, n = np.zeros(len(x), int), set(), 1
    while n < k:
        sizes = {i: (leaf == i).sum() for i in set(leaf) - whole if (leaf == i).sum() > 1}
        chosen = sorted(sizes, key=lambda i: (-sizes[i], i))[: k - n]
        if not chosen:
            break
        for i in sorted(chosen):
            own = [d for d in order if leaf[d] == i]
            half = dense_lloyd(x[own], [0, 1], iters + 1)
            if 0 < half.sum() < len(own):
                leaf[[d for d, h in zip(own, half) if h]] = n
                n += 1
            else:
                whole.add(i)
    return leaf


@pytest.mark.parametrize("k,iters", [(1, 3), (5, 4), (40, 1)])
def test_bisecting_against_dense_arrays(spark, k, iters):
    rnd = random.Random(k)
    # equal rows form leaves that cannot be cut; row 24 is the zero vector
    x = np.array([[rnd.randint(0, 9), rnd.randint(0, 9)] for _ in range(16)] + [[3, 3]] * 5 + [[8, 1]] * 3 + [[0, 0]])
    v = vectors(spark, [(d, "xy"[j], float(x[d, j])) for d in range(25) for j in (0, 1) if x[d, j]])
    found = bisect(v, ids(spark, 25), k, iters)
    expected = dense_bisect(x.astype(float), k, iters)
    got = rows(found.assignment, "doc_id", "cluster", "sqdist")
    assert [c for _, c, _ in got] == list(expected)
    for d, c, square in got:
        assert square == pytest.approx(((x[d] - x[expected == c].mean(0)) ** 2).sum(), abs=1e-8)


def test_no_documents_to_cut(spark):
    assert bisect(vectors(spark, []), ids(spark, 0), 3, 2).assignment.count() == 0


def test_rounds_after_the_last_change_are_left_out(spark):
    start = centroids(spark, [(0, "x", 1.0), (1, "x", 9.0)])
    few, many = (lloyd(vectors(spark, POINTS), ids(spark, 4), 2, n, start=start) for n in (3, 50))
    assert rows(few.assignment) == rows(many.assignment) and rows(few.centroids) == rows(many.centroids)


def test_unknown_algorithm(spark):
    with pytest.raises(ValueError):
        cluster_corpus_with(corpus(spark), "G", 2, 1)


def test_mixture_weights_sum_to_one(spark):
    f = M.dense_features(blobs(spark), "vec_id", "embedding")
    got = M.gaussian_mixture(f, 3, 20).collect()
    assert sum(r.weight for r in got) == pytest.approx(1.0)
    for r in got:
        cov = np.array(r.covariance)
        assert cov.shape == (2, 2) and np.allclose(cov, cov.T) and len(r["mean"]) == 2


def test_factorisation_beats_the_global_mean(spark):
    rnd = random.Random(1)
    p = [[rnd.uniform(0.5, 1.5) for _ in range(2)] for _ in range(40)]
    q = [[rnd.uniform(0.5, 1.5) for _ in range(2)] for _ in range(30)]
    data = [(f"u{u}", f"i{i}", sum(a * b for a, b in zip(p[u], q[i]))) for u in range(40) for i in range(30)]
    train = [d for d in data if rnd.random() < 0.7]
    test = [d for d in data if d not in train] + [("new", "i1", 3.0), ("u1", "new", 3.0)]
    schema = "user string, item string, rating double"
    got = M.als_cf(spark.createDataFrame(train, schema), spark.createDataFrame(test, schema), reg=0.01).collect()
    assert len(got) == len(test) - 2, "rows unknown to training are dropped"
    mean = sum(d[2] for d in train) / len(train)
    error = sum((r.prediction - r.rating) ** 2 for r in got)
    assert error < 0.5 * sum((mean - r.rating) ** 2 for r in got)
