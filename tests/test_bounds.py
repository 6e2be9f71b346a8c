import numpy as np
import pytest
from conftest import rows

from siftworks.operators.bounds import carried, centroid_moves, measured
from siftworks.plans.clustering import lloyd


def sparse(spark, x):
    data = [(i, f"t{j}", float(v)) for i, row in enumerate(x) for j, v in enumerate(row) if v]
    return spark.createDataFrame(data, "doc_id int, term string, weight double")


def ids(spark, n):
    return spark.range(n).selectExpr("int(id) AS doc_id")


def centres(spark, c):
    data = [(j, f"t{i}", float(v)) for j, row in enumerate(c) for i, v in enumerate(row) if v]
    return spark.createDataFrame(data, "cluster int, term string, weight double")


def dense_rounds(x, c, iters):
    """Plain k-means: the assignment, its squared distances and its centroids before the last update."""
    for i in range(iters):
        square = ((x[:, None, :] - c[None]) ** 2).sum(-1)
        nearest = np.round(np.sqrt(np.round(square, 9)), 9).argmin(1)
        if i < iters - 1:
            c = np.array([x[nearest == j].mean(0) if (nearest == j).any() else c[j] for j in range(len(c))])
    return nearest, square[np.arange(len(x)), nearest], c


def blobs(n, seed, spread):
    rng = np.random.default_rng(seed)
    own = rng.integers(0, 5, n)
    x = np.abs(rng.normal(size=(n, 8)) * spread + np.eye(8)[own] * 20)
    x[n // 2 :: 7] = x[0]  # copies
    return np.round(x, 2)


@pytest.mark.parametrize("seed,spread,iters", [(1, 1.0, 12), (2, 6.0, 2), (2, 6.0, 5)])
def test_rounds_with_bounds_give_what_all_distances_give(spark, seed, spread, iters):
    x = blobs(150, seed, spread)
    start = x[[0, 1, 2, 3, 4, 5]]
    found = lloyd(sparse(spark, x), ids(spark, len(x)), 6, iters, start=centres(spark, start))
    nearest, square, c = dense_rounds(x, start, iters)
    got = rows(found.assignment, "doc_id", "cluster", "sqdist", "distance")
    assert [r[1] for r in got] == list(nearest)
    assert [r[2] for r in got] == pytest.approx(list(square), abs=1e-7)
    assert [r[3] ** 2 for r in got] == pytest.approx(list(square), abs=1e-7)
    mine = np.zeros_like(c)
    for r in found.centroids.collect():
        mine[r.cluster, int(r.term[1:])] = r.weight
    assert mine == pytest.approx(c)


def test_late_rounds_touch_few_documents(spark):
    x = blobs(400, 3, 3.0)
    found = lloyd(sparse(spark, x), ids(spark, 400), 5, 30, start=centres(spark, x[[1, 2, 4, 6, 8]]))
    assert found.met[0] == 400 and len(found.met) == 6
    assert max(found.met[-3:]) <= 40


def test_one_cluster_has_no_other(spark):
    x = blobs(40, 4, 1.0)
    found = lloyd(sparse(spark, x), ids(spark, 40), 1, 9, start=centres(spark, x[:1]))
    assert found.met == (40, 40)
    got = [r[0] for r in rows(found.assignment, "sqdist")]
    assert got == pytest.approx(sorted(((x - x.mean(0)) ** 2).sum(1)))


def test_documents_without_terms_and_equal_centroids(spark):
    x = np.array([[0.0, 0], [0, 0], [3, 0], [3, 0], [0, 4]])
    start = np.array([[3.0, 0], [3, 0], [0, 4]])
    found = lloyd(sparse(spark, x), ids(spark, 5), 3, 6, start=centres(spark, start))
    assert [r[0] for r in rows(found.assignment, "cluster", "doc_id")] == sorted(dense_rounds(x, start, 6)[0])


def test_no_documents(spark):
    none = lloyd(sparse(spark, np.zeros((0, 2))), ids(spark, 0), 2, 4)
    assert none.assignment.count() == 0 and none.met[0] == 0


def test_moves_of_centroids(spark):
    old, new = centres(spark, [[1, 0], [0, 2], [0, 0]]), centres(spark, [[4, 4], [0, 2], [0, 1]])
    assert rows(centroid_moves(old, new, 4)) == [
        (0, 5.0, 1.0, 32.0),
        (1, 0.0, 5.0, 32.0),
        (2, 1.0, 5.0, 32.0),
        (3, 0.0, 5.0, 32.0),
    ]


def test_bounds_hold_after_any_move(spark):
    rng = np.random.default_rng(8)
    x, c = blobs(120, 5, 3.0), blobs(6, 6, 3.0)
    state = measured(sparse(spark, x), ids(spark, 120), centres(spark, c), 6)
    for step in (0.0, 0.5, 4.0):
        c2 = c + rng.normal(size=c.shape) * step
        far = np.sqrt(((x[:, None, :] - c2[None]) ** 2).sum(-1))
        moved = carried(state, centroid_moves(centres(spark, c), centres(spark, c2), 6))
        for r in moved.collect():
            own, others = far[r.doc_id, r.cluster], np.delete(far[r.doc_id], r.cluster)
            assert r.upper >= own and r.lower <= others.min()
            assert r.open or own < others.min()
