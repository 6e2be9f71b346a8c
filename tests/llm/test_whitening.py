from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest

from siftworks.llm import exact_eigen
from siftworks.llm.queries import QUERIES
from siftworks.llm.whitening import Whitening

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=4):
    """By numpy: rows (id, component) -> n, deviation, whitened up to sign, explained."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and isfinite(c) for c in v)]
    d = max((len(v) for _, v in kept), default=0)
    xs = [tuple(floor(256 * np.float64(np.float32(c))) for c in v) + (0,) * (d - len(v)) for _, v in kept]
    fit = np.array(sorted(set(xs)), dtype=np.int64).reshape(-1, d)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / max(n, 1)
    cov = centred.T @ centred / max(n, 1)
    values, vectors = np.linalg.eigh(cov) if d else (np.zeros(0), np.zeros((0, 0)))
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for at, ((i, _), x) in enumerate(zip(kept, xs)):
        deviation = sum((n * a - int(s)) ** 2 for a, s in zip(x, sums))
        for c in range(min(k, d)):
            if values[c] > 1e-9 * max(values[0], 1e-300):
                out[at, i, c + 1] = (n, deviation, (np.array(x) - sums / n) @ vectors[:, c] / np.sqrt(values[c]), values[c] / values.sum())
    return out


def test_query_against_numpy(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = {(i, c): v for (_, i, c), v in brute(rows).items()}
    got = {(r.vec_id, r.component): r for r in QUERIES["op11_whitening"](spark, sf).collect()}
    assert got.keys() == want.keys() and len(got) == 4 * len({i for i, _ in got})
    signs = {}
    for key, r in got.items():
        n, deviation, whitened, explained = want[key]
        assert (r.n, r.deviation) == (n, deviation) and r.identity_error < 1e-9
        assert abs(r.explained - explained) < 1e-9 * explained
        if abs(whitened) > 1e-6:
            signs.setdefault(r.component, np.sign(whitened) * np.sign(r.whitened))
        assert abs(r.whitened - signs.get(r.component, 1) * whitened) < 1e-6


def test_charpoly_and_roots_are_exact(spark):
    rng = np.random.default_rng(1)
    for d, high in ((1, 5), (2, 9), (5, 1000), (9, 10**6)):
        half = [[int(x) for x in row] for row in rng.integers(-high, high, (d, d))]
        matrix = [[sum(a * b for a, b in zip(x, y)) for y in half] for x in half]
        poly = exact_eigen.charpoly(spark, matrix)
        # by Faddeev and Le Verrier, in fractions
        want, m = [Fraction(1)], [[Fraction(0)] * d for _ in range(d)]
        for k in range(1, d + 1):
            m = [[sum(matrix[i][l] * m[l][j] for l in range(d)) + (want[-1] if i == j else 0) for j in range(d)] for i in range(d)]
            want.append(-sum(matrix[i][l] * m[l][i] for i in range(d) for l in range(d)) / k)
        assert poly == [int(x) for x in reversed(want)]
        roots = exact_eigen.largest_roots(poly, 3, sum(matrix[i][i] for i in range(d)))
        close = np.linalg.eigvalsh(np.array(matrix, dtype=float))[::-1][:3]
        assert np.allclose([float(r) for r in roots], close, rtol=1e-9)


def test_repeated_and_zero_roots(spark):
    # eigenvalues 7, 7, 7, 2, 0 in a rotated basis: an integer symmetric matrix of rank 4
    q = np.eye(5, dtype=int) * 5 - 2 * np.ones((5, 5), dtype=int)  # a reflection times 5
    matrix = (q @ np.diag([7, 7, 7, 2, 0]) @ q).tolist()
    poly = exact_eigen.charpoly(spark, matrix)
    roots = exact_eigen.largest_roots(poly, 5, 25 * 23)
    assert [r for r in roots] == [175, 175, 175, 50]
    vectors = np.array([[float(x) for x in v] for v in exact_eigen.null_vectors(matrix, roots)])
    assert np.abs(vectors @ vectors.T - np.eye(4)).max() < 1e-15
    assert np.abs(np.array(matrix) @ vectors.T - vectors.T * np.array([175, 175, 175, 50])).max() < 1e-12


def test_nulls_copies_large_entries_and_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=5)]) for i in range(40)]
    rows += rows[:7] * 3 + [(None, rows[0][1]), (50, None), (51, [1.0, None, 2.0, 3.0, 4.0]), (52, [nan] * 5), (53, [inf, 0.0, 0.0, 0.0, 0.0])]
    rows += [(54, [0.5, 0.25]), (55, []), (56, [3e9, -0.0, -1e9, 0.0, 2e8])]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS whitened", "2 AS _done", "3 AS x", "4 AS n")
    fitted = Whitening(df)
    out = fitted.apply(df)
    want = {(at, str(i), v[1]) for (at, i, _), v in brute(rows).items()}
    assert sorted((str(r.vec_id), int(r.deviation)) for r in out.collect()) == sorted((i, deviation) for _, i, deviation in want)
    # one vector is ten million times longer than the others, which doubles still resolve
    assert fitted.n == 43 and len(fitted.components) == 4 and fitted.identity_error < 1e-6
    assert out.columns == ["vec_id", "embedding", "_done", "x", "n", "deviation", "whitened"]
    assert {(r._done, r.x, r.n) for r in out.collect()} == {(2, 3, 4)}


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])] * 3, [(1, []), (2, None)], [(1, [0.0]), (2, [1.0])]])
def test_few_components(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    fitted = Whitening(df)
    n = 1 if len(set(str(v) for _, v in rows)) == 2 and rows[0][1] else 0
    assert len(fitted.components) == n and (fitted.identity_error is None) == (n == 0)
    assert all(len(r.whitened) == n for r in fitted.apply(df).collect())
