"""Rounds over packed vectors, with terms that have numbers and terms that have none."""

import random

import numpy as np
import pytest
from conftest import rows

from siftworks.operators import kmeans as K
from siftworks.operators import packed
from siftworks.operators import text as T
from siftworks.plans.clustering import bisect, cluster_corpus, cluster_corpus_with, lloyd


def corpus(spark, n=40):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    # w.. in several texts, one.. in one text each; a text without tokens, one that is NULL and one with the empty token
    data = [(i, " ".join(rnd.choices(words[i % 4 * 6 :], k=rnd.randint(2, 9)) + [f"one{i}"] * (i % 3))) for i in range(n)]
    return spark.createDataFrame([*data, (n, "  "), (n + 1, None), (n + 2, "")], "doc_id long, text string")


@pytest.mark.parametrize("most", [1_000_000, 12, 0])
def test_packed_entries_are_all_entries(spark, monkeypatch, most):
    monkeypatch.setattr(packed, "TERMS", most)
    for feature in "TW":
        vectors, held = T.packed_features(corpus(spark), feature, 5)
        whole = [(d, t, round(w, 12)) for d, t, w in rows(T.features(corpus(spark), feature), "doc_id", "term", "weight")]
        assert [(d, t, round(w, 12)) for d, t, w in rows(vectors, "doc_id", "term", "weight")] == whole
        squares = {}
        for d, _, w in whole:
            squares[d] = squares.get(d, 0) + w * w
        assert {d: n for d, n in rows(held.norms, "doc_id", "norm") if n} == pytest.approx(squares)
        assert (held.rare is None) == (most > 100)


@pytest.mark.parametrize("most", [1_000_000, 12])
def test_terms_without_a_number_change_no_round(spark, monkeypatch, most):
    c = corpus(spark)
    long = T.features(c, "T").localCheckpoint()
    monkeypatch.setattr(packed, "TERMS", most)
    for found, plain in (
        (cluster_corpus(c, "T", 4, 7), lloyd(long, c, 4, 7)),
        (cluster_corpus_with(c, "B", 4, 5), bisect(long, c.select("doc_id"), 4, 5)),
    ):
        assert rows(found.assignment, "doc_id", "cluster") == rows(plain.assignment, "doc_id", "cluster")
        for column in ("sqdist",):
            a, b = (np.array(rows(x.assignment, "doc_id", column)) for x in (found, plain))
            assert a == pytest.approx(b, abs=1e-8)
        mine, theirs = ({(r.cluster, r.term): r.weight for r in x.centroids.collect()} for x in (found, plain))
        assert mine == pytest.approx(theirs)
        assert rows(K.cluster_terms(found.vectors, found.assignment)) == rows(K.cluster_terms(long, plain.assignment))


def test_a_document_that_comes_twice_is_not_packed_as_two(spark):
    c = corpus(spark, 9)
    twice = c.union(c.filter("doc_id < 2"))
    found = cluster_corpus(twice, "T", 3, 3)
    assert found.assignment.count() == 14
    plain = lloyd(T.features(twice, "T"), twice.select("doc_id"), 3, 3)
    assert rows(found.assignment, "doc_id", "cluster") == rows(plain.assignment, "doc_id", "cluster")


def test_texts_are_not_shuffled_to_be_counted(spark):
    """Two shuffles for the vectors, the count per term and the join of terms without a number, none by document."""
    c = corpus(spark)
    terms, _, all_ = packed.numbered(T.idf(c), 5)
    plan = packed.encode(c, terms, True)._jdf.queryExecution().executedPlan().toString()
    assert all_ and "Exchange" not in plan
