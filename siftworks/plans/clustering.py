"""Whole clustering runs over a corpus or its vectors."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftworks.operators.bounds import carried, centroid_moves, measured
from siftworks.operators.kmeans import init_centroids, init_halves, update_centroids
from siftworks.operators.models import dense_features, gaussian_mixture
from siftworks.operators.packed import Centres, Packed, from_rows, pack
from siftworks.operators.projection import project
from siftworks.operators.text import features, packed_features
from siftworks.operators.vectors import member_distances, nearest_half
from siftworks.sources.shared import materialize, partitions_for


# With a larger part of the documents open, all of them meet the centroids: telling them apart costs more than it spares.
MOST = 0.5


# Entries of packed vectors in the room of a row of a held table: larger parts have fewer partial sums.
PER_ROW = 4


class Clustering(NamedTuple):
    """``centroids`` are those the assignment was made with; ``met`` is how many documents met all centroids, by round."""

    vectors: DataFrame
    assignment: DataFrame
    centres: Callable[[], DataFrame]
    met: tuple[int, ...] = ()

    @property
    def centroids(self) -> DataFrame:
        return self.centres()


def lloyd(
    vectors: DataFrame,
    docs: DataFrame,
    k: int,
    iters: int,
    seed: int = 42,
    start: DataFrame | None = None,
    packed: Packed | None = None,
) -> Clustering:
    """k-means with the result of exactly ``iters`` rounds; rounds that can change nothing more are left out.

    As in the programs rebuilt here the result is the assignment of the last
    round, made before that round's centroid update; one round therefore
    reports the distances to the start documents. ``start`` gives other start
    centroids (cluster, term, weight). ``docs`` has one row per document, ids are not NULL.

    From the third round on only documents whose distance bounds cross (``operators.bounds``) meet the
    centroids (all if these are most), and only clusters that lost or gained a document get a new mean. At the
    end the others meet their own centroid.

    The vectors stay partitioned by document through all rounds, so with
    centroids small enough to broadcast only the partial sums of the centroids are
    shuffled; with larger ones the entries of terms outside ``common_terms`` are, too. Assignment and centroids are written in each round, which bounds the lineage.
    """
    if iters < 1:
        raise ValueError("at least one round is needed")
    if packed is None or start is not None:
        packed = pack(vectors, k)
    partitions = partitions_for(vectors, packed.n_entries() // PER_ROW)
    held = packed.dealt(partitions)
    docs = docs.select("doc_id").repartition(partitions, "doc_id").persist()
    centroids = from_rows(start, held) if start is not None else init_centroids(held, docs, k, seed)
    state = materialize(measured(held, docs, centroids, k), "bounds")
    n = state.count()
    met = [n]
    members = state
    for left in reversed(range(iters - 1)):
        old, centroids = centroids, update_centroids(held, members, centroids)
        # the first move, from single documents to means, is too long for bounds to hold
        n_open, moved = n, None
        if len(met) > 1:
            moved = carried(state, materialize(centroid_moves(old, centroids, k), "moves"))
            n_open = moved.filter("open").count()
        if moved is None or n_open > n * MOST:
            n_open, found = n, measured(held, docs, centroids, k)
        else:
            again = moved.filter("open").select("doc_id")
            found = _taken_over(moved, measured(held.joined(again, "left_semi"), again, centroids, k))
        met.append(n_open)
        before, state = state, materialize(found, "bounds")
        if left == 0:
            break
        was = before.select("doc_id", F.col("cluster").alias("before"))
        changed = state.join(was, "doc_id").filter("before != cluster")
        # at most k rows; the means of all other clusters are what they were
        touched = changed.select(F.explode(F.array("before", "cluster")).alias("cluster")).distinct()
        touched = materialize(touched, "touched")
        if touched.isEmpty():
            break
        members = state.join(F.broadcast(touched), "cluster", "left_semi")
    assignment = _with_distances(held, state, centroids)
    held.unpersist()
    docs.unpersist()
    return Clustering(vectors, assignment, lambda: centroids.frame(packed), tuple(met))


def _taken_over(moved: DataFrame, found: DataFrame) -> DataFrame:
    """The state with the rows of the documents that met the centroids again."""
    closed = moved.filter(~F.col("open")).drop("open")
    return closed.unionByName(found)


def _with_distances(
    held: Packed, state: DataFrame, centroids: Centres
) -> DataFrame:
    """(doc_id, cluster, distance, sqdist): documents that did not meet the last centroids meet their own."""
    known = state.filter("sqdist IS NOT NULL").select("doc_id", "cluster", "sqdist")
    others = state.filter("sqdist IS NULL").select("doc_id", "cluster")
    if not others.isEmpty():
        found = member_distances(held, others, centroids).select("doc_id", "cluster", "sqdist")
        known = materialize(known.unionByName(found), "assignment")
    return known.select("doc_id", "cluster", F.sqrt("sqdist").alias("distance"), "sqdist")


def cluster_corpus(corpus: DataFrame, feature: str, k: int, iters: int, seed: int = 42) -> Clustering:
    """k-means of a corpus (doc_id, text) over word counts (``"W"``) or TF-IDF (``"T"``)."""
    vectors, packed = packed_corpus(corpus, feature, k)
    return lloyd(vectors, corpus.select("doc_id"), k, iters, seed, packed=packed)


def packed_corpus(corpus: DataFrame, feature: str, k: int) -> tuple[DataFrame, Packed]:
    """The vectors of a corpus as rows, and packed for ``k`` centroids."""
    if corpus.groupBy("doc_id").count().filter("count > 1").isEmpty():
        return packed_features(corpus, feature, k)
    # a document that comes twice is one vector: its tokens have to meet
    vectors = materialize(features(corpus, feature), "vectors")
    return vectors, pack(vectors, k)


def cluster_corpus_with(corpus: DataFrame, algorithm: str, k: int, iters: int, seed: int = 42) -> Clustering:
    """k-means (``"K"``) or bisecting k-means (``"B"``) of a corpus over TF-IDF.

    Centroids are updated up to ``iters`` times; the result has the distances to the final ones.
    """
    kind = algorithm.upper()
    if kind not in ("K", "B"):
        raise ValueError("algorithm is 'K' (k-means) or 'B' (bisecting k-means)")
    if kind == "K":
        return cluster_corpus(corpus, "T", k, iters + 1, seed)
    # a level has up to 2 * k centroids
    vectors, packed = packed_corpus(corpus, "T", 2 * k)
    return bisect(vectors, corpus.select("doc_id"), k, iters, seed, packed)


def mixture_of_corpus(corpus: DataFrame, k: int, iters: int, width: int = 16, seed: int = 42) -> DataFrame:
    """Gaussian mixture of a corpus over TF-IDF: (component, weight, mean, covariance).

    Whole texts with all their terms are projected to ``width`` dimensions first, as a covariance over a
    vocabulary fits no machine.
    """
    dense = materialize(project(features(corpus, "T"), corpus, width, seed), "projection")
    return gaussian_mixture(dense_features(dense, "doc_id", "projection"), k, iters, seed)


def bisect(
    vectors: DataFrame, docs: DataFrame, k: int, iters: int, seed: int = 42, packed: Packed | None = None
) -> Clustering:
    """Bisecting k-means: leaves are cut in two, level by level, until there are ``k``.

    A level cuts all leaves at once, or the largest ones (on a tie the lower id) where all would
    give more than ``k``. A cut is two-means with up to ``iters`` updates that starts from the leaf's first two
    documents in the order of a seeded hash. The lower half keeps the leaf's id, the upper
    halves take the next ids in the order of their leaves. A leaf that does not fall
    apart, as one of equal documents, is not cut again, so there may be fewer than ``k``.

    Only tables of at most 2 * k rows describe the leaves; a document meets only the two centroids of its leaf.
    """
    packed = pack(vectors, 2 * k) if packed is None else packed
    partitions = partitions_for(vectors, packed.n_entries() // PER_ROW)
    held = packed.dealt(partitions)
    leaves = materialize(docs.select("doc_id", F.lit(0).alias("leaf")), "leaves")
    whole: DataFrame | None = None
    n = 1
    while n < k:
        sizes = leaves.groupBy("leaf").agg(F.count("*").alias("size")).filter(F.col("size") > 1)
        if whole is not None:
            sizes = sizes.join(F.broadcast(whole), "leaf", "left_anti")
        largest = sizes.orderBy(F.col("size").desc(), "leaf").limit(k - n)
        chosen = F.broadcast(materialize(largest.select("leaf"), "chosen"))
        if chosen.isEmpty():
            break
        halves = _cut(held, leaves.join(chosen, "leaf").select("doc_id", "leaf"), partitions, iters, seed)
        fell_apart = (
            halves.groupBy(F.shiftright("cluster", 1).alias("leaf"))
            .agg(F.count_distinct("cluster").alias("_halves"))
            .filter(F.col("_halves") == 2)
        )
        # at most k rows
        upper = materialize(
            fell_apart.select("leaf", (F.row_number().over(W.orderBy("leaf")) + (n - 1)).alias("_new")), "upper"
        )
        left = chosen.join(F.broadcast(upper), "leaf", "left_anti")
        whole = left if whole is None else whole.unionByName(left)
        moved = (
            halves.filter(F.col("cluster") % 2 == 1)
            .select("doc_id", F.shiftright("cluster", 1).alias("leaf"))
            .join(F.broadcast(upper), "leaf")
            .select("doc_id", "_new")
        )
        new = F.coalesce("_new", "leaf").alias("leaf")
        leaves = materialize(leaves.join(moved, "doc_id", "left").select("doc_id", new), "leaves")
        n += upper.count()
    members = leaves.select("doc_id", F.col("leaf").alias("cluster"))
    none = Centres(np.zeros((1, max(1, held.n_terms))), None)
    centroids = update_centroids(held, members, none)
    assignment = materialize(member_distances(held, members, centroids), "assignment")
    held.unpersist()
    return Clustering(vectors, assignment, lambda: centroids.frame(packed))


def _cut(
    vectors: Packed, docs: DataFrame, partitions: int, iters: int, seed: int
) -> DataFrame:
    """Two-means within each leaf: assignment of (doc_id, leaf) rows to clusters 2 * leaf and 2 * leaf + 1."""
    docs = docs.repartition(partitions, "doc_id").persist()
    own = vectors.joined(docs).persist()
    centroids = init_halves(own, docs, seed)
    assignment = materialize(nearest_half(own, docs, centroids), "halves")
    for _ in range(iters):
        centroids = update_centroids(own, assignment, centroids)
        before, assignment = assignment, materialize(nearest_half(own, docs, centroids), "halves")
        if _settled(before, assignment):
            break
    own.unpersist()
    docs.unpersist()
    return assignment


def _settled(before: DataFrame, after: DataFrame) -> bool:
    """No document has changed its cluster, so that further rounds would give the same again."""
    old = before.select("doc_id", F.col("cluster").alias("_old"))
    return after.join(old, "doc_id").filter(F.col("cluster") != F.col("_old")).isEmpty()
