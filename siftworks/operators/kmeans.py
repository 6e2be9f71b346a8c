"""The steps of Lloyd's k-means over sparse vectors (doc_id, term, weight), or packed ones (``operators.packed``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftworks.functions.hashing import priority
from siftworks.operators import packed
from siftworks.operators.packed import Centres, Packed
from siftworks.operators.vectors import nearest


def choose_start(docs: DataFrame, k: int, seed: int) -> DataFrame:
    """(cluster, doc_id): ``k`` documents in the order of a seeded hash."""
    by = [F.col("_p"), F.col("doc_id")]
    first = docs.select("doc_id", priority(seed, "doc_id").alias("_p")).orderBy(*by).limit(k)
    # k rows
    return first.select((F.row_number().over(W.orderBy(*by)) - 1).alias("cluster"), "doc_id")


def init_centroids(vectors: DataFrame | Packed, docs: DataFrame, k: int, seed: int) -> DataFrame | Centres:
    """(cluster, term, weight): the vectors of the chosen documents."""
    return _vectors_of(vectors, choose_start(docs, k, seed))


def _vectors_of(vectors: DataFrame | Packed, start: DataFrame) -> DataFrame | Centres:
    """(cluster, term, weight): the vectors of a few documents (cluster, doc_id)."""
    if isinstance(vectors, Packed):
        return packed.of_documents(vectors, start)
    return vectors.join(F.broadcast(start), "doc_id").select("cluster", "term", "weight")


def init_halves(vectors: DataFrame | Packed, docs: DataFrame, seed: int) -> DataFrame | Centres:
    """(cluster, term, weight): clusters 2 * leaf and 2 * leaf + 1 are the first two documents of each leaf.

    ``docs`` is (doc_id, leaf).
    """
    first = W.partitionBy("leaf").orderBy("_p", "doc_id")
    start = (
        docs.withColumn("_p", priority(seed, "doc_id"))
        .withColumn("_place", F.row_number().over(first))
        .filter(F.col("_place") <= 2)
        .select("doc_id", (2 * F.col("leaf") + F.col("_place") - 1).alias("cluster"))
    )
    # two rows per leaf
    return _vectors_of(vectors, start)


def assign(vectors: DataFrame | Packed, docs: DataFrame, centroids: DataFrame | Centres, k: int) -> DataFrame:
    """(doc_id, cluster, distance, sqdist): the nearest centroid, the lower id on a tie."""
    return nearest(vectors, docs, centroids, k)


def update_centroids(
    vectors: DataFrame | Packed, assignment: DataFrame, old: DataFrame | Centres
) -> DataFrame | Centres:
    """(cluster, term, weight): the mean of the members; a cluster without members stays."""
    if isinstance(vectors, Packed):
        return packed.means(vectors, assignment, old)
    sizes = assignment.groupBy("cluster").agg(F.count("*").alias("_size"))
    means = (
        vectors.join(assignment.select("doc_id", "cluster"), "doc_id")
        .groupBy("cluster", "term")
        .agg(F.sum("weight").alias("_sum"))
        # at most one row per cluster
        .join(F.broadcast(sizes), "cluster")
        .select("cluster", "term", (F.col("_sum") / F.col("_size")).alias("weight"))
    )
    kept = old.join(F.broadcast(sizes), "cluster", "left_anti")
    return means.unionByName(kept.select("cluster", "term", "weight"))


def sse(assignment: DataFrame, k: int) -> DataFrame:
    """(cluster, size, error): members and summed squared distance of every cluster 0..k-1."""
    found = assignment.groupBy("cluster").agg(
        F.count("*").alias("size"), F.sum("sqdist").alias("error")
    )
    return (
        _clusters(assignment, k)
        .join(found, "cluster", "left")
        .select("cluster", F.coalesce("size", F.lit(0)).alias("size"), F.coalesce("error", F.lit(0.0)).alias("error"))
    )


def wsse(assignment: DataFrame) -> DataFrame:
    """(n, wsse): the total within-cluster error."""
    return assignment.agg(F.count("*").alias("n"), F.coalesce(F.sum("sqdist"), F.lit(0.0)).alias("wsse"))


def cluster_sizes(assignment: DataFrame, k: int) -> DataFrame:
    return sse(assignment, k).select("cluster", "size")


def centroid_shift(old: DataFrame, new: DataFrame) -> DataFrame:
    """(cluster, l1): how far each centroid moved."""
    both = old.select("cluster", "term", (-F.col("weight")).alias("w")).unionByName(
        new.select("cluster", "term", F.col("weight").alias("w"))
    )
    moved = both.groupBy("cluster", "term").agg(F.abs(F.sum("w")).alias("_d"))
    return moved.groupBy("cluster").agg(F.sum("_d").alias("l1"))


def _clusters(df: DataFrame, k: int) -> DataFrame:
    return df.sparkSession.range(k).select(F.col("id").cast("int").alias("cluster"))


def cluster_terms(vectors: DataFrame, assignment: DataFrame, top: int = 10) -> DataFrame:
    """(cluster, rank, term, n_docs): the terms found in most documents of each cluster.

    Every entry of the sparse vectors is a term its document contains.
    """
    counts = (
        vectors.select("doc_id", "term")
        .join(assignment.select("doc_id", "cluster"), "doc_id")
        .groupBy("cluster", "term")
        .agg(F.count("*").alias("n_docs"))
    )
    by_count = W.partitionBy("cluster").orderBy(F.col("n_docs").desc(), F.col("term").asc())
    return (
        counts.withColumn("rank", F.row_number().over(by_count))
        .filter(F.col("rank") <= top)
        .select("cluster", "rank", "term", "n_docs")
    )


def cluster_report(vectors: DataFrame, assignment: DataFrame, k: int, top: int = 10) -> DataFrame:
    """(cluster, size, error, terms): one row per cluster, empty clusters included."""
    terms = cluster_terms(vectors, assignment, top).groupBy("cluster").agg(
        # at most ``top`` entries
        F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("_t")
    )
    none = F.array().cast("array<string>")
    return (
        sse(assignment, k)
        .join(F.broadcast(terms), "cluster", "left")
        .select("cluster", "size", "error", F.coalesce(F.col("_t.term"), none).alias("terms"))
    )
