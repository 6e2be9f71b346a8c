"""Whole programs from files to files: read, run, write, and return the figures to look at."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from siftworks.operators import models
from siftworks.operators.evaluation import error_histogram, rmse
from siftworks.operators.kmeans import cluster_report
from siftworks.plans.clustering import Clustering, cluster_corpus, cluster_corpus_with
from siftworks.plans.mining import chunk_count, son
from siftworks.plans.recommend import item_cf, user_cf
from siftworks.sources import writers
from siftworks.sources.readers import read_baskets, read_corpus, read_ratings
from siftworks.sources.shared import materialize
from siftworks.streaming import bloom, reservoir


class Scores(NamedTuple):
    scored: DataFrame
    histogram: DataFrame
    rmse: DataFrame


def _scores(scored: DataFrame) -> Scores:
    stored = materialize(scored, "scored")
    return Scores(stored, error_histogram(stored), rmse(stored))


def item_based(spark: SparkSession, train: str, test: str, out: str, **options) -> Scores:
    """Item-based predictions for a test file, written to ``out``."""
    found = _scores(item_cf(read_ratings(spark, train), read_ratings(spark, test), **options))
    writers.write_predictions(found.scored, out)
    return found


def user_based(spark: SparkSession, train: str, test: str, out: str, **options) -> Scores:
    """User-based predictions for a test file, written to ``out``."""
    found = _scores(user_cf(read_ratings(spark, train), read_ratings(spark, test), **options))
    writers.write_predictions(found.scored, out)
    return found


def model_based(spark: SparkSession, train: str, test: str, **options) -> Scores:
    """Matrix-factorisation predictions for the test rows known to training."""
    predicted = models.als_cf(read_ratings(spark, train), read_ratings(spark, test), **options)
    return _scores(models.with_error(predicted))


def frequent_itemsets(
    spark: SparkSession, path: str, support: float, out: str, partitions: int | None = None
) -> DataFrame:
    """All itemsets of a basket file in at least ``support`` baskets, in two passes.

    The number of chunks follows from the data and the support, see ``chunk_count``.
    """
    baskets = materialize(read_baskets(spark, path), "baskets")
    found = son(baskets, support, partitions or chunk_count(baskets, support))
    writers.write_itemset_report(found, out)
    return found


def _write_clusters(found: Clustering, k: int, algorithm: str, out: str) -> DataFrame:
    report = materialize(cluster_report(found.vectors, found.assignment, k), "report")
    writers.write_cluster_report(report, algorithm, out)
    return report


def cluster_lines(
    spark: SparkSession, path: str, feature: str, k: int, iters: int, out: str, seed: int = 42
) -> DataFrame:
    """k-means of the lines of a file over word counts (``"W"``) or TF-IDF (``"T"``)."""
    corpus = materialize(read_corpus(spark, path), "corpus")
    return _write_clusters(cluster_corpus(corpus, feature, k, iters, seed), k, "K-Means", out)


def cluster_lines_with(
    spark: SparkSession, path: str, algorithm: str, k: int, iters: int, out: str, seed: int = 42
) -> DataFrame:
    """k-means (``"K"``) or bisecting k-means (``"B"``) of the lines of a file over TF-IDF."""
    corpus = materialize(read_corpus(spark, path), "corpus")
    kind = algorithm.upper()
    found = cluster_corpus_with(corpus, kind, k, iters, seed)
    return _write_clusters(found, k, {"K": "K-Means", "B": "Bisecting K-Means"}[kind], out)


def watch_sample(stream: DataFrame, location: str, every: str = reservoir.INTERVAL, **options) -> StreamingQuery:
    """Sample, top hashtags and mean length of a stream (event_id, text), batch by batch."""
    return reservoir.reservoir_stream(stream, location, every=every, **options)


def watch_hashtags(
    stream: DataFrame, location: str, order_by: list[str], every: str = bloom.INTERVAL, **options
) -> StreamingQuery:
    """Bloom filter over the hashtags of a stream with its running error rates."""
    return bloom.bloom_stream(stream, location, order_by, every=every, **options)
