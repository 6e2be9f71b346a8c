"""Matrix factorisation and the clusterings of Spark ML."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.functions.ordering import global_position
from siftworks.sources.shared import materialize, shared_dir

# Ratings in a block of the matrix factorisation.
ROWS_PER_BLOCK = 1_000_000


# --- recommendation ---


class Fitted(NamedTuple):
    """A factorisation, with the tables that number its users and items."""

    model: ALSModel
    users: DataFrame
    items: DataFrame

    def numbered(self, ratings: DataFrame) -> DataFrame:
        known = ratings.select("user", "item", "rating")
        return known.join(self.users, "user").join(self.items, "item")

    def factors(self, entity: str) -> DataFrame:
        """(entity, factors) of ``"user"`` or ``"item"``."""
        ids, found = (self.users, self.model.userFactors) if entity == "user" else (self.items, self.model.itemFactors)
        found = found.select(F.col("id").alias(f"{entity}_id"), F.col("features").cast("array<double>").alias("factors"))
        return ids.join(found, f"{entity}_id").select(entity, "factors")


def fit_als(
    train: DataFrame,
    rank: int = 3,
    iters: int = 25,
    reg: float = 0.3,
    seed: int = 42,
    blocks: int | None = None,
) -> Fitted:
    """The factors of users and items.

    ALS needs int ids, so users and items are numbered. ``blocks`` is by
    default the number of blocks that hold ``ROWS_PER_BLOCK`` ratings each, ten at least.
    """
    blocks = blocks or max(10, math.ceil(train.count() / ROWS_PER_BLOCK))
    shared_dir(train.sparkSession)  # ALS cuts its own lineage there when a folder is set
    users = materialize(_numbered(train, "user"), "users")
    items = materialize(_numbered(train, "item"), "items")
    als = ALS(
        rank=rank,
        maxIter=iters,
        regParam=reg,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        userCol="user_id",
        itemCol="item_id",
        ratingCol="rating",
        seed=seed,
        coldStartStrategy="drop",
    )
    return Fitted(als.fit(Fitted(None, users, items).numbered(train)), users, items)


def als_cf(
    train: DataFrame,
    test: DataFrame,
    rank: int = 3,
    iters: int = 25,
    reg: float = 0.3,
    seed: int = 42,
    blocks: int | None = None,
) -> DataFrame:
    """Matrix-factorisation prediction: (user, item, rating, prediction).

    Test rows with a user or item unknown to training are dropped.
    """
    fitted = fit_als(train, rank, iters, reg, seed, blocks)
    return fitted.model.transform(fitted.numbered(test)).select(
        "user", "item", "rating", F.col("prediction").cast("double").alias("prediction")
    )


def _numbered(ratings: DataFrame, entity: str) -> DataFrame:
    ids = global_position(ratings.select(entity).distinct(), [entity], "_n")
    return ids.select(entity, F.col("_n").cast("int").alias(f"{entity}_id"))


def with_error(predicted: DataFrame) -> DataFrame:
    """Adds the absolute error, as the histogram and the RMSE expect it."""
    return predicted.withColumn("abs_err", F.abs(F.col("prediction") - F.col("rating")))


# --- clustering of rows with a feature vector ---


def dense_features(df: DataFrame, key: str, array: str) -> DataFrame:
    """(key, features) from an array column."""
    return df.select(key, array_to_vector(F.col(array).cast("array<double>")).alias("features"))


def kmeans_model(features: DataFrame, k: int, iters: int, seed: int = 42):
    return KMeans(k=k, maxIter=iters, seed=seed, initMode="random", predictionCol="cluster").fit(features)


def bisecting_model(features: DataFrame, k: int, iters: int, seed: int = 42):
    return BisectingKMeans(k=k, maxIter=iters, seed=seed, predictionCol="cluster").fit(features)


def member_distances(model, features: DataFrame, key: str) -> DataFrame:
    """(key, cluster, sqdist): squared distance of each row to the final centre of its cluster.

    The cost in the model summary belongs to the round before the last update.
    """
    centers = features.sparkSession.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())],
        "cluster int, center array<double>",
    )
    difference = F.zip_with(vector_to_array("features"), "center", lambda x, c: (x - c) * (x - c))
    return (
        model.transform(features)
        # one row per cluster
        .join(F.broadcast(centers), "cluster")
        .select(key, "cluster", F.aggregate(difference, F.lit(0.0), lambda s, d: s + d).alias("sqdist"))
    )


def gaussian_mixture(features: DataFrame, k: int, iters: int, seed: int = 42) -> DataFrame:
    """(component, weight, mean, covariance), the covariance as an array of rows.

    Each covariance is dense: width^2 numbers. Use it on vectors of moderate width.
    """
    model = GaussianMixture(k=k, maxIter=iters, seed=seed).fit(features)
    # k rows, part of the fitted model
    fitted = model.gaussiansDF.collect()
    rows = [
        (i, float(w), [float(x) for x in g["mean"]], [[float(x) for x in r] for r in g["cov"].toArray()])
        for i, (w, g) in enumerate(zip(model.weights, fitted))
    ]
    return features.sparkSession.createDataFrame(
        rows, "component int, weight double, mean array<double>, covariance array<array<double>>"
    )
