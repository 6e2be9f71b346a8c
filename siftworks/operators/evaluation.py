"""Scored test rows and their error figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The prediction for a row nothing is known about, and the labels of the
# error buckets [0,1), [1,2), [2,3), [3,4) and the rest.
FALLBACK_RATING = 2.5
BUCKETS = [">= 0 and < 1", ">= 1 and < 2", ">= 2 and < 3", ">= 3 and < 4", ">= 4"]


def score(test: DataFrame, predictions: DataFrame, means: DataFrame | None = None) -> DataFrame:
    """Every test row with its prediction, the user's mean or the fallback, in that order.

    ``predictions`` has (user, item, prediction); ``means`` (user, mean) lists the users
    whose mean may stand in for a missing prediction.
    """
    rows = test.select("user", "item", "rating").join(
        predictions.select("user", "item", "prediction"), ["user", "item"], "left"
    )
    if means is not None:
        rows = rows.join(means.select("user", F.col("mean").alias("_mean")), "user", "left")
        prediction = F.coalesce("prediction", "_mean", F.lit(FALLBACK_RATING))
    else:
        prediction = F.coalesce("prediction", F.lit(FALLBACK_RATING))
    return rows.select(
        "user",
        "item",
        "rating",
        prediction.alias("prediction"),
        F.abs(prediction - F.col("rating")).alias("abs_err"),
    )


def error_bucket(err: Column) -> Column:
    """Label of an absolute error; an undefined error falls into the last bucket.

    The error is rounded to 9 places first: sums of doubles in another order
    must not move a row across a whole-number border.
    """
    e = F.round(err, 9)
    label = F.when((e >= 0) & (e < 1), BUCKETS[0])
    for low in (1, 2, 3):
        label = label.when((e >= low) & (e < low + 1), BUCKETS[low])
    return label.otherwise(BUCKETS[4])


def error_histogram(scored: DataFrame) -> DataFrame:
    """(bucket, n) of the non-empty buckets, sorted by label."""
    return (
        scored.groupBy(error_bucket(F.col("abs_err")).alias("bucket"))
        .agg(F.count("*").alias("n"))
        .orderBy("bucket")
    )


def rmse(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count("*").alias("n"), F.sqrt(F.avg(F.col("abs_err") * F.col("abs_err"))).alias("rmse")
    )
