"""Predictions, itemset reports and cluster reports as files, written by all tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.operators.itemsets import itemset_report


def write_predictions(predictions: DataFrame, path: str) -> None:
    """CSV without a header: user, item, prediction, ordered by (user, item) as strings."""
    (
        predictions.select(F.col("user").cast("string"), F.col("item").cast("string"), "prediction")
        .orderBy("user", "item")
        .write.csv(path)
    )


def write_itemset_report(itemsets: DataFrame, path: str, per_line: int = 1000) -> None:
    """Text lines ``(a,b),(a,c)`` in order, with an empty line after each size."""
    report = itemset_report(itemsets, per_line)
    last = report.groupBy("size").agg(F.max("line_no").alias("_last"))
    line = F.when(F.col("line_no") == F.col("_last"), F.concat("line", F.lit("\n"))).otherwise(F.col("line"))
    (
        # one row per itemset size
        report.join(F.broadcast(last), "size")
        .orderBy("size", "line_no")
        .select(line.alias("value"))
        .write.text(path)
    )


def cluster_summary(report: DataFrame, algorithm: str) -> DataFrame:
    """One row (algorithm, WSSE, clusters) from a cluster report (cluster, size, error, terms)."""
    entry = F.struct(F.col("cluster").alias("id"), "size", "error", "terms")
    return report.agg(
        F.lit(algorithm).alias("algorithm"),
        F.sum("error").alias("WSSE"),
        # one entry per cluster
        F.array_sort(F.collect_list(entry)).alias("clusters"),
    )


def write_cluster_report(report: DataFrame, algorithm: str, path: str) -> None:
    cluster_summary(report, algorithm).write.json(path)


def mixture_summary(components: DataFrame) -> DataFrame:
    """One row (algorithm, clusters) from (component, weight, mean, covariance)."""
    entry = F.struct(
        F.col("component").alias("id"), "weight", "mean", F.col("covariance").alias("std")
    )
    return components.agg(
        F.lit("GMM").alias("algorithm"), F.array_sort(F.collect_list(entry)).alias("clusters")
    )


def write_mixture_report(components: DataFrame, path: str) -> None:
    mixture_summary(components).write.json(path)
