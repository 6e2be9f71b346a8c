"""Hashtag counts and text lengths of a table with a ``text`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftworks.functions.text import hashtags, text_length


def hashtag_counts(texts: DataFrame, clean: bool = True) -> DataFrame:
    """(tag, n)."""
    tags = texts.select(F.explode(hashtags("text", clean)).alias("tag"))
    return tags.groupBy("tag").agg(F.count("*").alias("n"))


def top_hashtags(texts: DataFrame, k: int = 5, clean: bool = True) -> DataFrame:
    """(rank, tag, n): the ``k`` most frequent tags, ascending by tag on a tie."""
    order = [F.col("n").desc(), F.col("tag").asc()]
    top = hashtag_counts(texts, clean).orderBy(*order).limit(k)
    # k rows
    return top.select(F.row_number().over(W.orderBy(*order)).alias("rank"), "tag", "n")


def mean_length(texts: DataFrame, utf16: bool = True) -> DataFrame:
    """(n, mean_length); the length is NULL without any text."""
    return texts.agg(
        F.count("*").alias("n"), F.avg(text_length("text", utf16)).alias("mean_length")
    )
