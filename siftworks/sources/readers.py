"""Ratings, baskets, corpora and streams from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """(user, item, rating) from CSV with a header; further columns are ignored.

    Lines equal to the header are dropped wherever they stand, as when files
    with headers were concatenated. A rating that is no number fails.
    """
    raw = spark.read.option("header", True).option("quote", "").csv(path)
    names = raw.columns[:3]
    rows = raw.toDF("user", "item", "rating", *[f"_{i}" for i in range(3, len(raw.columns))])
    header = F.struct("user", "item", "rating") == F.struct(*[F.lit(n) for n in names])
    return rows.filter(~header).select("user", "item", F.col("rating").cast("double").alias("rating"))


def read_baskets(spark: SparkSession, path: str) -> DataFrame:
    """Distinct (basket, item) from CSV without a header; further columns are ignored."""
    rows = spark.read.schema("basket string, item string").option("quote", "").csv(path)
    return rows.distinct()


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, text): one document per line of the files, ids unique but not consecutive."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("doc_id"), F.col("value").alias("text"))


def read_stream(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    fmt: str = "parquet",
    max_files: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """A stream of the files arriving in a folder."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)
