"""The library's inputs derived from the given tables.

Ratings and baskets come from ``lineitem``, the corpus is ``documents``, the
tagged stream is ``events``. Every view covers its whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.functions.ordering import global_position
from siftworks.sources.shared import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating of 1 to 5 per customer and part: the largest order quantity in tens."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
        .agg(F.max(F.ceil(F.col("l_quantity") / 10)).cast("double").alias("rating"))
    )


def _first_digit(*parts) -> F.Column:
    return F.substring(F.md5(F.concat(*parts).cast("binary")), 1, 1)


def split_ratings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(train, test): each rating goes to exactly one side by a hash of its ids.

    All ratings of about one user in sixteen and of one item in sixteen go to
    the test side, which makes them unknown to training.
    """
    user, item = F.col("user").cast("string"), F.col("item").cast("string")
    in_test = (
        _first_digit(user, F.lit("-"), item).isin("0", "1", "2")
        | (_first_digit(F.lit("user-"), user) == "7")
        | (_first_digit(F.lit("item-"), item) == "3")
    )
    # written once: the plans below read the ratings several times
    rows = materialize(ratings(spark, sf_dir).withColumn("_test", in_test), "ratings")
    return rows.filter(~F.col("_test")).drop("_test"), rows.filter("_test").drop("_test")


def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct brands of each order."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(F.col("l_orderkey").alias("basket"), F.col("p_brand").alias("item"))
        .distinct()
    )


def stored_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The baskets as the table that the mining runs read."""
    return materialize(baskets(spark, sf_dir), "baskets")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def event_tag() -> F.Column:
    return F.concat(
        F.lit("#"), F.col("event_type"), F.regexp_extract(F.col("props"), "[0-9]+", 0)
    )


def tagged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq, event_id, tag): one tag per event, numbered from 1 in (ts, event_id) order."""
    events = table(spark, sf_dir, "events").select("ts", "event_id", event_tag().alias("tag"))
    return global_position(events, ["ts", "event_id"], "seq", 1).select("seq", "event_id", "tag")


def ordered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq, tag): as ``tagged_events``, with (ts, event_id) itself as the order, where no number is asked for."""
    return table(spark, sf_dir, "events").select(F.struct("ts", "event_id").alias("seq"), event_tag().alias("tag"))


def status_text() -> F.Column:
    """A short status text with two hashtags for each event."""
    return F.concat(
        F.lit("u"), F.col("user_id").cast("string"), F.lit(" "), event_tag(), F.lit(" #"), F.col("event_type")
    )


def status_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", status_text().alias("text"))
