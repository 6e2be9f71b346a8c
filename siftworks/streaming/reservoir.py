"""A uniform sample of a stream of texts, reported after every micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siftworks.operators.hashtags import mean_length, top_hashtags
from siftworks.operators.reservoir import reservoir
from siftworks.streaming.state import BatchTables, start

# Fixed values of the programs rebuilt here.
SAMPLE_SIZE = 100
TOP_TAGS = 5
INTERVAL = "15 seconds"

SAMPLE = "event_id bigint, text string"
REPORT = "seen bigint, sample_size bigint, mean_length double, top_tags string"


def reservoir_stream(
    stream: DataFrame,
    location: str,
    k: int = SAMPLE_SIZE,
    seed: int = 42,
    every: str | None = None,
) -> StreamingQuery:
    """Keep a sample of ``k`` rows of ``stream`` (event_id, text) under ``location``.

    The sample is that of ``operators.reservoir`` over everything seen,
    however the stream was cut into micro-batches. ``every`` is the batch
    interval; without it the query works off what is there and stops.
    """
    tables = BatchTables(location)

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # one scan of the batch yields both its size and its sample
        rows = batch.select("event_id", "text").persist()
        old = tables.previous(spark, "sample", SAMPLE, batch_id)
        sample = reservoir(old.unionByName(reservoir(rows, k, seed)), k, seed).persist()
        tables.replace(sample, "sample", batch_id)
        seen = rows.count() + _seen_before(tables, spark, batch_id)
        tables.append(_report(sample, seen), "report", batch_id)
        sample.unpersist()
        rows.unpersist()

    return start(stream.writeStream.foreachBatch(step), tables, every)


def _seen_before(tables: BatchTables, spark: SparkSession, batch_id: int) -> int:
    rows = tables.added(spark, "report", REPORT, batch_id - 1)
    return rows.agg(F.coalesce(F.max("seen"), F.lit(0))).first()[0]


def _report(sample: DataFrame, seen: int) -> DataFrame:
    """One row: texts seen so far, and mean length and top hashtags of the sample."""
    # at most TOP_TAGS rows
    tags = top_hashtags(sample, TOP_TAGS).agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("rank", "tag")))["tag"], ",").alias("top_tags")
    )
    return mean_length(sample).select(
        F.lit(seen).cast("bigint").alias("seen"),
        F.col("n").alias("sample_size"),
        "mean_length",
        tags.scalar().alias("top_tags"),
    )


def current_sample(spark: SparkSession, location: str) -> DataFrame:
    """(event_id, text) after the last micro-batch."""
    return BatchTables(location).current(spark, "sample", SAMPLE)


def report_log(spark: SparkSession, location: str) -> DataFrame:
    return BatchTables(location).log(spark, REPORT)
