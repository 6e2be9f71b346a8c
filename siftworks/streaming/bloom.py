"""A Bloom filter over the hashtags of a stream, with its error rates after every micro-batch.

All state is Spark's own, by key: the filter as packed pages of bits, and a verdict per tag. Hashtags
go to the pages they hit, which tell whether each bit was set before; the answers of all pages of
a tag meet at the tag; what the tags of a micro-batch count goes to Spark's file sink.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from siftworks.functions.hashing import bit_positions, page_of, place_in_page
from siftworks.functions.text import hashtags
from siftworks.operators.bloom import NUM_HASH, PAGE_BITS, WIDTH, with_rates
from siftworks.streaming.keyed import append_to, summed

# Fixed value of the programs rebuilt here.
INTERVAL = "10 seconds"

COUNTS = "total bigint, fp bigint, tn bigint, batch_id bigint"


def _first_and_count(order: list[str]):
    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each tag of an Arrow batch with its first place and its count, so that a hot tag sends few rows."""
        for frame in frames:
            tags = frame.sort_values(order).groupby("tag", sort=False)
            out = tags[order].head(1).assign(tag=frame["tag"])
            yield out.assign(n=out["tag"].map(tags.size())).reset_index(drop=True)

    return partial


class Pages(StatefulProcessor):
    """One page of the filter per key: tells whether a tag's bit was set by an earlier tag, then sets it."""

    def __init__(self, order: list[str]):
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.bits = handle.getValueState("bits", "bits binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows), ignore_index=True)
        frame["rank"] = frame.groupby(self.order, dropna=False).ngroup()
        hits = frame.groupby(["tag", "place"], as_index=False).agg(rank=("rank", "min"), n=("n", "sum"))
        packed = np.frombuffer(self.bits.get()[0], np.uint8) if self.bits.exists() else np.zeros(PAGE_BITS // 8, np.uint8)
        held = np.unpackbits(packed, bitorder="little")
        place = hits["place"].to_numpy()
        set_at = hits.groupby("place")["rank"].transform("min")
        was_set = (held[place] == 1) | (set_at < hits["rank"]).to_numpy()
        if not held[place].all():
            held[place] = 1
            self.bits.update((np.packbits(held, bitorder="little").tobytes(),))
        yield pd.DataFrame({"tag": hits["tag"], "n": hits["n"], "was_set": was_set})

    def close(self) -> None:
        pass


class Tags(StatefulProcessor):
    """One tag per key: a tag all of whose bits were set at its first occurrence is a false positive from then on."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "is_false_positive boolean, n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows), ignore_index=True)
        n, new = int(frame["n"].iloc[0]), not self.seen.exists()
        wrong, before = (bool(frame["was_set"].all()), 0) if new else self.seen.get()
        self.seen.update((wrong, before + n))
        yield pd.DataFrame({"total": [n], "fp": [n if wrong else 0], "tn": [int(new and not wrong)]})

    def close(self) -> None:
        pass


def bloom_stream(
    stream: DataFrame,
    location: str,
    order_by: list[str],
    width: int = WIDTH,
    num_hash: int = NUM_HASH,
    every: str | None = None,
) -> StreamingQuery:
    """Test and insert the hashtags of ``stream`` (text, order columns); state and report lie under ``location``.

    Within a micro-batch events follow ``order_by``; a late event belongs to
    the batch it arrives in. State is a page of ``PAGE_BITS`` bits for each part of the filter that was
    hit, and one row per tag; a batch touches the pages and tags it names and no others, however long the
    stream has run. Only a page's or a tag's rows of one batch, counted before the shuffle, meet in memory.
    """
    order = [f"order{i}" for i in range(len(order_by))]
    arrived = stream.select(*[F.col(c).alias(o) for c, o in zip(order_by, order)], F.explode(hashtags("text", clean=False)).alias("tag"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in arrived.schema)
    tags = arrived.mapInPandas(_first_and_count(order), f"{kinds}, n long")
    hits = tags.withColumn("_bit", F.explode(bit_positions("tag", width, num_hash)))
    hits = hits.select(page_of("_bit").alias("page"), place_in_page("_bit").alias("place"), "tag", "n", *order)
    answers = hits.groupBy("page").transformWithStateInPandas(Pages(order), "tag string, n long, was_set boolean", "append", "none")
    counts = answers.groupBy("tag").transformWithStateInPandas(Tags(), "total long, fp long, tn long", "append", "none")
    return append_to(summed(counts, "total", "fp", "tn"), location, "counts", every)


def _counts(spark: SparkSession, location: str) -> DataFrame:
    """What each micro-batch added, in a few rows for each."""
    try:
        return spark.read.schema(COUNTS).parquet(f"{location}/counts")
    except Exception as e:  # nothing written yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], COUNTS)


def report_log(spark: SparkSession, location: str) -> DataFrame:
    """The running report: one row per micro-batch that had a hashtag, with the counters up to it."""
    names = ("total", "fp", "tn")
    batches = _counts(spark, location).groupBy("batch_id").agg(*[F.sum(c).alias(c) for c in names])
    # one short row per micro-batch
    so_far = W.orderBy("batch_id").rowsBetween(W.unboundedPreceding, 0)
    return with_rates(batches.select("batch_id", *[F.sum(c).over(so_far).alias(c) for c in names]), "batch_id")


def last_report(spark: SparkSession, location: str) -> DataFrame:
    """(total, correct, incorrect, fp, tn, fpr) after the last micro-batch; zeros before the first."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "fp", "tn")]
    return with_rates(_counts(spark, location).agg(*sums))
