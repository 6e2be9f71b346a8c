"""A Bloom filter over a sequence of tags, and how often it errs.

Each tag is tested and then inserted. Nothing sequential is needed: a bit is set
by the first tag that hits it, so a tag is taken for seen at its first occurrence
exactly if all its bits were first hit by earlier tags. A tag wrongly taken
for seen is never stored, so each of its occurrences counts as false positive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.functions.hashing import bit_positions, page_of, place_in_page
from siftworks.functions.skew import broadcast_if_small

# Fixed values of the programs rebuilt here. There all hash seeds coincide, which makes
# the filter one with a single hash; ``num_hash=1`` gives that behaviour.
WIDTH = 1_000_000
NUM_HASH = 6

# Fixed value: the bits of a page, as Spark's bitmap functions cut them.
PAGE_BITS = 32_768


def bloom_flags(events: DataFrame, width: int = WIDTH, num_hash: int = NUM_HASH) -> DataFrame:
    """(tag, first_seq, n, is_false_positive) for events (seq, tag).

    ``seq`` gives the order of the events: a number, or a struct of columns.
    """
    tags = events.groupBy("tag").agg(F.min("seq").alias("first_seq"), F.count("*").alias("n"))
    hits = tags.select("tag", "first_seq", "n", F.explode(bit_positions("tag", width, num_hash)).alias("bit"))
    # never more rows than the filter has bits
    first_hits = hits.groupBy("bit").agg(F.min("first_seq").alias("_set_at"))
    return (
        hits.join(broadcast_if_small(first_hits, width), "bit")
        .groupBy("tag", "first_seq", "n")
        .agg((F.max("_set_at") < F.col("first_seq")).alias("is_false_positive"))
    )


def bloom_quality(flags: DataFrame) -> DataFrame:
    """(total, correct, incorrect, fp, tn, fpr) from the flags of each tag."""
    wrong = F.col("is_false_positive")
    zero = F.lit(0)
    sums = flags.agg(
        F.coalesce(F.sum("n"), zero).alias("total"),
        F.coalesce(F.sum(F.when(wrong, F.col("n"))), zero).alias("fp"),
        F.count(F.when(~wrong, 1)).alias("tn"),
    )
    return with_rates(sums)


def with_rates(sums: DataFrame, *keep: str) -> DataFrame:
    """The report columns from the counters (total, fp, tn), after the columns to keep."""
    return sums.select(
        *keep,
        "total",
        (F.col("total") - F.col("fp")).alias("correct"),
        F.col("fp").alias("incorrect"),
        "fp",
        "tn",
        F.coalesce(F.try_divide(F.col("fp"), F.col("fp") + F.col("tn")), F.lit(0.0)).alias("fpr"),
    )


def bit_pages(tags: DataFrame, width: int = WIDTH, num_hash: int = NUM_HASH) -> DataFrame:
    """(page, bits): the filter that holds all of ``tags`` (tag), as packed pages of ``PAGE_BITS`` bits.

    Pages without a set bit have no row, and a page has at most 4 KB however many tags hit it: bits
    are put together before the shuffle as well as after it.
    """
    bits = tags.select(F.explode(bit_positions("tag", width, num_hash)).alias("bit"))
    return bits.groupBy(page_of("bit").alias("page")).agg(F.bitmap_construct_agg(place_in_page("bit")).alias("bits"))


def merge_pages(*filters: DataFrame) -> DataFrame:
    """The filter that holds what any of several filters of one width and number of hashes holds."""
    both = filters[0]
    for other in filters[1:]:
        both = both.unionByName(other)
    return both.groupBy("page").agg(F.bitmap_or_agg("bits").alias("bits"))


def maybe_seen(tags: DataFrame, pages: DataFrame, width: int = WIDTH, num_hash: int = NUM_HASH) -> DataFrame:
    """(tag, maybe_seen) for the distinct ``tags``: whether the filter holds all bits of the tag.

    ``pages`` is a stored table, so that Spark broadcasts it by its size or else splits hot pages.
    """
    distinct = tags.select("tag").distinct()
    bits = distinct.select("tag", F.explode(bit_positions("tag", width, num_hash)).alias("bit"))
    asked = bits.select("tag", page_of("bit").alias("page"), place_in_page("bit").alias("place"))
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(byte.bitwiseAND(F.expr("shiftleft(1, CAST(place % 8 AS int))")) != 0, F.lit(False))
    # the byte is read where the rows meet: no page is moved with a row
    met = asked.join(pages, "page", "left").select("tag", is_set.alias("is_set"))
    return met.groupBy("tag").agg(F.bool_and("is_set").alias("maybe_seen"))
