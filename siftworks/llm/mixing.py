"""Mixing sources to target weights: how many words each source gives, and which documents give them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftworks.llm.text import free_names, strip_white, words
from siftworks.sources.shared import materialize

# Documents of a source whose keys fall into one range, on average.
ROWS_PER_RANGE = 512

# Hex digits of the random key that choose the range.
RANGE_DIGITS = 6

WORK = ("_key", "_src", "_range")


def sized(docs: DataFrame, text: str = "text") -> Column:
    """Number of words of a text; 0 for NULL."""
    return F.size(words(strip_white(F.coalesce(F.col(text), F.lit(""))))).cast("bigint")


def random_key(seed: int, doc_id: str = "doc_id", text: str = "text") -> Column:
    """A hash-random hex key of a document, the same in every run."""
    digest = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    parts = F.concat_ws("-", F.lit(str(seed)), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), digest)
    return F.md5(parts.cast("binary"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """(source, source_size) with the target words of each source.

    Sources in code point order, NULL last, take the ``weights`` in turn and share
    the sum of all sizes. No target exceeds ``max_epochs`` times its source; the
    excess is shared among the others by weight until none is above. In order of
    cap by weight this is one pass of running sums: a source is capped if the
    level left for it and all later ones reaches its cap.

    The input has one row per source, so the two ordered windows are small.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")
    )
    by_cap = W.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(W.unboundedPreceding, -1)
    everything = by_cap.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / (
        F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0))
    )
    free = F.col("_cap") / F.col("_w") > F.col("_level")
    # the level at the first source that is not capped holds for all after it; theirs,
    # from which its cap is taken, are lower, so ties in cap by weight do not matter
    last = F.max(F.when(free, F.col("_level"))).over(everything)
    return (
        sizes.withColumn("_w", weight)
        .withColumn("_cap", F.col("source_size") * max_epochs)
        .withColumn("_level", level)
        .withColumn("_last", last)
        .withColumn(
            "target",
            F.when(F.col("_last").isNull(), F.col("_cap").cast("double")).otherwise(
                F.least(F.col("_cap").cast("double"), F.col("_last") * F.col("_w"))
            ),
        )
        .select(*sizes.columns, "target")
    )


def _source_key(source: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))


class Mix:
    """Random order, running word sums and budgets of ``docs``.

    ``sources`` has one stored row per source; ``rows`` one row per document with
    its size, its source's figures and ``taken``.
    """

    def __init__(
        self,
        docs: DataFrame,
        seed: int = 42,
        weights: tuple[int, ...] = (1, 2, 3),
        max_epochs: int = 3,
        doc_id: str = "doc_id",
        text: str = "text",
        source: str = "source",
    ):
        self.keys = [doc_id, text, source]
        self.seed = seed
        keyed = materialize(
            docs.select(
                F.col(doc_id).alias("doc_id"),
                F.col(source).alias("source"),
                sized(docs, text).alias("size"),
                random_key(seed, doc_id, text).alias("_key"),
            ),
            "mix_keys",
        )
        sizes = keyed.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_n"))
        planned = targets(sizes, weights, max_epochs).withColumn("_budget", F.round("target").cast("bigint"))
        empty = F.col("source_size") == 0
        self.sources = materialize(
            planned.withColumns(
                {
                    "_src": _source_key("source"),
                    "epochs": F.when(empty, 0).otherwise(F.expr("_budget div source_size")).cast("bigint"),
                    "remainder": F.when(empty, 0).otherwise(F.expr("_budget % source_size")).cast("bigint"),
                }
            ),
            "mix_sources",
        )
        n = self.sources.agg(F.sum("_n")).first()[0] or 0
        ranges = max(1, min(16**RANGE_DIGITS, n // ROWS_PER_RANGE))
        prefix = F.conv(F.substring("_key", 1, RANGE_DIGITS), 16, 10).cast("bigint")
        ranged = keyed.withColumns(
            {"_src": _source_key("source"), "_range": F.floor(prefix * ranges / 16**RANGE_DIGITS)}
        )
        sums = ranged.groupBy("_src", "_range").agg(F.sum("size").alias("_words"))
        earlier = W.partitionBy("_src").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
        starts = sums.withColumn("_start", F.coalesce(F.sum("_words").over(earlier), F.lit(0))).drop("_words")
        starts = materialize(starts, "mix_ranges")
        inside = W.partitionBy("_src", "_range").orderBy("_key", "doc_id", "size")
        placed = ranged.withColumn(
            "_inside", F.coalesce(F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        )
        left = F.col("remainder") - F.col("_start") - F.col("_inside")
        self.rows = (
            placed.join(starts, ["_src", "_range"])
            .join(self.sources.select("_src", "source_size", "target", "epochs", "remainder"), "_src")
            .withColumn("cut", F.greatest(F.lit(0), F.least(F.col("size"), left)))
            .withColumn("taken", F.col("size") * F.col("epochs") + F.col("cut"))
        )

    def taken(self) -> DataFrame:
        """(doc_id, source, size, source_size, target, taken), one row per document."""
        return self.rows.select("doc_id", "source", "size", "source_size", "target", "taken")

    def repeat(self, docs: DataFrame) -> DataFrame:
        """``docs`` as the mix holds them: each row as many times as its source's budget takes it whole.

        The document at which a source's budget ends is whole if at least half of
        it fits, else left out: texts are never cut. The border is one key per
        source, so the texts are compared with it where they are.
        """
        doc_id, text, source = self.keys
        inside = (F.col("cut") > 0) & (2 * F.col("cut") >= F.col("size"))
        src, key, last, epochs, copy = free_names(docs.columns, "src", "key", "last", "epochs", "copy")
        border = materialize(
            self.rows.groupBy(F.col("_src").alias(src)).agg(F.max(F.when(inside, F.col("_key"))).alias(last), F.max("epochs").alias(epochs)),
            "mix_border",
        )
        keyed = docs.withColumns({src: _source_key(source), key: random_key(self.seed, doc_id, text)})
        copies = F.col(epochs) + F.when(F.col(key) <= F.col(last), 1).otherwise(0)
        return (
            keyed.join(border, src)
            .withColumn(copy, F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies.cast("int")))))
            .select(*docs.columns)
        )
