"""Whole itemset runs: all sizes, level by level or in two partitioned passes."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.functions.skew import HEAVY_ROWS, broadcast_if_small
from siftworks.operators.chunks import chunk_itemsets, chunk_supports
from siftworks.operators.itemsets import mine_levels, sized
from siftworks.sources.shared import materialize


def apriori(
    baskets: DataFrame, support: float, max_k: int | None = None, heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """All itemsets in at least ``support`` baskets: (size, items, support)."""
    return sized(mine_levels(baskets, support, max_k=max_k, heavy_rows=heavy_rows))


# Basket rows in a chunk, and the least support that a chunk must still ask for: below it
# nearly every subset of a basket would be a candidate.
ROWS_PER_CHUNK = 5_000_000
MIN_CHUNK_SUPPORT = 25


def chunk_count(baskets: DataFrame, support: float) -> int:
    """Chunks of about ``ROWS_PER_CHUNK`` rows, but no more than leave a chunk's threshold meaningful."""
    return int(max(1, min(math.ceil(baskets.count() / ROWS_PER_CHUNK), support // MIN_CHUNK_SUPPORT)))


def chunk_threshold(support: float, partitions: int) -> float:
    """The support an itemset must reach in some chunk to be able to reach ``support`` in all."""
    return max(1.0, support / partitions)


def _chunked(rows: DataFrame, chunks: int) -> DataFrame:
    return rows.withColumn("chunk", F.pmod(F.xxhash64("basket"), F.lit(chunks)).cast("int"))


def son(
    baskets: DataFrame,
    support: float,
    partitions: int,
    max_k: int | None = None,
    heavy_rows: int = HEAVY_ROWS,
    chunk_rows: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """The same itemsets in two passes: (size, items, support).

    Pass one mines each chunk of baskets with a lowered threshold, within one task, after the only shuffle of
    the rows. Itemsets found in a chunk have their support there; in a chunk where they
    were not found it is below the threshold. Pass two counts only what this leaves open, and only in
    the chunks where it was not found.

    There are at least ``partitions`` chunks, and more where a chunk would have more than ``chunk_rows``
    rows. If that lowers the threshold below ``MIN_CHUNK_SUPPORT``, the chunks stay as large as asked for and are
    mined level by level over many tasks.
    """
    distinct = materialize(baskets.select("basket", "item").distinct(), "distinct-baskets")
    singles = mine_levels(distinct, support, max_k=1)[0]
    n_items, n_rows = singles.agg(F.count("*"), F.coalesce(F.sum("support"), F.lit(0))).first()
    if n_items == 0 or max_k == 1:
        return sized([singles])
    chunks = max(partitions, math.ceil(n_rows / chunk_rows))
    if chunks > partitions and chunk_threshold(support, chunks) < MIN_CHUNK_SUPPORT:
        return _son_by_levels(distinct, support, partitions, max_k, heavy_rows)
    least = math.ceil(chunk_threshold(support, chunks))
    names = broadcast_if_small(singles.select(F.col("items")[0].alias("item")), n_items)
    known = distinct.filter("basket IS NOT NULL").join(names, "item", "left_semi")
    rows = _chunked(known, chunks).select("chunk", "basket", "item").repartitionById(chunks, F.col("chunk"))
    local = materialize(chunk_itemsets(rows, least, max_k), "local-itemsets")
    found = local.groupBy("items").agg(F.sum("n").alias("support"), F.count("*").alias("_chunks"))
    most = F.col("support") + (chunks - F.col("_chunks")) * (least - 1)
    found = materialize(found.filter(most >= support), "candidates")
    open_ = found.filter(F.col("_chunks") < chunks)
    n_open = open_.count()
    supports = found.select("items", "support")
    if n_open:
        every = open_.select("items", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
        missing = every.join(local.select("chunk", "items"), ["chunk", "items"], "left_anti")
        more = chunk_supports(rows, missing, n_open).select("items", F.col("n").alias("support"))
        supports = supports.unionByName(more).groupBy("items").agg(F.sum("support").alias("support"))
    return sized([singles, materialize(supports.filter(F.col("support") >= support), "itemsets")])


def _son_by_levels(
    baskets: DataFrame, support: float, partitions: int, max_k: int | None, heavy_rows: int
) -> DataFrame:
    """Chunks as a column of the mining plan, so that a chunk may be larger than a task."""
    local = mine_levels(
        _chunked(baskets, partitions),
        chunk_threshold(support, partitions),
        by=["chunk"],
        max_k=max_k,
        heavy_rows=heavy_rows,
    )
    found = materialize(sized(local).select("items").distinct(), "candidates")
    longest = found.agg(F.max(F.size("items"))).first()[0] or 1
    counted = mine_levels(baskets, support, max_k=longest, candidates=found, heavy_rows=heavy_rows)
    return sized(counted)
