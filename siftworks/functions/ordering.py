"""A global position for every row without a one-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftworks.sources.shared import materialize


def _order(columns: list[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in columns]


def global_position(
    df: DataFrame,
    order_by: list[str | Column],
    name: str = "position",
    start: int = 0,
    partitions: int | None = None,
) -> DataFrame:
    """Number the rows ``start, start + 1, ...`` in the order of ``order_by``.

    Rows are range partitioned and written once, so that the range borders are
    the same for both readers; a row's number is its place within its range
    plus the sizes of the ranges before it. The only single-task step is the
    running sum over the ranges: one row per partition. ``order_by`` must be
    unique, or at least free of values shared by very many rows, to balance.
    """
    order = _order(order_by)
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = materialize(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_n"))
    before = sizes.select(
        "_range",
        F.coalesce(
            F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
    )
    local = placed.withColumn("_place", F.row_number().over(W.partitionBy("_range").orderBy(*order)))
    return (
        # one row per range: bounded by the number of shuffle partitions
        local.join(F.broadcast(before), "_range")
        .withColumn(name, (F.col("_before") + F.col("_place") + F.lit(start - 1)).cast("bigint"))
        .drop("_range", "_before", "_place")
    )
