"""Neighbour choice and rating prediction from pair similarities.

``sim`` is the unordered table of ``pair_similarity``: one row per pair with
``a <= b``, looked up by the smaller and the larger id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftworks.functions.skew import HEAVY_ROWS, split_heavy
from siftworks.operators.ratings import both_ways, rest_mean
from siftworks.sources.shared import materialize

# Up to so many rows are paired and looked up without counting what the other way would make.
FEW_ROWS = 100_000

# What a key has rated is marked in so many numbers of 64 bits.
MARKS = [f"_marks{i}" for i in range(2)]


def _other_of(key: str) -> str:
    return "item" if key == "user" else "user"


def _lookup(rows: DataFrame, sim: DataFrame, left: str, right: str) -> DataFrame:
    low, high = F.least(left, right), F.greatest(left, right)
    return rows.withColumn("a", low).withColumn("b", high).join(
        sim.select("a", "b", "similarity"), ["a", "b"]
    )


def _bit(entity: str) -> Column:
    return F.pmod(F.xxhash64(entity), F.lit(64 * len(MARKS)))


def _marks(rated: DataFrame, key: str, entity: str) -> DataFrame:
    """(key, marks): one bit set for each entity of the key, which others may share; stored for joins with hot keys."""
    at = _bit(entity)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (at % 64).cast("int"))
    words = [F.bit_or(F.when(F.floor(at / 64) == i, one)).alias(name) for i, name in enumerate(MARKS)]
    return materialize(rated.groupBy(key).agg(*words), "marks")


def _is_marked(entity: str) -> Column:
    """Whether the bit of the entity is set: so for all that the key has rated, and for some others."""
    at = _bit(entity)
    word = F.element_at(F.array(*MARKS), (F.floor(at / 64) + 1).cast("int"))
    return F.bit_get(F.coalesce(word, F.lit(0).cast("bigint")), (at % 64).cast("int")) == 1


def _candidates(
    wanted: DataFrame,
    train: DataFrame,
    sim: DataFrame,
    key: str,
    target: str,
    other: str,
    heavy_rows: int,
) -> DataFrame:
    """(wanted columns, other, rating, similarity) for every train row that shares ``key``
    with a wanted row and whose ``other`` is similar to the row's ``target``.

    The rows are met from the similarities of the target, or by pairing the rows of the key with the
    wanted row and looking the pairs up, whichever makes fewer rows. A key with very many rows
    is always met from the similarities, so that its whole group is never paired with each wanted row.
    With more than a few rows, those met from the similarities are held against the marks of the key first, so
    that few that the key has not rated are shuffled.
    """
    rated = train.select(key, F.col(_other_of(key)).alias(other), "rating")
    columns = [*wanted.columns, other, "rating", "similarity"]

    def by_similarity(rows: DataFrame, theirs: DataFrame) -> DataFrame:
        similar = both_ways(sim, "similarity").select(
            F.col("a").alias(target), F.col("b").alias(other), "similarity"
        )
        if by_key > FEW_ROWS:
            rows = rows.join(_marks(theirs, key, other), key).join(similar, target).filter(_is_marked(other))
        else:
            rows = rows.join(similar, target)
        return rows.drop(*MARKS).join(theirs, [key, other]).select(*columns)

    by_key = _met(wanted, rated, key)
    if by_key > FEW_ROWS:
        sim = materialize(sim, "similarity")
        of_target = both_ways(sim).select(F.col("a").alias(target))
        if _met(wanted, of_target, target) <= by_key:
            return by_similarity(wanted, rated)
    light, heavy, sizes, _ = split_heavy(rated, key, heavy_rows, partner=wanted)
    if heavy is not None and by_key <= FEW_ROWS:
        sim = materialize(sim, "similarity")
    out = _lookup(wanted.join(light, key), sim, target, other).select(*columns)
    if heavy is not None:
        hot = wanted.join(sizes.select(key), key, "left_semi")
        out = out.unionByName(by_similarity(hot, heavy))
    return out


def _met(left: DataFrame, right: DataFrame, key: str) -> int:
    """How many rows the join on ``key`` has."""
    l = left.groupBy(key).agg(F.count("*").alias("_l"))
    r = right.groupBy(key).agg(F.count("*").alias("_r"))
    return l.join(r, key).agg(F.sum(F.col("_l") * F.col("_r"))).first()[0] or 0


def _choose(candidates: DataFrame, group: list[str], other: str, k: int, order: str) -> DataFrame:
    if order not in ("asc", "desc"):
        raise ValueError("order is 'asc' or 'desc'")
    # partial sums arrive in any order, so the last digits of a similarity are not repeatable
    rounded = F.round("similarity", 9)
    by = rounded.asc() if order == "asc" else rounded.desc()
    # the filter on row_number lets Spark keep k rows per group before the shuffle
    ranked = candidates.withColumn(
        "rank", F.row_number().over(W.partitionBy(*group).orderBy(by, F.col(other).asc()))
    )
    return ranked.filter(F.col("rank") <= k)


def item_neighbours(
    test: DataFrame,
    train: DataFrame,
    sim: DataFrame,
    k: int = 10,
    order: str = "asc",
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """The ``k`` rated items chosen for each test row: (user, target, item, rank, rating, similarity).

    ``order='asc'`` takes the least similar of those above the threshold and is
    the default of the programs rebuilt here; ``'desc'`` is the textbook choice.
    """
    wanted = test.select("user", F.col("item").alias("target"))
    found = _candidates(wanted, train, sim, "user", "target", "neighbour", heavy_rows)
    chosen = _choose(found, ["user", "target"], "neighbour", k, order)
    return chosen.select("user", "target", F.col("neighbour").alias("item"), "rank", "rating", "similarity")


def user_neighbours(
    test: DataFrame,
    train: DataFrame,
    sim: DataFrame,
    k: int = 10,
    order: str = "asc",
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """The ``k`` raters of the item chosen for each test row:
    (user, item, neighbour, rank, rating, similarity)."""
    wanted = test.select("user", "item")
    found = _candidates(wanted, train, sim, "item", "user", "neighbour", heavy_rows)
    chosen = _choose(found, ["user", "item"], "neighbour", k, order)
    return chosen.select("user", "item", "neighbour", "rank", "rating", "similarity")


def item_predict(
    test: DataFrame, totals: DataFrame, neighbours: DataFrame, k: int = 10, min_nb: int = 1
) -> DataFrame:
    """Similarity-weighted mean of the chosen ratings; the user's mean below ``min_nb`` neighbours.

    ``totals`` is ``user_totals`` of training, ``neighbours`` must hold at least
    max(k, min_nb) ranks. Returns (user, item, prediction, user_mean) for the test
    rows of known users.
    """
    top = F.col("rank") <= k
    weighed = neighbours.groupBy("user", F.col("target").alias("item")).agg(
        F.count("*").alias("_nb"),
        F.try_divide(
            F.sum(F.when(top, F.col("rating") * F.col("similarity"))),
            F.sum(F.when(top, F.abs("similarity"))),
        ).alias("_weighed"),
    )
    return (
        test.select("user", "item")
        .join(totals.select("user", F.col("mean").alias("user_mean")), "user")
        .join(weighed, ["user", "item"], "left")
        .select(
            "user",
            "item",
            F.when(F.col("_nb") >= min_nb, F.col("_weighed"))
            .otherwise(F.col("user_mean"))
            .alias("prediction"),
            "user_mean",
        )
    )


def user_predict(
    known: DataFrame, totals: DataFrame, neighbours: DataFrame, k: int = 10, min_nb: int = 5
) -> DataFrame:
    """The user's mean plus the weighted deviation of the chosen raters from their own means.

    A rater's mean leaves the target item out. Below ``min_nb`` neighbours the
    deviation is 0. ``known`` are the test rows whose user and item are both known;
    returns (user, item, prediction, user_mean) for them.
    """
    of_neighbour = totals.select(F.col("user").alias("neighbour"), "n", "total")
    top = F.col("rank") <= k
    weighed = (
        neighbours.join(of_neighbour, "neighbour")
        .groupBy("user", "item")
        .agg(
            F.count("*").alias("_nb"),
            F.try_divide(
                F.sum(F.when(top, (F.col("rating") - rest_mean()) * F.col("similarity"))),
                F.sum(F.when(top, F.col("similarity"))),
            ).alias("_shift"),
        )
    )
    shift = F.when(F.col("_nb") >= min_nb, F.col("_shift")).otherwise(F.lit(0.0))
    return (
        known.select("user", "item")
        .join(totals.select("user", F.col("mean").alias("user_mean")), "user")
        .join(weighed, ["user", "item"], "left")
        .select("user", "item", (F.col("user_mean") + shift).alias("prediction"), "user_mean")
    )
