"""Absolute Pearson correlation of users or items over their co-rated entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.functions.skew import (
    HEAVY_ROWS,
    Packing,
    blocked_partner_lists,
    blocked_self_pairs,
    packing,
    pairs_of_lists,
    partner_lists,
    split_heavy,
)
from siftworks.operators.ratings import both_ways
from siftworks.sources.shared import materialize

# Sums of squares and products about the means of the shared entries, which merge without
# cancellation: an offset of all ratings, or of one that no partner shares, does not count.
MOMENTS = ["n", "ma", "mb", "saa", "sbb", "sab"]

# Similarities this near to a bound, or to 1, equal it up to rounding.
ROUNDING = 1e-12

# The heavy groups are paired within blocks while that makes at most so many pairs per row of the
# table, besides as many as the light groups make; beyond that they are looked up.
PAIRS_PER_ROW = 100


def _sums(a: Column, b: Column, n: Column) -> list[Column]:
    found = [n, F.avg(a), F.avg(b), F.regr_sxx(b, a), F.regr_syy(b, a), F.regr_sxy(b, a)]
    return [c.alias(name) for c, name in zip(found, MOMENTS)]


def _moments(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a", "b").agg(*_sums(F.col("rating_a"), F.col("rating_b"), F.count("*")))


def _moments_by_route(pairs: DataFrame) -> DataFrame:
    """The moments of the rows with and without ``heavy`` put together as ``_add_up`` does: with ratings that
    are NULL this is not what ``_moments`` gives."""

    def route(heavy: Column) -> Column:
        of = lambda c: F.when(heavy, F.col(c))
        return F.struct(*_sums(of("rating_a"), of("rating_b"), F.count(F.when(heavy, 1))))

    both = pairs.groupBy("a", "b").agg(route(~F.col("heavy")).alias("x"), route(F.col("heavy")).alias("y"))
    x, y = F.col("x"), F.col("y")
    merged = F.when(y["n"] == 0, x).when(x["n"] == 0, y).otherwise(_merged(x, y))
    return both.select("a", "b", merged.alias("m")).select("a", "b", "m.*")


def _merged(x: Column, y: Column) -> Column:
    """The moments of two sets of entries together, by their means and sizes."""
    n = x["n"] + y["n"]
    da, db = y["ma"] - x["ma"], y["mb"] - x["mb"]
    share = y["n"] / n
    between = x["n"] * share
    return F.struct(
        n.alias("n"),
        (x["ma"] + da * share).alias("ma"),
        (x["mb"] + db * share).alias("mb"),
        (x["saa"] + y["saa"] + da * da * between).alias("saa"),
        (x["sbb"] + y["sbb"] + db * db * between).alias("sbb"),
        (x["sab"] + y["sab"] + da * db * between).alias("sab"),
    )


def _add_up(moments: DataFrame) -> DataFrame:
    """The moments of each pair over all routes, of which there are three at most."""
    parts = moments.groupBy("a", "b").agg(F.array_sort(F.collect_list(F.struct(*MOMENTS))).alias("parts"))
    first, rest = F.col("parts")[0], F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(1)))
    return parts.select("a", "b", F.aggregate(rest, first, _merged).alias("m")).select("a", "b", "m.*")


def absolute_pearson() -> Column:
    """|r| from the moments of a pair; NULL where either side has no variance, 1 where it is 1 up to rounding."""
    varies = (F.col("saa") > 0) & (F.col("sbb") > 0)
    r = F.abs("sab") / F.sqrt(F.col("saa") * F.col("sbb"))
    return F.when(varies, F.when(r > 1 - ROUNDING, 1.0).otherwise(r))


def _usable(ratings: DataFrame, entity: str, min_common: int, targets: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The entities (entity, n, wanted) that can have a defined similarity to anything at all, and their rows.

    Fewer ratings than the overlap needed, or one constant rating, rules an
    entity out for every partner, so dropping it first changes no result. The
    column ``wanted`` tells the targets. Ratings become differences from the entity's smallest
    one, which leaves the correlation as it is and makes whole stars exact under any offset.
    """
    alive = (
        ratings.groupBy(entity)
        .agg(F.count("*").alias("n"), F.min("rating").alias("_lo"), F.max("rating").alias("_hi"))
        .filter((F.col("n") >= min_common) & (F.col("_lo") < F.col("_hi")))
        .select(entity, "n", "_lo")
    )
    if targets is None:
        alive = alive.withColumn("wanted", F.lit(True))
    else:
        flagged = targets.select(entity).distinct().withColumn("_target", F.lit(True))
        alive = alive.join(flagged, entity, "left").select(
            entity, "n", "_lo", F.coalesce("_target", F.lit(False)).alias("wanted")
        )
    alive = materialize(alive, "usable")
    rows = ratings.join(alive.drop("n"), entity)
    return alive, rows.withColumn("rating", F.col("rating") - F.col("_lo")).drop("_lo")


def _lookup_moments(pairs: DataFrame, heavy: DataFrame, entity: str, other: str) -> DataFrame:
    """What the heavy groups add to the given pairs, by two lookups instead of all their pairs."""
    left = heavy.select(F.col(entity).alias("a"), other, F.col("rating").alias("rating_a"))
    right = heavy.select(F.col(entity).alias("b"), other, F.col("rating").alias("rating_b"))
    return _moments(pairs.select("a", "b").join(left, "a").join(right, ["b", other]))


def _pair_counts(sizes: DataFrame, heavy_rows: int) -> tuple[int, int, int]:
    """The rows of the table and the pairs within its light and its heavy groups, from (key, count)."""
    n = F.col("count")
    pairs, heavy = n * (n - 1) / 2, n > heavy_rows
    found = sizes.agg(F.sum(n), F.sum(F.when(~heavy, pairs)), F.sum(F.when(heavy, pairs))).first()
    return tuple(int(x or 0) for x in found)


def _pair_moments(
    rows: DataFrame,
    entity: str,
    other: str,
    min_common: int,
    wanted: str | None,
    heavy_rows: int,
    packed: Packing | None = None,
) -> DataFrame:
    """Moments of every pair with at least ``min_common`` shared entries, each in one order.

    ``packed`` tells how entities and ratings travel where they can be packed.
    """
    counts = materialize(rows.filter(F.col(other).isNotNull()).groupBy(other).count(), "counts")
    light, heavy, sizes, n_heavy = split_heavy(rows, other, heavy_rows, counts=counts)
    enough = F.col("n") >= min_common
    n_rows, n_pairs, n_heavy_pairs = _pair_counts(counts, heavy_rows)
    lists = partner_lists(light, other, entity, "rating", wanted, packed)
    if heavy is not None and n_heavy_pairs <= n_pairs + PAIRS_PER_ROW * n_rows:
        blocked = blocked_partner_lists(heavy, sizes, other, entity, "rating", wanted, heavy_rows, packed)
        n_pairs, heavy = n_pairs + n_heavy_pairs, None
        # packed ratings are not NULL
        if packed is None and not rows.filter(F.col("rating").isNull()).isEmpty():
            told = lists.withColumn("heavy", F.lit(False)).unionByName(blocked.withColumn("heavy", F.lit(True)))
            return _moments_by_route(pairs_of_lists(told, "rating", n_pairs)).filter(enough)
        lists = lists.unionByName(blocked)
    from_light = _moments(pairs_of_lists(lists, "rating", n_pairs, packed))
    if heavy is None:
        return from_light.filter(enough)
    # A pair can meet in at most n_heavy heavy groups, so one that meets in fewer than
    # min_common - n_heavy light groups is out before the heavy groups are looked at.
    from_light = materialize(from_light.filter(F.col("n") >= min_common - n_heavy), "moments")
    parts = from_light.unionByName(_lookup_moments(from_light, heavy, entity, other))
    if n_heavy >= min_common:
        # Pairs that meet in heavy groups only: both entities are in min_common of them.
        frequent = heavy.groupBy(entity).count().filter(F.col("count") >= min_common).select(entity)
        shared = heavy.join(materialize(frequent, "shared"), entity, "left_semi")
        only_heavy = _moments(
            blocked_self_pairs(shared, sizes, other, entity, ["rating"], wanted, heavy_rows)
        ).filter(enough)
        parts = parts.unionByName(only_heavy.join(from_light.select("a", "b"), ["a", "b"], "left_anti"))
    return _add_up(parts).filter(enough)


def pair_similarity(
    ratings: DataFrame,
    entity: str = "item",
    min_common: int = 2,
    min_sim: float = 0.01,
    targets: DataFrame | None = None,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Similarities of unordered pairs ``a <= b``: (a, b, n_common, similarity).

    Undefined similarities are dropped like those below ``min_sim``. An entity
    is also paired with itself. With ``targets``, a table with the entity's column,
    only pairs with at least one target are computed.
    """
    other = "user" if entity == "item" else "item"
    alive, rows = _usable(ratings.select(entity, other, "rating"), entity, min_common, targets)
    wanted = None if targets is None else "wanted"
    # the ratings of the rows are differences within an entity
    packed = packing(alive, entity, ratings, "rating")
    moments = _pair_moments(rows, entity, other, min_common, wanted, heavy_rows, packed)
    # the correlation is the same in both orders
    low, high = (F.col("a"), F.col("b")) if targets is None else (F.least("a", "b"), F.greatest("a", "b"))
    similar = moments.select(low.alias("a"), high.alias("b"), F.col("n").alias("n_common"), absolute_pearson().alias("similarity"))
    # ratings that vary agree with themselves
    own = F.col(entity)
    selves = alive.filter("wanted").select(own.alias("a"), own.alias("b"), F.col("n").alias("n_common"), F.lit(1.0).alias("similarity"))
    return similar.unionByName(selves).filter(F.col("similarity") >= F.lit(min_sim - ROUNDING))


def pearson_similarity(
    ratings: DataFrame,
    entity: str = "item",
    pairs: DataFrame | None = None,
    min_common: int = 2,
    min_sim: float = 0.01,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Similarities of ordered pairs, optionally only for ``pairs`` given as (a, b)."""
    targets = None if pairs is None else pairs.select(F.col("a").alias(entity))
    similar = pair_similarity(ratings, entity, min_common, min_sim, targets, heavy_rows)
    both = both_ways(similar, "n_common", "similarity")
    if pairs is not None:
        both = both.join(pairs.select("a", "b").distinct(), ["a", "b"], "left_semi")
    return both.select("a", "b", "n_common", "similarity")
