"""Rating tables ``(user, item, rating)``: summaries, known rows and entity pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.functions.skew import (
    HEAVY_ROWS,
    blocked_join,
    blocked_partner_lists,
    blocked_self_pairs,
    broadcast_if_small,
    packing,
    pairs_of_lists,
    partner_lists,
    self_pairs,
    split_heavy,
)
from siftworks.sources.shared import materialize


def user_totals(ratings: DataFrame) -> DataFrame:
    """(user, n, total, mean) as a stored table, ready to be joined to rows of hot users."""
    return materialize(
        ratings.groupBy("user").agg(
            F.count("*").alias("n"), F.sum("rating").alias("total"), F.avg("rating").alias("mean")
        ),
        "user-totals",
    )


def user_means(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("user").agg(F.count("*").alias("n"), F.avg("rating").alias("mean"))


def known_rows(
    test: DataFrame, train: DataFrame, need_item: bool = False, totals: DataFrame | None = None
) -> DataFrame:
    """Test rows whose user (and, with ``need_item``, whose item) occurs in training.

    ``totals`` saves a pass over training where the caller has ``user_totals`` already.
    """
    users = materialize(train.select("user").distinct(), "users") if totals is None else totals.select("user")
    known = test.join(users, "user", "left_semi")
    if need_item:
        known = known.join(materialize(train.select("item").distinct(), "items"), "item", "left_semi")
    return known.select("user", "item", "rating")


def histories(ratings: DataFrame, by: str = "user", chunk: int = 1000) -> DataFrame:
    """Ratings grouped by user or item as arrays of ``(other, rating)``.

    A history of more than about ``chunk`` entries is cut into parts by a hash
    of the other id, so no row and no task holds an unbounded group.
    Returns (by, part, n, entries).
    """
    other = "item" if by == "user" else "user"
    digest = F.md5(F.col(other).cast("string").cast("binary"))
    bucket = F.conv(F.substring(digest, 1, 7), 16, 10).cast("bigint")
    sizes = materialize(
        ratings.groupBy(by).agg(F.ceil(F.count("*") / F.lit(chunk)).alias("_parts")), "sizes"
    )
    return (
        ratings.join(sizes, by)
        .withColumn("part", bucket % F.col("_parts"))
        .groupBy(by, "part")
        .agg(
            F.count("*").alias("n"),
            F.array_sort(F.collect_list(F.struct(F.col(other), F.col("rating")))).alias("entries"),
        )
    )


def leave_one_out_mean(ratings: DataFrame) -> DataFrame:
    """Each user's mean over all ratings but the row's own; NULL for a single rating."""
    totals = user_totals(ratings).select("user", "n", "total")
    return ratings.join(totals, "user").select(
        "user", "item", rest_mean().alias("loo_mean")
    )


def rest_mean() -> Column:
    """The mean of a user's other ratings, from the columns of ``user_totals`` and ``rating``."""
    return F.try_divide(F.col("total") - F.col("rating"), F.col("n") - 1)


def unordered_pairs(
    ratings: DataFrame, entity: str, other: str, heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Distinct pairs ``a < b`` of entities that share at least one ``other``."""
    rows = ratings.select(other, entity)
    light, heavy, sizes, _ = split_heavy(rows, other, heavy_rows)
    pairs = self_pairs(light, other, entity)
    if heavy is not None:
        pairs = pairs.unionByName(blocked_self_pairs(heavy, sizes, other, entity, block_rows=heavy_rows))
    return pairs.distinct()


def both_ways(pairs: DataFrame, *carry: str) -> DataFrame:
    """Ordered pairs from unordered ones in one pass; ``a = b`` stays one row."""
    ways = F.when(
        F.col("a") == F.col("b"), F.array(F.struct(F.col("a").alias("a"), F.col("b").alias("b")))
    ).otherwise(
        F.array(
            F.struct(F.col("a").alias("a"), F.col("b").alias("b")),
            F.struct(F.col("b").alias("a"), F.col("a").alias("b")),
        )
    )
    return pairs.select(F.explode(ways).alias("_p"), *carry).select("_p.a", "_p.b", *carry)


def _listed_pairs(ratings: DataFrame, entity: str, other: str, heavy_rows: int) -> DataFrame:
    """The pairs of ``unordered_pairs`` in either order, moved as lists of partners and made distinct where they arrive.

    An entity with more than ``heavy_rows`` rows lists none of its lighter partners: they list it, so that no task gets all
    pairs of one entity.
    """
    rows = ratings.select(other, entity).filter(F.col(entity).isNotNull()).withColumn("_one", F.lit(0))
    counts = materialize(rows.groupBy(entity).count(), "counts")
    hot = counts.filter(F.col("count") > heavy_rows).select(entity)
    n_hot = hot.count()
    wanted = None
    if n_hot:
        flags = broadcast_if_small(hot.withColumn("_hot", F.lit(True)), n_hot)
        wanted = "_light"
        rows = rows.join(flags, entity, "left").select(other, entity, "_one", F.col("_hot").isNull().alias(wanted))
        rows = materialize(rows, "flagged")
    packed = packing(counts, entity, counts.select(F.lit(0).alias("_one")), "_one")
    groups = materialize(rows.groupBy(other).count(), "groups")
    light, heavy, sizes, _ = split_heavy(rows, other, heavy_rows, counts=groups)
    lists = partner_lists(light, other, entity, "_one", wanted, packed)
    if heavy is not None:
        # the same columns, in blocks
        more = blocked_partner_lists(heavy, sizes, other, entity, "_one", wanted, heavy_rows, packed)
        lists = lists.unionByName(more)
    n_pairs = int(groups.filter(F.col(other).isNotNull()).agg(F.sum(F.col("count") * F.col("count")) / 2).first()[0] or 0)
    pairs = pairs_of_lists(lists, "_one", n_pairs, packed).select("a", "b").distinct()
    if n_hot > 1:
        # at most one entity in ``heavy_rows`` rows
        among = unordered_pairs(rows.filter(~F.col(wanted)), entity, other, heavy_rows)
        pairs = pairs.unionByName(among)
    return pairs


def co_pairs(
    ratings: DataFrame, entity: str = "item", other: str = "user", heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """All ordered pairs of entities that share an ``other``, each entity with itself included."""
    selves = ratings.select(F.col(entity).alias("a"), F.col(entity).alias("b")).distinct()
    return both_ways(_listed_pairs(ratings, entity, other, heavy_rows).unionByName(selves))


def test_user_pairs(test: DataFrame, train: DataFrame, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Distinct (test user, rater of one of that user's test items), both known in training."""
    wanted = known_rows(test, train, need_item=True).select("item", "user")
    raters = train.select("item", F.col("user").alias("neighbour"))
    light, heavy, sizes, _ = split_heavy(raters, "item", heavy_rows, partner=wanted)
    pairs = wanted.join(light, "item").select("user", "neighbour")
    if heavy is not None:
        pairs = pairs.unionByName(
            blocked_join(wanted, heavy, sizes, "item", heavy_rows).select("user", "neighbour")
        )
    return pairs.distinct()


test_user_pairs.__test__ = False  # not a unit test, whatever its name suggests
