"""Frequent itemsets of baskets ``(basket, item)``, level by level.

An itemset is an ascending array. Level k is counted from the occurrences of
level k - 1: each (basket, itemset) row is extended by the larger items of its
basket, so only itemsets that occur are ever built. Occurrences and baskets are
both partitioned by basket, which makes every extension a join without a shuffle.

Baskets with very many frequent items are not extended. At most H such baskets
can add to a support, so an itemset with fewer than ``threshold - H`` ordinary
occurrences is out, and the rest are looked up in the heavy baskets. With more heavy baskets than that,
those that have few subsets of a size list them within their row, if that makes fewer rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.functions.ordering import global_position
from siftworks.functions.skew import (
    HEAVY_ROWS,
    blocked_self_pairs,
    broadcast_if_small,
    split_heavy,
)
from siftworks.sources.shared import materialize, partitions_for


# A heavy basket with more subsets of a size than this does not list them.
SUBSETS_PER_BASKET = 10_000


def _without(position: int) -> Column:
    """``items`` without the element at a 1-based position."""
    return F.concat(
        F.slice("items", 1, position - 1),
        F.slice("items", F.lit(position + 1), F.greatest(F.size("items") - position, F.lit(0))),
    )


def _have_frequent_subsets(sets: DataFrame, level: DataFrame, by: list[str], positions: range) -> DataFrame:
    """Itemsets whose subsets without one of ``positions`` are all in ``level``."""
    known = level.select(*by, F.col("items").alias("_subset"))
    for position in positions:
        sets = sets.withColumn("_subset", _without(position)).join(known, [*by, "_subset"], "left_semi")
        sets = sets.drop("_subset")
    return sets


def apriori_candidates(
    level: DataFrame, size: int, heavy_rows: int = HEAVY_ROWS, by: list[str] | None = None
) -> DataFrame:
    """Candidates of ``size`` from the frequent itemsets of ``size - 1``: (by..., items).

    Two itemsets that differ only in their last item are joined, within each value of
    ``by``; candidates with an infrequent subset are pruned.
    """
    by = by or []
    prefix = F.struct(*by, F.slice("items", 1, size - 2).alias("head"))
    rows = level.select(prefix.alias("prefix"), F.element_at("items", -1).alias("last"))
    light, heavy, sizes, _ = split_heavy(rows, "prefix", heavy_rows)
    key = [F.col(f"prefix.{c}").alias(c) for c in by]

    def joined(pairs: DataFrame) -> DataFrame:
        return pairs.select(*key, F.concat("prefix.head", F.array("a", "b")).alias("items"))

    l = light.select("prefix", F.col("last").alias("a"))
    r = light.select("prefix", F.col("last").alias("b"))
    candidates = joined(l.join(r, "prefix").filter("a < b"))
    if heavy is not None:
        keyed = heavy.select("prefix", F.struct("prefix", "last").alias("row"))
        pairs = blocked_self_pairs(keyed, sizes, "prefix", "row", block_rows=heavy_rows)
        met = pairs.select(F.col("a.prefix").alias("prefix"), F.col("a.last").alias("a"), F.col("b.last").alias("b"))
        candidates = candidates.unionByName(joined(met))
    # the subsets without the last or the last but one item are the two joined ones
    return _have_frequent_subsets(candidates, level, by, range(1, size - 1))


def _heavy_support(sets: DataFrame, heavy: DataFrame, by: list[str]) -> DataFrame:
    """How many heavy baskets contain each of ``sets``.

    A set meets only the baskets that hold its rarest item, and its other items are
    looked up there. All sides are stored, so adaptive execution can split a hot item.
    """
    found = materialize(heavy.groupBy(*by, "item").agg(F.count("*").alias("_n")), "heavy-items")
    items = sets.select(*by, "items", F.explode("items").alias("item"))
    # an item in no heavy basket at all has no row, and fewer places than the set has items
    rarest = (
        items.join(found, [*by, "item"])
        .groupBy(*by, "items")
        .agg(F.min(F.struct("_n", "item"))["item"].alias("item"), F.count("*").alias("_places"))
        .filter(F.col("_places") == F.size("items"))
        .drop("_places")
    )
    met = materialize(rarest, "rarest").join(heavy, [*by, "item"])
    others = met.select(*by, "items", "basket", F.explode(F.array_except("items", F.array("item"))).alias("item"))
    return (
        others.join(heavy, [*by, "basket", "item"])
        .groupBy(*by, "items", "basket")
        .count()
        .filter(F.col("count") == F.size("items") - 1)
        .groupBy(*by, "items")
        .agg(F.count("*").alias("support"))
    )


def _subset_counts(size: int) -> Column:
    """How many subsets of ``size`` the ``_n`` items of a basket have, as a double."""
    count = F.lit(1.0)
    for i in range(size):
        count = count * (F.col("_n") - i) / (i + 1)
    return count


def _subsets(size: int) -> Column:
    """All subsets of ``size`` of the ascending array ``_items``."""
    longer = lambda c: F.transform(
        F.filter("_items", lambda x: x > F.element_at(c, -1)), lambda x: F.concat(c, F.array(x))
    )
    sets = F.transform("_items", lambda x: F.array(x))
    for _ in range(size - 1):
        sets = F.flatten(F.transform(sets, longer))
    return sets


def _heavy_by_size(candidates: DataFrame, heavy: DataFrame, by: list[str], size: int) -> DataFrame:
    """``_heavy_support`` of all candidates of a size: a heavy basket lists its subsets, or is met by lookups.

    The rows of both ways are counted, over the baskets that may list their subsets.
    """
    sizes = heavy.groupBy(*by, "basket").agg(F.count("*").alias("_n"))
    few = materialize(sizes.filter(_subset_counts(size) <= SUBSETS_PER_BASKET).select("basket", "_n"), "few-subsets")
    listed = heavy.join(few.select("basket"), "basket", "left_semi")
    n_listed = few.agg(F.sum(_subset_counts(size))).first()[0]
    if n_listed is None:
        return _heavy_support(candidates, heavy, by)
    candidates = materialize(candidates, "candidates")
    found = listed.groupBy(*by, "item").agg(F.count("*").alias("_n"))
    met = candidates.select(*by, "items", F.explode("items").alias("item")).join(found, [*by, "item"])
    rarest = met.groupBy(*by, "items").agg(F.min("_n").alias("_n"), F.count("*").alias("_places"))
    # each basket met is followed by one lookup per other item
    lookups = rarest.filter(F.col("_places") == size).agg(F.sum("_n") * (size - 1)).first()[0] or 0
    if lookups < n_listed:
        return _heavy_support(candidates, heavy, by)
    baskets = listed.groupBy(*by, "basket").agg(F.sort_array(F.collect_set("item")).alias("_items"))
    counts = (
        baskets.select(*by, F.explode(_subsets(size)).alias("items"))
        .groupBy(*by, "items")
        .agg(F.count("*").alias("support"))
        .join(candidates, [*by, "items"], "left_semi")
    )
    rest = heavy.join(few.select("basket"), "basket", "left_anti")
    if rest.isEmpty():
        return counts
    more = _heavy_support(candidates, materialize(rest, "heavy-baskets"), by)
    return counts.unionByName(more.select(counts.columns))


def _heavy_pairs(heavy: DataFrame, sizes: DataFrame, by: list[str], heavy_rows: int) -> DataFrame:
    """Supports of all pairs within the heavy baskets, each basket cut into blocks."""
    rows = heavy.select("basket", F.struct("item", *by).alias("row"))
    pairs = blocked_self_pairs(rows, sizes, "basket", "row", block_rows=heavy_rows)
    return pairs.groupBy(
        *[F.col(f"a.{c}").alias(c) for c in by], F.array("a.item", "b.item").alias("items")
    ).agg(F.count("*").alias("support"))


def mine_levels(
    baskets: DataFrame,
    threshold: float,
    by: list[str] | None = None,
    max_k: int | None = None,
    candidates: DataFrame | None = None,
    heavy_rows: int = HEAVY_ROWS,
) -> list[DataFrame]:
    """Frequent itemsets of each size as stored tables (by..., items, support).

    ``by`` mines separately within each value of these columns, which must be
    functions of the basket. ``candidates`` (items) restricts the count to
    those itemsets and their prefixes, over all baskets.
    """
    by = by or []
    if by and candidates is not None:
        raise ValueError("candidates are counted over all baskets, without 'by'")
    distinct = baskets.select(*by, "basket", "item").distinct().persist()
    rows = distinct
    singles = rows.groupBy(*by, "item").agg(F.count("*").alias("support"))
    if candidates is not None:
        wanted = candidates.select(F.explode("items").alias("item")).distinct()
        singles = singles.join(wanted, "item", "left_semi")
    singles = materialize(singles.filter(F.col("support") >= threshold), "itemsets")
    n, n_rows = singles.agg(F.count("*"), F.sum("support")).first()
    level = singles.select(*by, F.array("item").alias("items"), "support")
    levels = [level]
    if n == 0 or max_k == 1:
        distinct.unpersist()
        return levels

    rows = rows.join(broadcast_if_small(singles.select(*by, "item"), n), [*by, "item"], "left_semi")
    light, heavy, sizes, n_heavy = split_heavy(rows, "basket", heavy_rows)
    light = light.select(*by, "basket", "item")
    # the supports of the frequent items add up to their rows
    light = light.repartition(partitions_for(light, n_rows), "basket").persist()
    if heavy is not None:
        heavy = materialize(heavy.select(*by, "basket", "item"), "heavy-baskets")
    occurrences = light.select(*by, "basket", F.array("item").alias("items"))
    extension = light.select("basket", "item")
    kept = []
    size = 1
    while n and (max_k is None or size < max_k):
        size += 1
        extended = (
            occurrences.join(extension, "basket")
            .filter(F.col("item") > F.element_at("items", -1))
            .select(*by, "basket", F.concat("items", F.array("item")).alias("items"))
        )
        if candidates is not None:
            prefixes = candidates.filter(F.size("items") >= size).select(
                F.slice("items", 1, size).alias("items")
            )
            prefixes = materialize(prefixes.distinct(), "prefixes")
            extended = extended.join(broadcast_if_small(prefixes, prefixes.count()), "items", "left_semi")
        elif size > 2:
            extended = _have_frequent_subsets(extended, broadcast_if_small(level, n), by, range(1, size))
        extended = extended.persist()
        counts = extended.groupBy(*by, "items").agg(F.count("*").alias("support"))
        if heavy is not None:
            counts = _with_heavy(
                counts, level, heavy, sizes, by, size, threshold, n_heavy, candidates, heavy_rows
            )
        level = materialize(counts.filter(F.col("support") >= threshold), "itemsets")
        n = level.count()
        levels.append(level)
        occurrences = extended.join(
            broadcast_if_small(level.select(*by, "items"), n), [*by, "items"], "left_semi"
        )
        kept.append(extended)
        if len(kept) > 1:
            kept.pop(0).unpersist()
    for df in (*kept, light, distinct):
        df.unpersist()
    return levels


def _with_heavy(
    counts: DataFrame,
    level: DataFrame,
    heavy: DataFrame,
    sizes: DataFrame,
    by: list[str],
    size: int,
    threshold: float,
    n_heavy: int,
    candidates: DataFrame | None,
    heavy_rows: int,
) -> DataFrame:
    """Supports over light and heavy baskets together."""
    if n_heavy < threshold:
        counts = counts.filter(F.col("support") >= threshold - n_heavy)
        counts = materialize(counts, "light-support")
        more = _heavy_support(counts, heavy, by)
    elif candidates is not None:
        wanted = candidates.filter(F.size("items") >= size).select(F.slice("items", 1, size).alias("items"))
        more = _heavy_support(wanted.distinct(), heavy, by)
    elif size == 2:
        more = _heavy_pairs(heavy, sizes, by, heavy_rows)
    else:
        more = _heavy_by_size(apriori_candidates(level, size, heavy_rows, by), heavy, by, size)
    both = counts.select(*by, "items", "support").unionByName(more.select(*by, "items", "support"))
    return both.groupBy(*by, "items").agg(F.sum("support").alias("support"))


def frequent_level(
    baskets: DataFrame, candidates: DataFrame, support: float, heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """The candidates (items) contained in at least ``support`` baskets: (items, support)."""
    size = candidates.agg(F.max(F.size("items"))).first()[0] or 0
    if size == 0:
        return candidates.select("items", F.lit(0).cast("bigint").alias("support")).limit(0)
    counted = mine_levels(baskets, support, max_k=size, candidates=candidates, heavy_rows=heavy_rows)
    out = counted[0]
    for more in counted[1:]:
        out = out.unionByName(more)
    return out.join(candidates.select("items").distinct(), "items", "left_semi").select("items", "support")


def frequent_items(baskets: DataFrame, support: float) -> DataFrame:
    """Level one: (items, support)."""
    return mine_levels(baskets, support, max_k=1)[0]


def sized(levels: list[DataFrame]) -> DataFrame:
    """All levels as one table (size, items, support)."""
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out.select(F.size("items").alias("size"), "items", "support")


def itemset_report(itemsets: DataFrame, per_line: int = 1000) -> DataFrame:
    """Report lines ``(a,b),(a,c)``: (size, line_no, line), itemsets in order within a size.

    A size with more than ``per_line`` itemsets continues on further lines, so
    that no task holds all itemsets of a size.
    """
    numbered = global_position(itemsets.select("size", "items"), ["size", "items"], "position")
    first = numbered.groupBy("size").agg(F.min("position").alias("_first"))
    text = F.concat(F.lit("("), F.array_join("items", ","), F.lit(")"))
    return (
        # one row per itemset size
        numbered.join(F.broadcast(first), "size")
        .withColumn("line_no", F.floor((F.col("position") - F.col("_first")) / per_line))
        .groupBy("size", "line_no")
        .agg(F.array_sort(F.collect_list(F.struct("position", text.alias("text")))).alias("sets"))
        .select("size", "line_no", F.array_join(F.col("sets.text"), ",").alias("line"))
    )
