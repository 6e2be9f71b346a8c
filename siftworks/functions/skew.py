"""Splitting hot groups.

AQE splits a shuffle partition that is large in *bytes*. A self join explodes
long before that: a group of a million short rows is a small partition and
10^12 pairs. So groups are told apart by their row count, and the heavy ones
take a route whose work is spread over many tasks.

Joins of a large table with one row per key are left to AQE, under one condition: the small
side must be a stored table. A side aggregated on the join key in the same plan
is joined in the partitions of its aggregation, and such a join AQE cannot split.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, NumericType

from siftworks.sources.shared import materialize

# A group with more rows than this takes the heavy route of its operator.
HEAVY_ROWS = 5_000

# A key table is broadcast only when its counted rows are at most this many.
BROADCAST_ROWS = 200_000

# Pairs that one task makes from partner lists and groups in memory.
PAIRS_PER_PARTITION = 1_000_000


class Split(NamedTuple):
    light: DataFrame
    heavy: DataFrame | None
    sizes: DataFrame | None
    n_heavy: int


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast for a table of short rows whose count is known to be small."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


class Packing(NamedTuple):
    """How an id and a small whole number share one integer: the number in the low bits, above it the id, and
    above that whether the entry is late. Packed entries are in the order of (late, id, number)."""

    kind: str
    id_bits: int
    value_bits: int
    id_type: DataType
    value_type: DataType

    def pack(self, entity: str, value: str, late: Column | None) -> Column:
        packed = F.shiftleft(F.col(entity).cast("bigint"), self.value_bits) + F.col(value).cast("bigint")
        if late is not None:
            packed = packed + F.shiftleft(late.cast("bigint"), self.id_bits + self.value_bits)
        return packed.cast(self.kind)

    def late(self, entry: Column) -> Column:
        return entry >= 1 << (self.id_bits + self.value_bits)

    def id(self, entry: Column) -> Column:
        return F.shiftright(entry, self.value_bits).bitwiseAND((1 << self.id_bits) - 1).cast(self.id_type)

    def value(self, entry: Column) -> Column:
        return entry.bitwiseAND((1 << self.value_bits) - 1).cast(self.value_type)

    def after(self, entry: Column, other: Column) -> Column:
        """Whether an entry comes after another one that is not late, with another id."""
        return F.shiftright(entry, self.value_bits) > F.shiftright(other, self.value_bits)


def packing(ids: DataFrame, entity: str, values: DataFrame, value: str) -> Packing | None:
    """A packing for the ids of one table and the distances between the values of another, or None where
    ids are no whole numbers of at least 0, values are null or no whole numbers, or both are too long for 63 bits."""
    id_type, value_type = ids.schema[entity].dataType, values.schema[value].dataType
    if not isinstance(id_type, IntegralType) or not isinstance(value_type, NumericType):
        return None
    low, high = ids.agg(F.min(entity), F.max(entity)).first()
    whole = F.coalesce(F.col(value) == F.floor(value), F.lit(False))
    least, most, fits = values.agg(F.min(value), F.max(value), F.bool_and(whole)).first()
    if low is None or low < 0 or not fits or most - least >= 1 << 30:
        return None
    id_bits, value_bits = int(high).bit_length(), int(most - least).bit_length()
    bits = id_bits + value_bits + 1
    return None if bits > 63 else Packing("int" if bits < 32 else "bigint", id_bits, value_bits, id_type, value_type)


def split_heavy(
    df: DataFrame,
    key: str,
    heavy_rows: int = HEAVY_ROWS,
    partner: DataFrame | None = None,
    counts: DataFrame | None = None,
) -> Split:
    """Split ``df`` by group size: light groups, heavy groups, sizes (key, count) of the heavy
    groups and their number.

    The sizes are one map-side combined count, so a hot group costs one row per
    task in that shuffle. ``heavy`` is None when there is no heavy group, which
    keeps the usual plan free of the second route. The rows of ``partner``, a table
    to be joined on the key, count towards a group as well. ``counts`` (key, count) saves counting.
    """
    if counts is None:
        keys = df.select(key)
        if partner is not None:
            keys = keys.unionByName(partner.select(key))
        counts = keys.groupBy(key).count()
    sizes = counts.filter(F.col("count") > heavy_rows)
    n = sizes.count()
    if n == 0:
        return Split(df, None, None, 0)
    sizes = broadcast_if_small(materialize(sizes, "heavy"), n)
    keys = sizes.select(key)
    return Split(df.join(keys, key, "left_anti"), df.join(keys, key, "left_semi"), sizes, n)


def self_pairs(
    df: DataFrame, key: str, entity: str, carry: list[str] | None = None, wanted: str | None = None
) -> DataFrame:
    """Pairs (a, b) of different entities that share ``key``, for groups of moderate size.

    Each pair comes in one order only: ``a < b``. With the boolean column ``wanted`` only pairs
    with a wanted entity are made, wanted rows meeting all rows; if just one entity of a
    pair is wanted, it comes first. A column c of ``carry`` comes along as c_a and c_b.
    """
    l, r = df.alias("l"), df.alias("r")
    same = F.col(f"l.{key}") == F.col(f"r.{key}")
    before = F.col(f"l.{entity}") < F.col(f"r.{entity}")
    if wanted is None:
        met = l.join(r, same & before)
    else:
        met = l.filter(F.col(wanted)).join(r, same & (before | ~F.col(f"r.{wanted}")))
    names = [(entity, "a", "b"), *[(c, f"{c}_a", f"{c}_b") for c in carry or []]]
    return met.select(
        *[F.col(f"{side}.{c}").alias(name) for c, a, b in names for side, name in (("l", a), ("r", b))]
    )


def _entry(entity: str, value: str, wanted: str | None, packed: Packing | None) -> Column:
    """A row in the list of its group; in the order of entries the wanted ones come first, by entity."""
    late = ~F.col(wanted) if wanted else None
    if packed:
        return packed.pack(entity, value, late)
    first = [late.alias("late")] if wanted else []
    return F.struct(*first, F.col(entity).alias("e"), F.col(value).alias("v"))


def _not_late(entries: DataFrame, packed: Packing | None) -> DataFrame:
    return entries.filter(~packed.late(F.col("x")) if packed else ~F.col("x.late"))


def _lists(entries: DataFrame, value: str, partners: str, packed: Packing | None) -> DataFrame:
    """The columns of ``partner_lists`` from (x, partners): an entry and the entries it is paired with."""
    kept = entries.filter(F.size(partners) > 0)
    if packed:
        x = F.col("x")
        return kept.select(
            packed.id(x).alias("a"), packed.value(x).alias(f"{value}_a"), F.col(partners).alias("bs")
        )
    return kept.select(
        F.col("x.e").alias("a"),
        F.col("x.v").alias(f"{value}_a"),
        F.col(f"{partners}.e").alias("bs"),
        F.col(f"{partners}.v").alias(f"{value}_bs"),
    )


def partner_lists(
    df: DataFrame, key: str, entity: str, value: str, wanted: str | None = None, packed: Packing | None = None
) -> DataFrame:
    """The pairs of ``self_pairs`` as one row per row of ``df``: (a, value_a, bs, value_bs).

    A pair costs its partner's entry in two plain arrays instead of a row of its own, or with ``packed`` one
    integer of one array, (a, value_a, bs). The lists of an entity that is in a group twice may hold the entity itself.
    """
    groups = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        # groups of moderate size
        .agg(F.sort_array(F.collect_list(_entry(entity, value, wanted, packed))).alias("_all"))
    )
    entries = groups.select(F.posexplode("_all").alias("_at", "x"), "_all")
    if wanted:
        entries = _not_late(entries, packed)
    after = F.slice("_all", F.col("_at") + 2, F.size("_all") - F.col("_at") - 1)
    entries = entries.filter(F.col("_at") + 1 < F.size("_all")).select("x", after.alias("_after"))
    return _lists(entries, value, "_after", packed)


def blocked_partner_lists(
    df: DataFrame,
    sizes: DataFrame,
    key: str,
    entity: str,
    value: str,
    wanted: str | None = None,
    block_rows: int = HEAVY_ROWS,
    packed: Packing | None = None,
) -> DataFrame:
    """The same lists for heavy groups, each group cut into blocks of about ``block_rows``.

    Every block of a group meets every block of it under the join key (key, p, q), and an entry lists the
    partners of one block in a row.
    """
    blocks = _block_counts(sizes, key, block_rows, "blocks")
    block = F.pmod(F.xxhash64(entity), F.col("blocks")).cast("int")
    lists = (
        df.join(blocks, key)
        .groupBy(key, "blocks", block.alias("block"))
        .agg(F.collect_list(_entry(entity, value, wanted, packed)).alias("_all"))
    )
    every = F.explode(F.expr("sequence(0, blocks - 1)"))
    l = lists.select(key, F.col("block").alias("p"), every.alias("q"), F.col("_all").alias("_mine"))
    r = lists.select(key, every.alias("p"), F.col("block").alias("q"), F.col("_all").alias("_theirs"))
    entries = l.join(r, [key, "p", "q"]).select(F.explode("_mine").alias("x"), "_theirs")
    if wanted:
        entries = _not_late(entries, packed)
    if packed:
        met = F.filter("_theirs", lambda y: packed.after(y, F.col("x")))
    elif wanted:
        met = F.filter("_theirs", lambda y: y["late"] | (y["e"] > F.col("x.e")))
    else:
        met = F.filter("_theirs", lambda y: y["e"] > F.col("x.e"))
    return _lists(entries.select("x", met.alias("_met")), value, "_met", packed)


def pairs_of_lists(lists: DataFrame, value: str, n_pairs: int, packed: Packing | None = None) -> DataFrame:
    """Pairs (a, b, value_a, value_b) from partner lists, partitioned by ``a``.

    Only the lists are shuffled: what is grouped by (a, b) afterwards needs no shuffle of the pairs. ``n_pairs``,
    which may be an upper bound, gives the number of partitions, as lists grow after their shuffle. Further
    columns of the lists come along.
    """
    more = [c for c in lists.columns if c not in ("a", "bs", f"{value}_a", f"{value}_bs")]
    spark = lists.sparkSession
    cores = min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    partitions = max(cores, math.ceil(n_pairs / PAIRS_PER_PARTITION))
    dealt = lists.repartition(partitions, "a")
    if packed:
        y = F.col("y")
        pairs = dealt.select("a", f"{value}_a", F.explode("bs").alias("y"), *more).select(
            "a", packed.id(y).alias("b"), f"{value}_a", packed.value(y).alias(f"{value}_b"), *more
        )
        return pairs.filter(F.col("a") != F.col("b"))
    return (
        dealt.select("a", f"{value}_a", F.posexplode("bs").alias("_at", "b"), f"{value}_bs", *more)
        .filter(F.col("a") != F.col("b"))
        .select("a", "b", f"{value}_a", F.get(f"{value}_bs", F.col("_at")).alias(f"{value}_b"), *more)
    )


def _block_counts(sizes: DataFrame, key: str, block_rows: int, name: str) -> DataFrame:
    return sizes.select(key, F.ceil(F.col("count") / F.lit(block_rows)).cast("int").alias(name))


def blocked_self_pairs(
    df: DataFrame,
    sizes: DataFrame,
    key: str,
    entity: str,
    carry: list[str] | None = None,
    wanted: str | None = None,
    block_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """The same pairs for heavy groups, each group cut into blocks of about ``block_rows``.

    Block p of a group meets every block q >= p under the join key (key, p, q),
    so a group of n rows becomes (n / block_rows)^2 / 2 equal join groups spread over the
    cluster instead of one. ``sizes`` is that of ``split_heavy``.
    """
    carry = carry or []
    blocks = _block_counts(sizes, key, block_rows, "blocks")
    rows = df.join(blocks, key).withColumn("block", F.pmod(F.xxhash64(entity), F.col("blocks")).cast("int"))
    columns = [key, entity, *carry, *([wanted] if wanted else [])]
    l = rows.select(
        *columns, F.col("block").alias("lo"), F.explode(F.expr("sequence(block, blocks - 1)")).alias("hi")
    ).alias("l")
    r = rows.select(
        *columns, F.explode(F.expr("sequence(0, block)")).alias("lo"), F.col("block").alias("hi")
    ).alias("r")
    smaller = F.col(f"l.{entity}") < F.col(f"r.{entity}")
    once = (F.col("l.lo") < F.col("l.hi")) | smaller
    first = smaller
    if wanted:
        lw, rw = F.col(f"l.{wanted}"), F.col(f"r.{wanted}")
        once = once & (lw | rw)
        first = (lw & ~rw) | ((lw == rw) & smaller)
    met = l.join(
        r,
        (F.col(f"l.{key}") == F.col(f"r.{key}"))
        & (F.col("l.lo") == F.col("r.lo"))
        & (F.col("l.hi") == F.col("r.hi"))
        & once,
    )
    out = []
    for name, a, b in [(entity, "a", "b"), *[(c, f"{c}_a", f"{c}_b") for c in carry]]:
        left, right = F.col(f"l.{name}"), F.col(f"r.{name}")
        out += [F.when(first, left).otherwise(right).alias(a), F.when(first, right).otherwise(left).alias(b)]
    return met.select(*out)


def blocked_join(
    left: DataFrame,
    right: DataFrame,
    sizes: DataFrame,
    key: str,
    block_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Inner join on heavy keys, which may hold very many rows on both sides.

    Each side of a group is cut into blocks of about ``block_rows`` and every
    block of one side meets every block of the other in a join group of its own.
    ``sizes`` (key, ...) lists the keys.
    """

    def cut(df: DataFrame, blocks: str, block: str) -> DataFrame:
        carried = [c for c in df.columns if c != key]
        return df.withColumn(block, F.pmod(F.xxhash64(*carried), F.col(blocks)).cast("int"))

    def blocks(df: DataFrame, name: str) -> DataFrame:
        counted = df.join(sizes.select(key), key, "left_semi").groupBy(key).count()
        return _block_counts(counted, key, block_rows, name)

    both = materialize(blocks(left, "_lb").join(blocks(right, "_rb"), key), "blocks")
    both = broadcast_if_small(both, both.count())
    l = cut(left.join(both, key), "_lb", "_i").withColumn("_j", F.explode(F.expr("sequence(0, _rb - 1)")))
    r = cut(right.join(both, key), "_rb", "_j").withColumn("_i", F.explode(F.expr("sequence(0, _lb - 1)")))
    return l.drop("_lb", "_rb").join(r.drop("_lb", "_rb"), [key, "_i", "_j"]).drop("_i", "_j")
