"""Entries packed into one number, and marks of what a key has rated."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from siftworks.functions.skew import (
    blocked_partner_lists,
    packing,
    pairs_of_lists,
    partner_lists,
    self_pairs,
    split_heavy,
)
from siftworks.operators import neighbours
from siftworks.operators.similarity import pair_similarity

PAIR = ["a", "b", "v_a", "v_b"]


def groups(spark, step=1):
    """Groups of 1 to 40 rows, some entities twice in a group, rows without a group, whole values."""
    own = spark.range(300).select(
        F.when(F.col("id") < 40, 0).when(F.col("id") < 290, 1 + F.col("id") % 23).alias("k"),
        (F.col("id") * 7 % 61 * step).alias("e"),
        (F.col("id") % 6).cast("double").alias("v"),
    )
    twice = own.filter("v = 2").withColumn("v", F.col("v") + 1)
    return own.unionByName(twice).withColumn("w", F.col("e") / step % 4 == 0)


@pytest.mark.parametrize("wanted", [None, "w"])
@pytest.mark.parametrize("step, kind", [(1, "int"), (2**36, "bigint")])
def test_packed_lists_hold_the_pairs(spark, wanted, step, kind):
    df = groups(spark, step)
    packed = packing(df, "e", df, "v")
    assert packed.kind == kind
    expected = rows(self_pairs(df, "k", "e", ["v"], wanted), *PAIR)
    lists = partner_lists(df, "k", "e", "v", wanted, packed)
    assert dict(lists.dtypes)["bs"] == f"array<{kind}>" and lists.columns == ["a", "v_a", "bs"]
    assert rows(pairs_of_lists(lists, "v", 10, packed), *PAIR) == expected
    light, heavy, sizes, _ = split_heavy(df, "k", 8)
    lists = partner_lists(light, "k", "e", "v", wanted, packed).unionByName(
        blocked_partner_lists(heavy, sizes, "k", "e", "v", wanted, 8, packed)
    )
    assert rows(pairs_of_lists(lists, "v", 10_000_000, packed), *PAIR) == expected


def test_what_cannot_be_packed(spark):
    ids = spark.range(5).selectExpr("id e", "id - 1 low", "string(id) word", "id + (bigint(1) << 61) high")
    values = spark.range(5).selectExpr(
        "double(id) v", "id / 2 half", "if(id > 0, double(id), null) gap", "if(id > 0, double(id), double('NaN')) nan",
        "double(id) * 1e12 far",
    )
    assert packing(ids, "e", values, "v") is not None
    for e in ("low", "word", "high"):
        assert packing(ids, e, values, "v") is None
    for v in ("half", "gap", "nan", "far"):
        assert packing(ids, "e", values, v) is None
    assert packing(ids.limit(0), "e", values, "v") is None and packing(ids, "e", values.limit(0), "v") is None


def test_similarities_of_packed_ratings(spark):
    train = spark.range(3000).selectExpr("id % 61 user", "id * 7 % 90 item", "cast(id * id % 7 as double) rating")
    train = train.dropDuplicates(["user", "item"])
    # an offset of a half, which no packing takes, leaves the similarities as they are
    half = train.withColumn("rating", F.col("rating") + 0.5)
    found = []
    for heavy_rows in (5000, 10):
        for rated, in_two in ((train, False), (half, True)):
            sim = pair_similarity(rated, "item", 2, 0.05, heavy_rows=heavy_rows)
            assert ("rating_bs" in sim._jdf.queryExecution().optimizedPlan().toString()) == in_two
            found.append(rows(sim.withColumn("similarity", F.round("similarity", 9))))
    assert len(found[0]) > 100 and all(f == found[0] for f in found)


def test_marks_keep_all_rated_and_few_others(spark):
    rated = spark.range(600).selectExpr("id % 40 user", "id * 7 % 997 item", "1.0 rating")
    marks = neighbours._marks(rated, "user", "item")
    mine = rated.join(marks, "user")
    assert mine.filter(neighbours._is_marked("item")).count() == mine.count() == 600
    other = marks.crossJoin(spark.range(1000, 2000).withColumnRenamed("id", "item"))
    assert other.filter(neighbours._is_marked("item")).count() < 0.25 * other.count()


def test_unrated_candidates_are_not_shuffled(spark, monkeypatch):
    rated = spark.range(900).selectExpr("id % 41 user", "id * 7 % 53 item", "cast(id * id % 5 as double) rating")
    train, test = rated.filter("(user + item) % 4 > 0"), rated.filter("(user + item) % 4 = 0")
    sim = pair_similarity(train, "item", 2, 0.01)
    found = []
    for few in (100_000, -1):
        monkeypatch.setattr(neighbours, "FEW_ROWS", few)
        if few < 0:
            monkeypatch.setattr(neighbours, "_met", lambda left, right, key: int(key != "target"))
        chosen = neighbours.item_neighbours(test, train, sim)
        assert ("bit_get" in chosen._jdf.queryExecution().optimizedPlan().toString()) == (few < 0)
        found.append(rows(chosen.withColumn("similarity", F.round("similarity", 9))))
    assert found[0] and found[0] == found[1]
