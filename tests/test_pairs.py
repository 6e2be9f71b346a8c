"""Pairs from partner lists, and neighbours met from the similarities."""

import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from siftworks.functions.skew import blocked_partner_lists, pairs_of_lists, partner_lists, self_pairs, split_heavy
from siftworks.operators import itemsets, neighbours, similarity
from siftworks.operators.similarity import pair_similarity

PAIR = ["a", "b", "v_a", "v_b"]


def groups(spark):
    """Groups of 1 to 40 rows, entities that come twice in a group, rows without a group."""
    own = spark.range(300).select(
        F.when(F.col("id") < 40, 0).when(F.col("id") < 290, 1 + F.col("id") % 23).alias("k"),
        (F.col("id") * 7 % 61).alias("e"),
        F.col("id").cast("double").alias("v"),
    )
    return own.unionByName(own.filter("v % 9 = 0").withColumn("v", F.col("v") + 0.5)).withColumn("w", F.col("e") % 4 == 0)


@pytest.mark.parametrize("wanted", [None, "w"])
def test_lists_hold_the_pairs(spark, wanted):
    df = groups(spark)
    expected = rows(self_pairs(df, "k", "e", ["v"], wanted), *PAIR)
    assert rows(pairs_of_lists(partner_lists(df, "k", "e", "v", wanted), "v", 10), *PAIR) == expected
    light, heavy, sizes, _ = split_heavy(df, "k", 8)
    lists = partner_lists(light, "k", "e", "v", wanted).unionByName(
        blocked_partner_lists(heavy, sizes, "k", "e", "v", wanted, 8)
    )
    assert rows(pairs_of_lists(lists, "v", 10_000_000), *PAIR) == expected


def test_pairs_are_not_shuffled(spark):
    train = spark.range(3000).selectExpr("id % 60 user", "id * 7 % 90 item", "cast(id * id % 5 as double) rating")
    for heavy_rows in (5000, 10):
        sim = pair_similarity(train, "item", heavy_rows=heavy_rows)
        plan = sim._jdf.queryExecution().executedPlan().toString()
        dealt = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
        assert any(d.startswith("a#") for d in dealt) and not any("b#" in d for d in dealt)


def test_heavy_groups_by_blocks_and_by_lookups(spark, monkeypatch):
    train = spark.range(4000).selectExpr(
        "if(id % 3 = 0, id % 2, id % 70) user", "id * 11 % 83 item", "cast(id * id % 7 as double) rating"
    ).dropDuplicates(["user", "item"])
    found = []
    for heavy_rows, per_row in ((5000, 100), (10, 100), (50, -(10**9)), (10, -(10**9))):
        monkeypatch.setattr(similarity, "PAIRS_PER_ROW", per_row)
        sim = pair_similarity(train, "item", 2, 0.2, heavy_rows=heavy_rows)
        found.append(rows(sim.withColumn("similarity", F.round("similarity", 9))))
    assert len(found[0]) > 100 and all(f == found[0] for f in found)


@pytest.mark.parametrize("min_sim", [0.01, 0.97])
def test_neighbours_by_either_side(spark, monkeypatch, min_sim):
    rated = spark.range(1500).selectExpr("id % 41 user", "id * 7 % 53 item", "cast(id * id % 5 as double) rating")
    rated = rated.dropDuplicates(["user", "item"])
    train, test = rated.filter("(user + item) % 4 > 0"), rated.filter("(user + item) % 4 = 0")
    sim = pair_similarity(train, "item", 2, min_sim)
    monkeypatch.setattr(neighbours, "FEW_ROWS", -1)
    found = []
    for met in (neighbours._met, lambda left, right, key: int(key == "target"), lambda left, right, key: int(key != "target")):
        monkeypatch.setattr(neighbours, "_met", met)
        found.append(rows(neighbours.item_neighbours(test, train, sim).withColumn("similarity", F.round("similarity", 9))))
    assert found[0] and found[0] == found[1] == found[2]


def test_heavy_baskets_list_their_subsets(spark, monkeypatch):
    b = spark.range(3000).selectExpr("id % 150 basket", "concat('i', pmod(hash(id), if(id % 150 < 5, 14, 9))) item").distinct()
    expected = rows(itemsets.sized(itemsets.mine_levels(b, 12, max_k=3)))
    assert max(r[0] for r in expected) == 3
    looked_up = []
    plain = itemsets._heavy_support
    monkeypatch.setattr(itemsets, "_heavy_support", lambda *a: looked_up.append(1) or plain(*a))
    assert rows(itemsets.sized(itemsets.mine_levels(b, 12, max_k=3, heavy_rows=4))) == expected and not looked_up
    # the largest baskets are looked up, the others list their subsets
    monkeypatch.setattr(itemsets, "SUBSETS_PER_BASKET", 60)
    assert rows(itemsets.sized(itemsets.mine_levels(b, 12, max_k=3, heavy_rows=4))) == expected and looked_up


def test_null_ratings_count_alike_by_blocks_and_by_lookups(spark, monkeypatch):
    train = spark.range(900).selectExpr(
        "id % 30 user", "id * 11 % 47 item", "if(id % 8 = 0, null, cast(id * id % 7 as double)) rating"
    ).filter("user % 3 > 0 or item < 20").dropDuplicates(["user", "item"])
    found = []
    for per_row in (100, -(10**9)):
        monkeypatch.setattr(similarity, "PAIRS_PER_ROW", per_row)
        sim = pair_similarity(train, "item", 2, 0.2, heavy_rows=25)
        found.append(rows(sim.withColumn("similarity", F.round("similarity", 9))))
    assert found[0] and found[0] == found[1]
