import itertools
import random

import pytest
from conftest import rows
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from siftworks.operators import chunks
from siftworks.operators.chunks import chunk_itemsets, chunk_supports
from siftworks.operators.itemsets import (
    apriori_candidates,
    frequent_level,
    itemset_report,
    mine_levels,
)
from siftworks.plans.mining import apriori, chunk_threshold, son


def brute(baskets, support):
    counts = {}
    for items in baskets.values():
        for size in range(1, len(items) + 1):
            for s in itertools.combinations(sorted(items), size):
                counts[s] = counts.get(s, 0) + 1
    return sorted((len(s), list(s), n) for s, n in counts.items() if n >= support)


def random_baskets(seed, n=40, items="abcdefgh", hot=0):
    rnd = random.Random(seed)
    out = {i: {x for x in items if rnd.random() < 0.45} or {"a"} for i in range(n)}
    for i in range(hot):
        out[n + i] = set(items)
    return out


def table(spark, baskets):
    data = [(b, x) for b, items in baskets.items() for x in items]
    return spark.createDataFrame(data, "basket bigint, item string")


def found(df):
    return sorted((r["size"], list(r["items"]), r["support"]) for r in df.collect())


@pytest.mark.parametrize("seed,support", [(1, 6), (2, 9), (3, 14)])
def test_all_ways_agree(spark, seed, support):
    data = random_baskets(seed)
    baskets = table(spark, data)
    expected = brute(data, support)
    assert found(apriori(baskets, support)) == expected
    grown = FPGrowth(minSupport=support / len(data) - 1e-9).fit(
        baskets.groupBy("basket").agg(F.collect_set("item").alias("items"))
    )
    assert sorted((len(r["items"]), sorted(r["items"]), r["freq"]) for r in grown.freqItemsets.collect()) == expected


@pytest.mark.parametrize("partitions", [1, 2, 7])
def test_two_passes_do_not_depend_on_the_chunks(spark, partitions):
    data = random_baskets(4)
    assert found(son(table(spark, data), 13, partitions)) == brute(data, 13)


@pytest.mark.parametrize("hot,support", [(1, 9), (3, 9), (12, 9), (12, 20)])
@pytest.mark.parametrize("heavy_rows", [7, 4])
def test_heavy_baskets_are_counted_exactly(spark, hot, support, heavy_rows):
    data = random_baskets(5, n=30, items="abcdefg", hot=hot)
    expected = brute(data, support)
    assert found(apriori(table(spark, data), support, heavy_rows=heavy_rows)) == expected


def test_two_passes_with_heavy_baskets(spark):
    data = random_baskets(6, n=24, items="abcdef", hot=4)
    assert found(son(table(spark, data), 12, 3, heavy_rows=4)) == brute(data, 12)


def test_support_is_lowered_per_chunk_but_not_below_one():
    assert chunk_threshold(30, 4) == 7.5
    assert chunk_threshold(3, 7) == 1.0


def test_repeated_items_count_once_and_infrequent_items_drop_out(spark):
    baskets = spark.createDataFrame(
        [(1, "a"), (1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "c")], "basket bigint, item string"
    )
    assert found(apriori(baskets, 2)) == [(1, ["a"], 2), (1, ["b"], 2), (2, ["a", "b"], 2)]


def test_no_frequent_itemset_gives_no_rows(spark):
    baskets = table(spark, {1: {"a"}, 2: {"b"}})
    assert found(apriori(baskets, 5)) == []
    assert found(son(baskets, 5, 2)) == []
    assert itemset_report(apriori(baskets, 5)).collect() == []


def test_max_size(spark):
    data = random_baskets(1)
    assert found(apriori(table(spark, data), 6, max_k=2)) == [r for r in brute(data, 6) if r[0] <= 2]


@pytest.mark.parametrize("heavy_rows", [5000, 2])
def test_candidates_need_all_subsets(spark, heavy_rows):
    pairs = spark.createDataFrame(
        [(["a", "b"],), (["a", "c"],), (["b", "c"],), (["a", "d"],), (["b", "d"],)], "items array<string>"
    )
    got = [r[0] for r in apriori_candidates(pairs, 3, heavy_rows).collect()]
    # a,c,d and b,c,d lack c,d
    assert sorted(got) == [["a", "b", "c"], ["a", "b", "d"]]
    singles = spark.createDataFrame([(["a"],), (["b"],), (["c"],)], "items array<string>")
    assert sorted(r[0] for r in apriori_candidates(singles, 2, heavy_rows).collect()) == [
        ["a", "b"], ["a", "c"], ["b", "c"],
    ]


def test_counting_given_candidates(spark):
    data = random_baskets(8)
    wanted = [["a", "b", "c"], ["b", "d", "g"], ["x", "y", "z"]]
    candidates = spark.createDataFrame([(w,) for w in wanted], "items array<string>")
    expected = [(s, n) for _, s, n in brute(data, 2) if s in wanted]
    got = frequent_level(table(spark, data), candidates, 2)
    assert sorted((list(r["items"]), r["support"]) for r in got.collect()) == expected
    none = frequent_level(table(spark, data), candidates.limit(0), 2)
    assert none.collect() == []


def test_levels_by_chunk_are_mined_apart(spark):
    data = random_baskets(9)
    chunked = table(spark, data).withColumn("chunk", (F.col("basket") % 2).cast("int"))
    levels = mine_levels(chunked, 6, by=["chunk"])
    for chunk in (0, 1):
        part = {b: s for b, s in data.items() if b % 2 == chunk}
        got = sorted(
            (len(r["items"]), list(r["items"]), r["support"])
            for level in levels
            for r in level.collect()
            if r["chunk"] == chunk
        )
        assert got == brute(part, 6)


def test_report_lines(spark):
    sets = spark.createDataFrame(
        [(1, ["b"]), (1, ["a"]), (2, ["a", "c"]), (2, ["a", "b"]), (1, ["c"])], "size int, items array<string>"
    )
    assert rows(itemset_report(sets)) == [(1, 0, "(a),(b),(c)"), (2, 0, "(a,b),(a,c)")]
    assert rows(itemset_report(sets, per_line=2)) == [(1, 0, "(a),(b)"), (1, 1, "(c)"), (2, 0, "(a,b),(a,c)")]


def test_chunks_follow_data_and_support_not_settings(spark):
    from siftworks.plans.mining import chunk_count, chunk_threshold

    small = spark.createDataFrame([("b", "i")], "basket string, item string")
    assert chunk_count(small, 30) == 1 and chunk_threshold(30, chunk_count(small, 30)) == 30


@pytest.mark.parametrize("cells", [1, 60, 1 << 20])
def test_chunks_by_bitmaps_and_by_lists(spark, cells):
    data = random_baskets(8, n=90)
    rows_ = table(spark, data).selectExpr("CAST(basket % 3 AS int) AS chunk", "basket", "item")
    got = sorted((r.chunk, list(r["items"]), r.n) for r in chunk_itemsets(rows_, 4, cells=cells).collect())
    want = [(c, s, n) for c in range(3) for _, s, n in brute({b: i for b, i in data.items() if b % 3 == c}, 4) if len(s) > 1]
    assert got == sorted(want) and len(want) > 50
    asked = [(c, s) for c in range(3) for s in (["a", "c"], ["a", "c", "d"], ["b", "h"], ["a", "z"], ["z", "zz"])] + [(9, ["a", "b"])]
    wanted = spark.createDataFrame(asked, "chunk int, items array<string>")
    many = lambda s, c: sum(set(s) <= i for b, i in data.items() if b % 3 == c)
    counted = sorted((list(r["items"]), r.n) for r in chunk_supports(rows_, wanted, 6, cells=cells).collect())
    assert counted == sorted((s, many(s, c)) for c, s in asked)


def test_candidates_are_shared_out(spark, monkeypatch):
    monkeypatch.setattr(chunks, "CANDIDATES_PER_TASK", 2)
    data = random_baskets(9)
    assert found(son(table(spark, data), 13, 4)) == brute(data, 13)


def test_longest_size_and_empty_baskets_of_two_passes(spark):
    data = random_baskets(10)
    assert found(son(table(spark, data), 8, 3, max_k=2)) == [r for r in brute(data, 8) if r[0] <= 2]
    assert son(table(spark, data).limit(0), 8, 3).count() == 0


@pytest.mark.parametrize("support", [6, 110])
def test_chunks_too_large_for_a_task(spark, support):
    # with 6 the chunks are mined level by level, with 110 there are more of them
    data = random_baskets(11, n=160, items="abcdef", hot=30)
    assert found(son(table(spark, data), support, 1, chunk_rows=200)) == brute(data, support)


def test_rows_are_shuffled_once_before_they_are_mined(spark):
    rows_ = table(spark, random_baskets(12)).selectExpr("CAST(basket % 3 AS int) AS chunk", "basket", "item")
    dealt = rows_.repartitionById(3, F.col("chunk"))
    assert len(dealt.groupBy(F.spark_partition_id()).count().collect()) == 3
    plan = chunk_itemsets(dealt, 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_numbers_as_items_of_two_passes(spark):
    data = {b: {"abcdefgh".index(x) * 7 for x in items} for b, items in random_baskets(13).items()}
    rows_ = spark.createDataFrame([(str(b), x) for b, items in data.items() for x in items], "basket string, item bigint")
    assert found(son(rows_, 12, 3)) == brute(data, 12)
