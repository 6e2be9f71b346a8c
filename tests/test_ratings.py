import itertools
import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from siftworks.operators import ratings as R
from siftworks.operators import similarity as S
from siftworks.operators.evaluation import BUCKETS, error_histogram, rmse
from siftworks.operators.neighbours import item_neighbours, user_neighbours
from siftworks.plans.recommend import item_cf, user_cf

SCHEMA = "user bigint, item bigint, rating double"


def table(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def random_ratings(seed, users=14, items=10, density=0.55, hot_user=True):
    rnd = random.Random(seed)
    data = [
        (u, 100 + i, float(rnd.randint(1, 5)))
        for u in range(users)
        for i in range(items)
        if rnd.random() < density or (hot_user and u == 0)
    ]
    test, train = [], []
    for row in data:
        (test if rnd.random() < 0.3 or row[0] == users - 1 or row[1] == 100 + items - 1 else train).append(row)
    return train, test


# --- brute force ---


def pearson(x, y):
    mx, my = sum(x) / len(x), sum(y) / len(y)
    num = sum((a - mx) * (b - my) for a, b in zip(x, y))
    dx, dy = sum((a - mx) ** 2 for a in x), sum((b - my) ** 2 for b in y)
    if dx < 1e-12 or dy < 1e-12:
        return None
    return abs(num / math.sqrt(dx * dy))


def brute_similarity(train, entity, min_sim):
    e, o = (1, 0) if entity == "item" else (0, 1)
    by = {}
    for row in train:
        by.setdefault(row[e], {})[row[o]] = row[2]
    out = {}
    for a, b in itertools.product(by, by):
        shared = sorted(by[a].keys() & by[b].keys())
        if len(shared) > 1:
            s = pearson([by[a][x] for x in shared], [by[b][x] for x in shared])
            if s is not None and s >= min_sim - 1e-9:
                out[a, b] = s
    return out


def brute_item_cf(train, test, order):
    sim = brute_similarity(train, "item", 0.01)
    history, out = {}, {}
    for u, i, r in train:
        history.setdefault(u, {})[i] = r
    for u, i, r in test:
        if u not in history:
            out[u, i] = 2.5
            continue
        found = [(round(sim[i, j], 9) * order, j, x, sim[i, j]) for j, x in history[u].items() if (i, j) in sim]
        mean = sum(history[u].values()) / len(history[u])
        top = sorted(found)[:10]
        out[u, i] = sum(x * s for _, _, x, s in top) / sum(s for *_, s in top) if top else mean
    return out


def brute_user_cf(train, test, order, min_nb):
    sim = brute_similarity(train, "user", 0.3)
    history, raters, predicted, means = {}, {}, {}, {}
    for u, i, r in train:
        history.setdefault(u, {})[i] = r
        raters.setdefault(i, {})[u] = r
    for u, i, r in test:
        if u not in history or i not in raters:
            continue
        means[u] = sum(history[u].values()) / len(history[u])
        found = sorted((round(sim[u, v], 9) * order, v, sim[u, v]) for v in raters[i] if (u, v) in sim)
        shift = 0.0
        if len(found) >= min_nb:
            num = den = 0.0
            for _, v, s in found[:10]:
                rest = [x for j, x in history[v].items() if j != i]
                num += (raters[i][v] - sum(rest) / len(rest)) * s
                den += s
            shift = num / den
        predicted[u, i] = means[u] + shift
    return {(u, i): predicted.get((u, i), means.get(u, 2.5)) for u, i, _ in test}


# --- similarity ---


def test_similarity_of_hand_made_pairs(spark):
    data = [
        # item 1 and 2 move against each other, 3 is constant, 4 shares one user with 1
        (1, 1, 1.0), (2, 1, 3.0), (3, 1, 5.0),
        (1, 2, 5.0), (2, 2, 3.0), (3, 2, 1.0),
        (1, 3, 4.0), (2, 3, 4.0), (3, 3, 4.0),
        (3, 4, 2.0), (4, 4, 5.0),
    ]
    found = {(r.a, r.b): r for r in S.pearson_similarity(table(spark, data), "item").collect()}
    assert found[1, 2].similarity == found[2, 1].similarity == 1.0
    assert found[1, 2].n_common == 3
    assert (1, 1) in found and (4, 4) in found, "an entity is paired with itself"
    assert not any(3 in pair for pair in found), "no variance, no similarity"
    assert (1, 4) not in found, "one shared user is not enough"


@pytest.mark.parametrize("entity", ["item", "user"])
@pytest.mark.parametrize("heavy_rows", [5000, 9, 6, 2])
def test_similarity_is_the_same_by_every_route(spark, entity, heavy_rows):
    train, _ = random_ratings(3)
    expected = brute_similarity(train, entity, 0.01)
    found = S.pearson_similarity(table(spark, train), entity, min_sim=0.01, heavy_rows=heavy_rows)
    got = {(r.a, r.b): r.similarity for r in found.collect()}
    assert got.keys() == expected.keys()
    assert all(got[p] == pytest.approx(expected[p]) for p in got)


def test_one_heavy_group_adds_to_pairs_met_elsewhere(spark):
    # user 0 rates everything; pairs that meet in nobody else have an overlap of one
    data = [(0, i, float(1 + i % 5)) for i in range(40)]
    data += [(1, 0, 2.0), (1, 1, 4.0), (2, 1, 5.0), (2, 2, 1.0)]
    found = S.pearson_similarity(table(spark, data), "item", heavy_rows=10)
    assert {(r.a, r.b, r.n_common) for r in found.collect() if r.a < r.b} == {(0, 1, 2), (1, 2, 2)}


def test_restricting_to_pairs(spark):
    train, test = random_ratings(5)
    tr, te = table(spark, train), table(spark, test)
    pairs = R.test_user_pairs(te, tr).select(F.col("user").alias("a"), F.col("neighbour").alias("b"))
    wanted = set(rows(pairs))
    found = S.pearson_similarity(tr, "user", pairs=pairs, min_sim=0.3)
    assert set(rows(found, "a", "b")) == brute_similarity(train, "user", 0.3).keys() & wanted


# --- pairs, histories, means ---


@pytest.mark.parametrize("heavy_rows", [5000, 3])
def test_pairs(spark, heavy_rows):
    train, test = random_ratings(7)
    tr, te = table(spark, train), table(spark, test)
    by_user, raters = {}, {}
    for u, i, _ in train:
        by_user.setdefault(u, set()).add(i)
        raters.setdefault(i, set()).add(u)
    expected = {p for items in by_user.values() for p in itertools.product(items, items)}
    assert rows(R.co_pairs(tr, heavy_rows=heavy_rows)) == sorted(expected)
    expected = {(u, v) for u, i, _ in test if u in by_user for v in raters.get(i, ())}
    assert rows(R.test_user_pairs(te, tr, heavy_rows=heavy_rows)) == sorted(expected)


def test_histories_are_whole_and_cut_into_parts(spark):
    data = [(1, i, 3.0) for i in range(200)] + [(2, 5, 1.0)]
    found = R.histories(table(spark, data), chunk=20).collect()
    assert sum(r.n for r in found) == 201
    assert sorted(e["item"] for r in found if r.user == 1 for e in r.entries) == list(range(200))
    assert max(r.n for r in found) < 60
    assert [r.part for r in found if r.user == 2] == [0]


def test_leave_one_out_mean(spark):
    data = [(1, 1, 1.0), (1, 2, 3.0), (1, 3, 5.0), (2, 1, 4.0)]
    assert rows(R.leave_one_out_mean(table(spark, data)).fillna(-1.0)) == [
        (1, 1, 4.0), (1, 2, 3.0), (1, 3, 2.0), (2, 1, -1.0),
    ]


# --- neighbours and predictions ---


def test_the_least_similar_are_chosen_by_default_and_ties_go_by_id(spark):
    train = [(1, i, 3.0) for i in range(1, 13)]
    test = table(spark, [(1, 0, 5.0)])
    distinct = spark.createDataFrame([(0, i, 0.05 * i) for i in range(1, 13)], "a bigint, b bigint, similarity double")
    ascending = item_neighbours(test, table(spark, train), distinct)
    assert [r[1] for r in rows(ascending, "rank", "item")] == list(range(1, 11))
    descending = item_neighbours(test, table(spark, train), distinct, order="desc")
    assert [r[1] for r in rows(descending, "rank", "item")] == list(range(12, 2, -1))
    equal = distinct.withColumn("similarity", F.lit(1.0))
    assert [r[1] for r in rows(item_neighbours(test, table(spark, train), equal), "rank", "item")] == list(range(1, 11))
    with pytest.raises(ValueError):
        item_neighbours(test, table(spark, train), equal, order="up")


@pytest.mark.parametrize("seed,order,heavy_rows", [(1, "asc", 5000), (2, "desc", 5000), (1, "asc", 5), (4, "asc", 2)])
def test_item_cf_against_brute_force(spark, seed, order, heavy_rows):
    train, test = random_ratings(seed, users=16, items=24)
    expected = brute_item_cf(train, test, 1 if order == "asc" else -1)
    scored = item_cf(table(spark, train), table(spark, test), order=order, heavy_rows=heavy_rows).collect()
    assert len(scored) == len(test)
    for r in scored:
        assert r.prediction == pytest.approx(expected[r.user, r.item]), (r.user, r.item)
        assert r.abs_err == pytest.approx(abs(r.prediction - r.rating))


@pytest.mark.parametrize(
    "seed,order,min_nb,heavy_rows", [(1, "asc", 5, 5000), (2, "desc", 3, 5000), (1, "asc", 5, 6), (4, "asc", 12, 2)]
)
def test_user_cf_against_brute_force(spark, seed, order, min_nb, heavy_rows):
    train, test = random_ratings(seed, users=24, items=14)
    expected = brute_user_cf(train, test, 1 if order == "asc" else -1, min_nb)
    scored = user_cf(
        table(spark, train), table(spark, test), order=order, min_nb=min_nb, heavy_rows=heavy_rows
    ).collect()
    assert len(scored) == len(test)
    for r in scored:
        assert r.prediction == pytest.approx(expected[r.user, r.item]), (r.user, r.item)


def test_fallbacks_differ_between_the_two(spark):
    train = table(spark, [(1, 1, 1.0), (1, 2, 2.0), (2, 1, 4.0), (2, 2, 5.0)])
    test = table(
        spark,
        [
            (9, 1, 3.0),  # unknown user
            (1, 9, 3.0),  # unknown item, but user 1 also has a known test item
            (1, 1, 3.0),
            (2, 9, 3.0),  # the only test item of user 2 is unknown
            (9, 9, 3.0),
        ],
    )
    item = {(r.user, r.item): r.prediction for r in item_cf(train, test).collect()}
    assert item[9, 1] == item[9, 9] == 2.5
    assert item[1, 9] == 1.5 and item[2, 9] == 4.5
    user = {(r.user, r.item): r.prediction for r in user_cf(train, test).collect()}
    assert user[9, 1] == user[9, 9] == 2.5
    assert user[1, 9] == 1.5, "the mean is known from the other test row"
    assert user[2, 9] == 2.5, "no predicted row, no mean"


def test_heavy_keys_give_the_same_user_neighbours(spark):
    train, test = random_ratings(11, users=30, items=8, density=0.8)
    tr, te = table(spark, train), table(spark, test)
    known = R.known_rows(te, tr, need_item=True)
    sim = S.pair_similarity(tr, "user", min_sim=0.3)
    assert rows(user_neighbours(known, tr, sim)) == rows(user_neighbours(known, tr, sim, heavy_rows=4))


def test_histogram_and_rmse(spark):
    scored = spark.createDataFrame([(0.0,), (0.9999999999999,), (1.5,), (4.0,), (7.0,), (None,)], "abs_err double")
    # the second error is 1 up to rounding; an undefined one goes into the last bucket
    assert rows(error_histogram(scored)) == sorted([(BUCKETS[0], 1), (BUCKETS[1], 2), (BUCKETS[4], 3)])
    assert rmse(spark.createDataFrame([(3.0,), (4.0,)], "abs_err double")).first().rmse == pytest.approx(math.sqrt(12.5))


def test_a_large_offset_of_all_ratings_changes_no_similarity(spark):
    from siftworks.operators.similarity import pair_similarity

    rnd = random.Random(4)
    data = [(u, i, float(rnd.randint(1, 5))) for u in range(8) for i in range(4)]
    schema = "user int, item int, rating double"
    near, far = (
        {(r.a, r.b): round(r.similarity, 9) for r in pair_similarity(spark.createDataFrame(d, schema)).collect()}
        for d in (data, [(u, i, x + 1e7) for u, i, x in data])
    )
    assert near == far and len(near) > 4


@pytest.mark.parametrize("heavy_rows", [5000, 3, 2])
@pytest.mark.parametrize("extra", [[], [("z", "A", 0.0)], [("z", "A", -1e12), ("z", "C", 3.0)]])
def test_ratings_nobody_shares_do_not_touch_a_similarity(spark, heavy_rows, extra):
    import statistics

    from siftworks.operators.similarity import pair_similarity

    a, b = [1e7 + r for r in (1, 2, 3, 5)], [2.0, 1.0, 4.0, 5.0]
    given = [(u, "A", r) for u, r in zip("stuv", a)] + [(u, "B", r) for u, r in zip("stuv", b)] + extra
    df = spark.createDataFrame(given, "user string, item string, rating double")
    found = {(r.a, r.b): (r.n_common, r.similarity) for r in pair_similarity(df, heavy_rows=heavy_rows).collect()}
    assert found["A", "B"] == (4, pytest.approx(statistics.correlation(a, b), abs=1e-12))
    assert found["A", "A"] == (4 + bool(extra), 1.0)


def test_nearly_constant_and_constant_ratings(spark):
    from siftworks.operators.similarity import pair_similarity

    given = [(u, "A", 1e9 + u * 1e-3) for u in range(5)] + [(u, "B", float(u)) for u in range(5)]
    given += [(u, "C", 0.1) for u in range(5)] + [(9, "C", 0.7)]  # constant where it meets the others
    df = spark.createDataFrame(given, "user long, item string, rating double")
    found = {(r.a, r.b): r.similarity for r in pair_similarity(df).collect()}
    assert found.keys() == {("A", "A"), ("B", "B"), ("C", "C"), ("A", "B")}
    assert found["A", "B"] == pytest.approx(1.0, abs=1e-6)
