"""All pairs of items: moved as lists, whatever the groups and entities are like."""

import re
from itertools import product

import pytest
from conftest import rows
from pyspark.sql import functions as F

from siftworks.operators.ratings import co_pairs


def ratings(spark, kind):
    # users of 1 to 30 items; item 3 is rated by most, some rows come twice, some ids are NULL
    data = [(u, (u * 7 + i * i) % 41) for u in range(25) for i in range(u % 30)]
    data += [(u, 3) for u in range(60)] + data[:9] + [(None, 5), (None, 6), (4, None), (7, None)]
    df = spark.createDataFrame(data, "user long, item long")
    return df.select("user", F.expr(f"CAST(item AS {kind}) item"))


def expected(df):
    found, groups = set(), {}
    for u, i in ((r.user, r.item) for r in df.collect()):
        found.add((i, i))
        if u is not None and i is not None:
            groups.setdefault(u, set()).add(i)
    return found | {p for g in groups.values() for p in product(g, g)}


@pytest.mark.parametrize("kind", ["bigint", "string"])
@pytest.mark.parametrize("heavy_rows", [5000, 40, 8, 2])
def test_pairs_are_those_of_all_groups(spark, heavy_rows, kind):
    df = ratings(spark, kind)
    got = [tuple(r) for r in co_pairs(df, heavy_rows=heavy_rows).collect()]
    known = [p for p in got if p[0] is not None]
    assert len(known) == len(set(known)) and set(got) == expected(df)


def test_pairs_are_not_shuffled(spark):
    df = spark.range(3000).selectExpr("id % 60 user", "id * 7 % 90 item")
    plan = co_pairs(df)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(a#\d+L, \d+\)", plan)
    # what is dealt by both columns are the items with themselves
    assert len(re.findall(r"Exchange hashpartitioning\(a#\d+L, b#\d+L", plan)) <= 1
