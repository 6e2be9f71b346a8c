"""What the physical plans must and must not contain."""

import glob
import os
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from siftworks.functions.ordering import global_position
from siftworks.functions.skew import blocked_join, blocked_self_pairs, self_pairs, split_heavy
from siftworks.operators import similarity, text
from siftworks.operators.kmeans import cluster_terms
from siftworks.operators.neighbours import item_neighbours
from siftworks.plans.recommend import item_cf, user_cf

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ratings(spark, n=2000):
    return spark.range(n).select(
        (F.col("id") % 50).alias("user"),
        (F.col("id") * 7 % 90).alias("item"),
        (F.col("id") % 5 + 1).cast("double").alias("rating"),
    ).dropDuplicates(["user", "item"])


@pytest.mark.parametrize("run", [item_cf, user_cf])
def test_recommendation_is_equi_joins_in_the_jvm(spark, run):
    p = plan(run(ratings(spark), ratings(spark).limit(50)))
    assert "Join" in p
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert bad not in p


def test_top_k_is_cut_before_the_shuffle(spark):
    r = ratings(spark)
    p = plan(item_neighbours(r, r, similarity.pair_similarity(r)))
    assert re.search(r"WindowGroupLimit .*Partial", p)
    v = spark.createDataFrame([(0, "a", 1.0)], "doc_id bigint, term string, weight double")
    m = spark.createDataFrame([(0, 0)], "doc_id bigint, cluster int")
    assert re.search(r"WindowGroupLimit .*Partial", plan(cluster_terms(v, m)))


def test_only_needed_columns_are_read(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    p = plan(text.idf(documents))
    assert "ReadSchema: struct<text:string>" in p and "Python" not in p
    assert p.count("Exchange hashpartitioning") == 1, "one shuffle, on the term"


def test_no_row_passes_a_single_partition_when_numbering(spark):
    p = plan(global_position(spark.range(1000).select(F.col("id")), ["id"]))
    # the only unpartitioned window runs over the sizes of the ranges
    assert p.count("Exchange SinglePartition") == 1
    got = global_position(spark.range(1000).select(F.col("id")), [F.col("id").desc()], "n", 1, partitions=7)
    assert rows(got, "n", "id") == [(i + 1, 999 - i) for i in range(1000)]


def test_a_hot_key_is_cut_into_blocks(spark):
    hot = spark.range(400).select(F.lit(1).alias("k"), F.col("id").alias("e"), (F.col("id") * 2).alias("v"))
    small = self_pairs(hot, "k", "e", ["v"])
    split = split_heavy(hot, "k", 50)
    assert split.n_heavy == 1 and split.light.count() == 0
    cut = blocked_self_pairs(split.heavy, split.sizes, "k", "e", ["v"], block_rows=50)
    assert cut.columns == small.columns == ["a", "b", "v_a", "v_b"]
    assert rows(cut) == rows(small) and rows(cut)[0] == (0, 1, 0, 2)
    flagged = hot.withColumn("w", F.col("e") % 10 == 0)
    some = self_pairs(flagged, "k", "e", ["v"], "w")
    ordered = sorted((min(a, b), max(a, b)) for a, b, _, _ in rows(some))
    assert ordered == [p[:2] for p in rows(small) if p[0] % 10 == 0 or p[1] % 10 == 0]
    assert all(a % 10 == 0 and (va, vb) == (2 * a, 2 * b) for a, b, va, vb in rows(some))
    heavy = split_heavy(flagged, "k", 50).heavy
    assert rows(blocked_self_pairs(heavy, split.sizes, "k", "e", ["v"], "w", 50)) == rows(some)
    left = hot.select("k", F.col("e").alias("x")).limit(120)
    right = hot.select("k", F.col("e").alias("y"))
    assert rows(blocked_join(left, right, split.sizes, "k", 30)) == rows(left.join(right, "k"))


def test_adaptive_execution_splits_a_skewed_dimension_join(spark):
    """TF-IDF joins a hot term to its one IDF row; the hot partition must be split."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        docs = spark.range(0, 40000, 1, 8).select(
            F.col("id").alias("doc_id"), F.concat(F.lit("the w"), (F.col("id") % 9000).cast("string")).alias("text")
        )
        df = text.tfidf(docs)
        assert df.groupBy().count().first()[0] == 80000
        out = df.select(F.sum("weight").alias("s"))
        out.collect()
        assert "skew=true" in plan(out)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_the_library_neither_collects_rows_nor_trusts_local_disks():
    for path in glob.glob(f"{HERE}/siftworks/**/*.py", recursive=True):
        if "/llm/" in path:
            continue
        source = open(path).read()
        for word in ("localCheckpoint", "toPandas", "crossJoin", ".rdd", "toLocalIterator"):
            assert word not in source, (path, word)
        # the components of a fitted mixture are the only thing collected
        assert source.count(".collect()") == (1 if path.endswith("models.py") else 0), path
