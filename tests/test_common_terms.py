"""Joins by term that broadcast the part of the terms in most rows."""

from conftest import rows
from pyspark.sql import functions as F

from siftworks.operators import text, vectors


def test_common_terms_change_no_distance(spark):
    df = spark.range(900).selectExpr("id % 60 doc_id", "concat('t', cast(pow(id % 97, 1.5) % 41 as int)) term", "id % 7 + 0.5 weight")
    vecs = df.groupBy("doc_id", "term").agg(F.sum("weight").alias("weight"))
    docs = spark.range(62).select(F.col("id").alias("doc_id"), F.lit(0).alias("leaf"))
    centroids = vecs.filter("doc_id < 2").select(F.col("doc_id").cast("int").alias("cluster"), "term", "weight")
    counts = vecs.groupBy("term").agg(F.count("*").alias("df"))
    common = vectors.common_terms(counts, 10)
    assert 0 < common.count() <= 10 < counts.count()
    assert vectors.common_terms(counts, 0).count() == 0
    members = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("cluster"))
    leaves = vecs.withColumn("leaf", F.lit(0))
    for found in (
        lambda c: vectors.nearest(vecs, docs, centroids, 2, c),
        lambda c: vectors.nearest_half(leaves, docs, centroids, c),
        lambda c: vectors.member_distances(vecs, members, centroids, c),
    ):
        assert rows(found(common)) == rows(found(None))
    # documents are told apart by common terms without a shuffle of their entries by term
    plan = vectors.nearest(vecs, docs, centroids, 2, common)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [term" in plan


def test_tfidf_of_a_large_vocabulary(spark, monkeypatch):
    corpus = spark.range(40).selectExpr("id doc_id", "concat_ws(' ', 'a', 'b', concat('c', id % 5), concat('d', id)) text")
    whole = rows(text.tfidf(corpus))
    monkeypatch.setattr(text, "BROADCAST_ROWS", 5)
    monkeypatch.setattr(text, "common_terms", lambda counts: vectors.common_terms(counts, 5))
    assert rows(text.tfidf(corpus)) == whole
