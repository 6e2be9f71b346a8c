"""Exact top-k search: norm buckets, and per bucket the pruning that its local cosine threshold pays for."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftworks.functions.ordering import global_position
from siftworks.sources.shared import materialize

# Vectors in a norm bucket, and queries that meet a bucket at once.
BUCKET_ROWS = 512
QUERY_ROWS = 512

# From this local cosine threshold on, single coordinates are worth looking at.
COORDINATE_FROM = 0.3

# Coordinates of the query that are compared, the largest ones.
FOCUS = 4

# Below this bound on |product| all sums are exact in doubles, below the second in 64-bit integers.
EXACT_DOUBLE, EXACT_LONG = 2.0**53, 2.0**63

# Stands for a NULL id, which sorts last.
NO_ID = 2**63 - 1

PARTIAL = "query_row long, query_id long, vec_id long, row long, score long"


def whole_numbers(vectors: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """(vec_id, v, norm) with ``v`` = floor(scale * x) as doubles holding whole numbers.

    Vectors that are NULL, empty, or hold NULL or non-finite components are left out.
    """
    x = F.col(embedding)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    v = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("double"))
    usable = vectors.filter(x.isNotNull() & (F.size(x) > 0)).filter(~bad)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))
    return usable.select(F.col(vec_id).alias("vec_id"), v.alias("v")).withColumn("norm", norm)


def bucketed(vectors: DataFrame, bucket_rows: int) -> DataFrame:
    """Number the vectors from the longest to the shortest and cut them into buckets of equal size.

    Equal lengths are spread by id, so very many equal vectors fill many buckets.
    """
    placed = global_position(vectors, [F.col("norm").desc(), F.col("vec_id"), F.xxhash64("v")], "row")
    return placed.withColumn("bucket", F.floor(F.col("row") / bucket_rows).cast("int"))


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact whole-number inner products; clipped to the range of a long if they exceed it."""
    bound = np.abs(q).max(initial=0.0) * np.abs(c).max(initial=0.0) * q.shape[1]
    if bound < EXACT_DOUBLE:
        return (q @ c.T).astype(np.int64)
    if bound < EXACT_LONG:
        return q.astype(np.int64) @ c.astype(np.int64).T
    big = [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in c] for x in q]
    return np.array([[min(max(s, -(2**63)), 2**63 - 1) for s in row] for row in big], dtype=np.int64).reshape(len(q), len(c))


def candidates(q: np.ndarray, norm: float, c: np.ndarray, norms: np.ndarray, threshold: float) -> np.ndarray:
    """Mask of the bucket's vectors that may reach ``threshold`` with the query.

    The local threshold t = threshold / (|q| max|c|) is the cosine that even the
    bucket's longest vector needs. Above 1 nothing can qualify. Small t prunes
    little by direction, so vectors are compared by length only. Otherwise each
    focus coordinate of a unit vector with cosine t lies within
    q_f t +- sqrt((1 - t^2) (1 - q_f^2)) if t exceeds |q_f|, which others must meet.
    """
    if threshold <= 0 or norm == 0:
        return np.ones(len(c), dtype=bool)
    slack = 1 + 1e-9
    need = threshold / norm
    keep = norms * slack >= need
    local = need / max(norms.max() * slack, 1e-300)
    if local > 1 or not keep.any():
        return np.zeros(len(c), dtype=bool)
    if local < COORDINATE_FROM:
        return keep
    unit = q / norm
    lengths = np.maximum(norms, 1e-300)
    for f in np.argsort(-np.abs(unit))[:FOCUS]:
        reach = np.sqrt(max(0.0, (1 - local * local) * (1 - unit[f] * unit[f]))) + 1e-9
        x = c[:, f] / lengths
        # the interval's end opposite to the query is open to 1 where the query's own direction lies inside it
        low = unit[f] * local - reach if local > -unit[f] else -1.0
        high = unit[f] * local + reach if local > unit[f] else 1.0
        keep &= (x >= low) & (x <= high)
    return keep


def _search(k: int):
    def search(key, queries: pd.DataFrame, bucket: pd.DataFrame) -> pd.DataFrame:
        c, norms = np.array(bucket["v"].tolist(), dtype=np.float64), bucket["norm"].to_numpy()
        rows, ids = bucket["row"].to_numpy(), bucket["vec_id"].to_numpy()
        out = []
        same = [(v.shape[0] == c.shape[1]) for v in queries["v"]] if len(c) else []
        for query in queries[same].itertuples(index=False) if len(c) else ():
            q = np.asarray(query.v, dtype=np.float64)
            at = np.flatnonzero(candidates(q, query.norm, c, norms, query.threshold) & (rows != query.row))
            if not len(at):
                continue
            scores = _products(q[None, :], c[at])[0]
            high = scores >= query.threshold
            at, scores = at[high], scores[high]
            order = np.lexsort((rows[at], ids[at], -scores))[:k]
            found = [np.full(len(order), query.row), np.full(len(order), query.vec_id), ids[at][order], rows[at][order], scores[order]]
            out.append(np.stack(found, axis=1))
        rows_out = np.concatenate(out) if out else np.empty((0, 5), dtype=np.int64)
        return pd.DataFrame(rows_out, columns=["query_row", "query_id", "vec_id", "row", "score"])

    return search


def _meet(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """Best ``k`` of each query in each bucket: blocks of queries against buckets, one task group each."""
    pair = ["block", "bucket"]
    left, right = queries.groupBy(*pair), vectors.groupBy(*pair)
    return left.cogroup(right).applyInPandas(_search(k), PARTIAL)


def top_k(
    vectors: DataFrame,
    is_query: str,
    k: int = 20,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    scale: int = 64,
    bucket_rows: int = BUCKET_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows with the highest inner products for each query row.

    Queries are the rows for which the SQL condition ``is_query`` on ``vec_id`` holds;
    candidates are all rows but the query's own (a NULL id is read as the largest long). Components become floor(scale * x);
    ties go to the smaller id, NULL ids last, then to the longer vector. All
    candidates are returned if there are fewer than ``k``. A repeated id is as many rows
    and queries. Vectors of different widths do not meet.

    A first pass over the bucket of the longest vectors gives each query a score
    that ``k`` rows reach; it prunes all buckets in the second. Both passes are
    exact: they skip only what cannot reach that score.
    """
    named = whole_numbers(vectors, vec_id, embedding, scale).withColumns(
        {"query": F.coalesce(F.expr(is_query), F.lit(False)), "vec_id": F.coalesce("vec_id", F.lit(NO_ID))}
    )
    stored = materialize(bucketed(named, bucket_rows), "norm_buckets")
    n_buckets = (stored.agg(F.max("bucket")).first()[0] or 0) + 1
    queries = materialize(
        global_position(stored.filter("query").select("row", "vec_id", "v", "norm"), ["row"], "place")
        .withColumn("block", F.floor(F.col("place") / query_rows).cast("int"))
        .drop("place"),
        "top_k_queries",
    )
    n_blocks = (queries.agg(F.max("block")).first()[0] or 0) + 1
    spread = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    vectors_met = stored.withColumn("block", spread)
    seeds = _meet(
        queries.withColumns({"threshold": F.lit(float("-inf")), "bucket": F.lit(0)}), vectors_met.filter("bucket = 0"), k
    )
    floors = materialize(
        seeds.groupBy("query_row").agg(F.when(F.count("*") >= k, F.min("score")).alias("threshold")), "top_k_floors"
    )
    ready = queries.join(floors, F.col("row") == F.col("query_row"), "left").select(
        # a score of many digits may be rounded up as a double
        *queries.columns,
        F.coalesce(F.expr("threshold - abs(threshold) * 1e-9D"), F.lit(float("-inf"))).alias("threshold"),
    )
    asked = ready.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(n_buckets - 1))))
    best = W.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id"), F.col("row"))
    return (
        _meet(asked, vectors_met, k)
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.when(F.col("vec_id") != NO_ID, F.col("vec_id")).alias("vec_id"), "score")
    )
