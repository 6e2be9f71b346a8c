"""Sparse vectors as dense ones of a fixed width, by a seeded random projection of every entry."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Signs that one hash of a term gives: the digits of an MD5.
SIGNS_PER_HASH = 32


def project(vectors: DataFrame, docs: DataFrame, width: int = 16, seed: int = 42) -> DataFrame:
    """(doc_id, projection): the sum of weight * sign over all terms of a document, per dimension.

    The sign of a term in a dimension is a digit of a seeded hash of the term, so no matrix and no
    vocabulary is kept anywhere. Divided by sqrt(width), distances between documents are kept in the
    mean. Every entry of (doc_id, term, weight) takes part; documents without entries are zero
    vectors. The sums are one aggregate per document with ``width`` columns, and rows are not multiplied.
    """
    hashes = math.ceil(width / SIGNS_PER_HASH)
    hashed = vectors.select(
        "doc_id",
        "weight",
        *[F.md5(F.concat(F.lit(f"{seed}-{h}-"), "term").cast("binary")).alias(f"_h{h}") for h in range(hashes)],
    )

    def part(d: int) -> Column:
        digit = F.substring(f"_h{d // SIGNS_PER_HASH}", d % SIGNS_PER_HASH + 1, 1)
        return F.sum(F.when(digit >= "8", F.col("weight")).otherwise(-F.col("weight"))) / F.lit(math.sqrt(width))

    sums = hashed.groupBy("doc_id").agg(*[part(d).alias(f"_p{d}") for d in range(width)])
    zero = F.lit(0.0)
    dense = F.array(*[F.coalesce(f"_p{d}", zero) for d in range(width)])
    return docs.select("doc_id").join(sums, "doc_id", "left").select("doc_id", dense.alias("projection"))
