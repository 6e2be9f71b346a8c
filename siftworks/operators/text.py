"""Word counts, TF, IDF and vocabulary of a corpus ``(doc_id, text)``.

Vectors are long tables (doc_id, term, weight) of the non-zero entries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.functions.ordering import global_position
from siftworks.functions.skew import BROADCAST_ROWS
from siftworks.functions.text import tokens
from siftworks.operators import packed
from siftworks.operators.packed import Packed
from siftworks.operators.vectors import common_terms
from siftworks.sources.shared import materialize


def _terms(rows: DataFrame, tokens_: Column, *carry: str | Column) -> DataFrame:
    """One row per token. The outer form keeps Spark from testing the array, and so from
    splitting the text, once more before the rows are made."""
    return rows.select(*carry, F.explode_outer(tokens_).alias("term")).filter(F.col("term").isNotNull())


def term_counts(corpus: DataFrame) -> DataFrame:
    """(doc_id, term, n). A document's tokens meet in one map task, so equal ones combine there."""
    terms = _terms(corpus, tokens("text"), "doc_id")
    return terms.groupBy("doc_id", "term").agg(F.count("*").alias("n"))


def term_frequency(corpus: DataFrame) -> DataFrame:
    """(doc_id, term, tf): count over the number of tokens of the document."""
    split = corpus.select("doc_id", tokens("text").alias("_tokens"))
    terms = _terms(split, F.col("_tokens"), "doc_id", F.size("_tokens").alias("_size"))
    return (
        terms.groupBy("doc_id", "_size", "term")
        .agg(F.count("*").alias("_n"))
        .select("doc_id", "term", (F.col("_n") / F.col("_size")).alias("tf"))
    )


def _document_terms(corpus: DataFrame) -> DataFrame:
    """Each term once per document, made distinct within its row."""
    return _terms(corpus, F.array_distinct(tokens("text")))


def _weighed(corpus: DataFrame, occurrences: DataFrame) -> DataFrame:
    """(term, df, idf) from a table with one row per term and document."""
    n_docs = corpus.agg(F.count("*").alias("n")).scalar()
    return (
        occurrences.groupBy("term")
        .agg(F.count("*").alias("df"))
        .select("term", "df", (F.lit(1.0) + F.log(n_docs / F.col("df"))).alias("idf"))
    )


def idf(corpus: DataFrame) -> DataFrame:
    """(term, df, idf) with idf = 1 + ln(N / df).

    The only shuffle is that of the pre-aggregated count per term.
    """
    return _weighed(corpus, _document_terms(corpus))


def tfidf(corpus: DataFrame) -> DataFrame:
    """(doc_id, term, weight) with weight = tf * idf.

    The texts are split once, for the term frequencies, which are stored; document frequencies
    count their rows, so ``doc_id`` must be unique. The IDF table is stored too: the rows of a hot term can
    then be split over many tasks.
    """
    frequencies = materialize(term_frequency(corpus), "term_frequency")
    weights = materialize(_weighed(corpus, frequencies), "idf")
    weight = (F.col("tf") * F.col("idf")).alias("weight")
    if weights.count() <= BROADCAST_ROWS:
        # short enough for a broadcast, which is left to Spark, as is the split of a hot term where it decides against one
        return frequencies.join(weights, "term").select("doc_id", "term", weight)
    # the terms in most rows are met without a shuffle of these rows
    common = common_terms(weights)
    often = frequencies.join(F.broadcast(weights.join(common, "term", "left_semi")), "term")
    rare = frequencies.join(common, "term", "left_anti").join(weights.join(common, "term", "left_anti"), "term")
    return often.select("doc_id", "term", weight).unionByName(rare.select("doc_id", "term", weight))


def count_vectors(corpus: DataFrame) -> DataFrame:
    """Word counts as vectors: (doc_id, term, weight)."""
    return term_counts(corpus).select("doc_id", "term", F.col("n").cast("double").alias("weight"))


def features(corpus: DataFrame, feature: str) -> DataFrame:
    """Vectors of word counts (``"W"``) or of TF-IDF (``"T"``)."""
    kind = feature.upper()
    if kind not in ("W", "T"):
        raise ValueError("feature is 'W' (word count) or 'T' (TF-IDF)")
    return count_vectors(corpus) if kind == "W" else tfidf(corpus)


def packed_features(corpus: DataFrame, feature: str, k: int) -> tuple[DataFrame, Packed]:
    """``features`` as rows and packed for ``k`` centroids; ``doc_id`` must be unique.

    Tokens are counted where the text is, and only entries of terms without a number are shuffled, to meet their IDF.
    """
    kind = feature.upper()
    if kind not in ("W", "T"):
        raise ValueError("feature is 'W' (word count) or 'T' (TF-IDF)")
    weights = materialize(_weighed(corpus, _document_terms(corpus)), "idf")
    terms, n, all_ = packed.numbered(weights, k)
    factor = F.col("idf") if kind == "T" else F.lit(1.0)
    stored = materialize(packed.encode(corpus, terms, kind == "T"), "packed")
    rare = singles = alone = others = None
    if not all_:
        other = F.inline(F.arrays_zip(F.col("others").alias("term"), F.col("other_values").alias("_value")))
        its = weights.filter(F.col("df") < terms.agg(F.min("df")).scalar()) if n else weights
        weight = (F.col("_value") * factor).alias("weight")
        others = stored.select("doc_id", other).join(its, "term").select("doc_id", "term", weight, (F.col("df") == 1).alias("_one"))
        others = materialize(others, "others")
        rare, singles = others.filter("NOT _one").drop("_one"), others.filter("_one").drop("_one")
        alone = singles.groupBy("doc_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("alone"))
        alone = materialize(alone, "alone")
    factors = packed.factors_of(terms, "idf") if kind == "T" else None
    rows = stored.select("doc_id", "ids", "values")
    norms = packed.row_norms(rows, factors)
    if others is not None:
        norms = norms.unionByName(others.select("doc_id", (F.col("weight") * F.col("weight")).alias("norm")))
    norms = materialize(norms.groupBy("doc_id").agg(F.sum("norm").alias("norm")), "norms")
    entries = rows.select("doc_id", F.inline(F.arrays_zip(F.col("ids").alias("id"), F.col("values").alias("_value"))))
    often = entries.join(F.broadcast(terms), "id")
    vectors = often.select("doc_id", "term", (F.col("_value") * factor).alias("weight"))
    vectors = vectors if others is None else vectors.unionByName(others.drop("_one"))
    return vectors, Packed(rows, rare, norms, terms.select("term", "id"), n, factors, alone, singles)


def vocabulary(corpus: DataFrame) -> DataFrame:
    """(term, idx): the distinct terms numbered from 0 in ascending order."""
    # stored, as the sampling of the ranges would read and split the texts once more
    terms = materialize(_document_terms(corpus).distinct(), "terms")
    return global_position(terms, ["term"], "idx").select("term", "idx")
