"""Distance and similarity of documents to centroids.

``vectors`` is (doc_id, term, weight), ``centroids`` is (cluster, term, weight),
both sparse. The product of a document and a centroid needs only their common
terms; everything else comes from the two norms:
|x - c|^2 = |x|^2 + |c|^2 - 2 x.c

Products, ``nearest`` and its kin take ``operators.packed.Packed`` vectors as well, with centroids of their kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftworks.functions.skew import BROADCAST_ROWS
from siftworks.operators import packed
from siftworks.operators.packed import Centres, Packed
from siftworks.sources.shared import materialize

# Squared distances are rounded to this many places, distances too, before they are
# compared: sums in another order must not decide between two equally near centroids.
PLACES = 9

BY_CLUSTER = "map<int,double>"


def _by_cluster(value: str) -> Column:
    return F.map_from_entries(F.collect_list(F.struct(F.col("cluster").cast("int"), value)))


def common_terms(counts: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """(term): the terms of (term, df) in most rows, at most ``most`` of them, as a stored table to broadcast.

    All terms with the same ``df`` are in or out together, so only one row per number of documents is ranked.
    """
    by_count = counts.groupBy("df").agg(F.count("*").alias("_terms"))
    so_far = F.sum("_terms").over(W.orderBy(F.col("df").desc()))
    least = by_count.withColumn("_so_far", so_far).filter(F.col("_so_far") <= most).agg(F.min("df")).first()[0]
    chosen = counts.filter(F.col("df") >= least) if least is not None else counts.limit(0)
    return F.broadcast(materialize(chosen.select("term"), "common"))


def _met(
    vectors: DataFrame | Packed, centroids: DataFrame | Centres, shared: tuple[str, ...], common: DataFrame | None
) -> DataFrame:
    """(doc_id, cluster, _p): the products of the entries that a document and a centroid have in common."""
    if isinstance(vectors, Packed):
        return packed.met(vectors, centroids, shared)
    product = (F.col("weight") * F.col("_c")).alias("_p")
    renamed = centroids.withColumnRenamed("weight", "_c")
    if common is None:
        return vectors.join(renamed, [*shared, "term"]).select("doc_id", "cluster", product)
    theirs = F.struct("cluster", "_c", *[F.col(c).alias(f"_{c}") for c in shared if c != "cluster"])
    # one entry per centroid with the term
    known = renamed.join(common, "term", "left_semi").groupBy("term").agg(F.collect_list(theirs).alias("_all"))
    carried = [F.col(c).alias(f"_own_{c}") for c in shared]
    often = vectors.join(F.broadcast(known), "term").select("doc_id", "weight", *carried, F.inline("_all"))
    for c in shared:
        often = often.filter(F.col(f"_own_{c}") == F.col("cluster" if c == "cluster" else f"_{c}"))
    rare = vectors.join(common, "term", "left_anti")
    seldom = rare.join(renamed.join(common, "term", "left_anti"), [*shared, "term"])
    return often.select("doc_id", "cluster", product).unionByName(seldom.select("doc_id", "cluster", product))


def _products(
    vectors: DataFrame | Packed, docs: DataFrame, centroids: DataFrame | Centres, *shared: str, common: DataFrame | None = None
) -> DataFrame:
    """(doc_id, shared, doc_norm, dots, norms): one row per document.

    Documents meet only the centroids that agree with them in the ``shared`` columns,
    which all three tables have.

    ``dots`` has the products by cluster, ``norms`` the squared norms of the
    centroids; clusters that are missing in them have zero. Both have at most
    one entry per cluster. Where the vectors are partitioned by document and the
    centroids are broadcast, nothing here is shuffled. For centroids that are too large for that, ``common`` lists
    the terms of ``common_terms``: their part of the centroids is broadcast, and only entries of other terms are shuffled.
    """
    squares = F.sum(F.col("weight") * F.col("weight"))
    dots = (
        _met(vectors, centroids, shared, common)
        .groupBy("doc_id", "cluster")
        .agg(F.sum("_p").alias("_dot"))
        .groupBy("doc_id")
        .agg(_by_cluster("_dot").alias("_dots"))
    )
    if isinstance(vectors, Packed):
        doc_norms = vectors.norms.groupBy("doc_id").agg(F.sum("norm").alias("_doc"))
    else:
        doc_norms = vectors.groupBy("doc_id").agg(squares.alias("_doc"))
    if isinstance(centroids, Centres):
        norms = centroids.norms()
    else:
        norms = centroids.groupBy("cluster").agg(squares.alias("_norm")).agg(_by_cluster("_norm")).scalar()
    none = F.map_from_arrays(F.array(), F.array()).cast(BY_CLUSTER)
    return (
        docs.select("doc_id", *shared)
        .join(doc_norms, "doc_id", "left")
        .join(dots, "doc_id", "left")
        .select(
            "doc_id",
            *shared,
            F.coalesce("_doc", F.lit(0.0)).alias("doc_norm"),
            F.coalesce("_dots", none).alias("dots"),
            norms.alias("norms"),
        )
    )


def _at(values: str, cluster: Column) -> Column:
    return F.coalesce(F.try_element_at(F.col(values), cluster), F.lit(0.0))


def _clusters(k: int) -> Column:
    return F.sequence(F.lit(0), F.lit(k - 1))


def _square(cluster: Column) -> Column:
    square = F.col("doc_norm") + _at("norms", cluster) - 2 * _at("dots", cluster)
    return F.greatest(F.round(square, PLACES), F.lit(0.0))


def euclidean(vectors: DataFrame | Packed, docs: DataFrame, centroids: DataFrame | Centres, k: int) -> DataFrame:
    """(doc_id, cluster, sqdist, distance) for every document and cluster 0..k-1.

    ``docs`` lists all documents, so that those without terms take part as zero vectors.
    """
    entry = lambda c: F.struct(c.alias("cluster"), _square(c).alias("sqdist"))
    return (
        _products(vectors, docs, centroids)
        .select("doc_id", F.inline(F.transform(_clusters(k), entry)))
        .withColumn("distance", F.sqrt("sqdist"))
    )


def _choice(cluster: Column) -> Column:
    """Ordered as the nearest centroid is chosen: by rounded distance, then by id."""
    square = _square(cluster)
    return F.struct(F.round(F.sqrt(square), PLACES).alias("near"), cluster.alias("cluster"), square.alias("sqdist"))


def _nearest(products: DataFrame, candidates: Column) -> DataFrame:
    return products.select("doc_id", F.array_min(F.transform(candidates, _choice)).alias("_best")).select(
        "doc_id", "_best.cluster", F.sqrt("_best.sqdist").alias("distance"), "_best.sqdist"
    )


def nearest(
    vectors: DataFrame | Packed, docs: DataFrame, centroids: DataFrame | Centres, k: int, common: DataFrame | None = None
) -> DataFrame:
    """(doc_id, cluster, distance, sqdist): the nearest centroid, the lower id on a tie.

    The choice is made within the document's row.
    """
    return _nearest(_products(vectors, docs, centroids, common=common), _clusters(k))


def nearest_two(
    vectors: DataFrame | Packed, docs: DataFrame, centroids: DataFrame | Centres, k: int, common: DataFrame | None = None
) -> DataFrame:
    """(doc_id, cluster, sqdist, next_sqdist, doc_norm, top_norm): the choice of ``nearest``, and the second.

    ``next_sqdist`` is NULL if there is one centroid; ``top_norm`` is the largest squared norm of a centroid.
    """
    top = F.coalesce(F.array_max(F.map_values("norms")), F.lit(0.0))
    ranked = F.array_sort(F.transform(_clusters(k), _choice))
    return (
        _products(vectors, docs, centroids, common=common)
        .select("doc_id", "doc_norm", top.alias("top_norm"), ranked.alias("_ranked"))
        .select(
            "doc_id",
            F.col("_ranked")[0]["cluster"].alias("cluster"),
            F.col("_ranked")[0]["sqdist"].alias("sqdist"),
            F.get("_ranked", F.lit(1))["sqdist"].alias("next_sqdist"),
            "doc_norm",
            "top_norm",
        )
    )


def nearest_half(
    vectors: DataFrame | Packed, docs: DataFrame, centroids: DataFrame | Centres, common: DataFrame | None = None
) -> DataFrame:
    """As ``nearest``, between the two halves 2 * leaf and 2 * leaf + 1 of each document's leaf.

    ``vectors`` and ``docs`` have a column ``leaf``.
    """
    halves = F.array(2 * F.col("leaf"), 2 * F.col("leaf") + 1)
    own = centroids if isinstance(centroids, Centres) else centroids.withColumn("leaf", F.shiftright("cluster", 1))
    return _nearest(_products(vectors, docs, own, "leaf", common=common), halves)


def member_distances(
    vectors: DataFrame | Packed, members: DataFrame, centroids: DataFrame | Centres, common: DataFrame | None = None
) -> DataFrame:
    """(doc_id, cluster, sqdist) of (doc_id, cluster) rows to the centroid of their own cluster."""
    square = _square(F.col("cluster"))
    its = members.select("doc_id", "cluster")
    own = vectors.joined(its) if isinstance(vectors, Packed) else vectors.join(its, "doc_id")
    products = _products(own, members, centroids, "cluster", common=common)
    return products.select("doc_id", "cluster", square.alias("sqdist"))


def cosine(vectors: DataFrame | Packed, docs: DataFrame, centroids: DataFrame | Centres, k: int) -> DataFrame:
    """(doc_id, cluster, similarity); NULL where either vector is zero."""

    def entry(c: Column) -> Column:
        norm = F.sqrt("doc_norm") * F.sqrt(_at("norms", c))
        return F.struct(c.alias("cluster"), F.try_divide(_at("dots", c), norm).alias("similarity"))

    return _products(vectors, docs, centroids).select("doc_id", F.inline(F.transform(_clusters(k), entry)))
