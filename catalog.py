"""The registered queries: every operator over the whole given tables.

Doubles are rounded here, at the edge, and nowhere inside the operators.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.operators import (
    bloom,
    evaluation,
    factors,
    hashtags,
    itemsets,
    kmeans,
    models,
    neighbours,
    projection,
    ratings,
    similarity,
    text,
    vectors,
)
from siftworks.operators.packed import Centres, Packed
from siftworks.operators.reservoir import reservoir
from siftworks.plans import clustering, mining, recommend
from siftworks.sources import testviews as views
from siftworks.sources.readers import read_baskets, read_corpus, read_ratings, read_stream
from siftworks.sources.shared import ROWS_PER_PARTITION, materialize, new_path
from siftworks.sources.writers import write_cluster_report, write_itemset_report, write_predictions
from siftworks.streaming import bloom as bloom_streams
from siftworks.streaming import reservoir as reservoir_streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


# --- ratings and recommendation ---


@query
def ratings_load(spark, sf):
    return views.ratings(spark, sf)


@query
def ratings_csv(spark, sf):
    """The ratings written as CSV with a header and read back."""
    path = new_path(spark, "ratings-csv")
    views.ratings(spark, sf).write.option("header", True).csv(path)
    read = read_ratings(spark, path)
    return read.select(F.col("user").cast("bigint"), F.col("item").cast("bigint"), "rating")


@query
def known_test_rows(spark, sf):
    train, test = views.split_ratings(spark, sf)
    return ratings.known_rows(test, train)


@query
def user_histories(spark, sf):
    h = ratings.histories(views.ratings(spark, sf), by="user", chunk=20)
    entry = lambda e: F.concat(
        e["item"].cast("string"), F.lit(":"), e["rating"].cast("int").cast("string")
    )
    return h.select("user", "part", "n", F.array_join(F.transform("entries", entry), ",").alias("items"))


@query
def user_means(spark, sf):
    return rounded(ratings.user_means(views.ratings(spark, sf)), "mean")


@query
def loo_user_mean(spark, sf):
    return rounded(ratings.leave_one_out_mean(views.ratings(spark, sf)), "loo_mean")


@query
def item_pairs(spark, sf):
    return ratings.co_pairs(views.split_ratings(spark, sf)[0], entity="item", other="user")


@query
def user_pairs(spark, sf):
    train, test = views.split_ratings(spark, sf)
    return ratings.test_user_pairs(test, train)


@query
def item_similarity(spark, sf):
    train, _ = views.split_ratings(spark, sf)
    return rounded(similarity.pearson_similarity(train, "item", min_sim=0.01), "similarity")


@query
def user_similarity(spark, sf):
    train, test = views.split_ratings(spark, sf)
    pairs = ratings.test_user_pairs(test, train).select(
        F.col("user").alias("a"), F.col("neighbour").alias("b")
    )
    return rounded(similarity.pearson_similarity(train, "user", pairs=pairs, min_sim=0.3), "similarity")


@query
def cf_item_neighbours(spark, sf):
    train, test = views.split_ratings(spark, sf)
    sim = similarity.pair_similarity(train, "item", min_sim=0.01)
    return rounded(neighbours.item_neighbours(test, train, sim), "similarity")


@query
def cf_user_neighbours(spark, sf):
    train, test = views.split_ratings(spark, sf)
    sim = similarity.pair_similarity(train, "user", min_sim=0.3)
    known = ratings.known_rows(test, train, need_item=True)
    return rounded(neighbours.user_neighbours(known, train, sim), "similarity")


@query
def cf_item_neighbours_desc(spark, sf):
    train, test = views.split_ratings(spark, sf)
    sim = similarity.pair_similarity(train, "item", min_sim=0.01)
    return rounded(neighbours.item_neighbours(test, train, sim, order="desc"), "similarity")


@query
def cf_item_predictions(spark, sf):
    train, test = views.split_ratings(spark, sf)
    predicted = recommend.item_predictions(train, test)
    return rounded(predicted.select("user", "item", "prediction"), "prediction")


@query
def predictions_csv(spark, sf):
    """The scored test rows written as a prediction file and read back."""
    path = new_path(spark, "predictions-csv")
    train, test = views.split_ratings(spark, sf)
    write_predictions(recommend.item_cf(train, test), path)
    written = spark.read.schema("user bigint, item bigint, prediction double").csv(path)
    return rounded(written, "prediction")


@query
def cf_user_predictions(spark, sf):
    train, test = views.split_ratings(spark, sf)
    return rounded(recommend.user_predictions(train, test), "prediction", "user_mean")


@query
def cf_item_scored(spark, sf):
    train, test = views.split_ratings(spark, sf)
    return rounded(recommend.item_cf(train, test), "prediction", "abs_err")


@query
def cf_user_scored(spark, sf):
    train, test = views.split_ratings(spark, sf)
    return rounded(recommend.user_cf(train, test), "prediction", "abs_err")


@query
def rating_error_histogram(spark, sf):
    train, test = views.split_ratings(spark, sf)
    return evaluation.error_histogram(recommend.item_cf(train, test))


@query
def rating_error_histogram_user(spark, sf):
    train, test = views.split_ratings(spark, sf)
    return evaluation.error_histogram(recommend.user_cf(train, test))


@query
def rating_rmse(spark, sf):
    train, test = views.split_ratings(spark, sf)
    return rounded(evaluation.rmse(recommend.item_cf(train, test)), "rmse")


@query
def rating_rmse_user(spark, sf):
    train, test = views.split_ratings(spark, sf)
    return rounded(evaluation.rmse(recommend.user_cf(train, test)), "rmse")


# Groups above this many rows take the heavy route in the queries below; the given tables have some.
HEAVY = 20


@query
def cf_item_scored_heavy(spark, sf):
    train, test = views.split_ratings(spark, sf)
    return rounded(recommend.item_cf(train, test, heavy_rows=HEAVY), "prediction", "abs_err")


@query
def cf_user_scored_heavy(spark, sf):
    train, test = views.split_ratings(spark, sf)
    return rounded(recommend.user_cf(train, test, heavy_rows=HEAVY), "prediction", "abs_err")


# --- frequent itemsets ---


def support_of(baskets: DataFrame, share: float) -> float:
    """An absolute support from a share of the baskets."""
    return share * baskets.select("basket").distinct().count()


def joined_items(df: DataFrame) -> DataFrame:
    return df.withColumn("items", F.array_join("items", ","))


@query
def baskets_load(spark, sf):
    return views.baskets(spark, sf)


@query
def baskets_csv(spark, sf):
    """The baskets written as CSV without a header and read back."""
    path = new_path(spark, "baskets-csv")
    views.baskets(spark, sf).write.csv(path)
    return read_baskets(spark, path).select(F.col("basket").cast("bigint"), "item")


@query
def itemset_candidates_k2(spark, sf):
    b = views.stored_baskets(spark, sf)
    singles = itemsets.frequent_items(b, support_of(b, 0.025))
    return joined_items(itemsets.apriori_candidates(singles, 2))


@query
def itemset_candidates_k3(spark, sf):
    b = views.stored_baskets(spark, sf)
    pairs = itemsets.mine_levels(b, support_of(b, 0.025), max_k=2)[1]
    return joined_items(itemsets.apriori_candidates(pairs, 3))


@query
def frequent_itemsets_k1(spark, sf):
    b = views.stored_baskets(spark, sf)
    return joined_items(itemsets.frequent_items(b, support_of(b, 0.005)))


@query
def frequent_itemsets_k2(spark, sf):
    b = views.stored_baskets(spark, sf)
    s = support_of(b, 0.025)
    candidates = itemsets.apriori_candidates(itemsets.frequent_items(b, s), 2)
    return joined_items(itemsets.frequent_level(b, candidates, s))


@query
def frequent_itemsets_k3(spark, sf):
    b = views.stored_baskets(spark, sf)
    s = support_of(b, 0.005)
    candidates = itemsets.apriori_candidates(itemsets.mine_levels(b, s, max_k=2)[1], 3)
    return joined_items(itemsets.frequent_level(b, candidates, s))


@query
def frequent_itemsets_all(spark, sf):
    b = views.stored_baskets(spark, sf)
    return joined_items(mining.apriori(b, support_of(b, 0.005)))


@query
def frequent_itemsets_heavy(spark, sf):
    """Baskets of more than six frequent items take the heavy route."""
    b = views.stored_baskets(spark, sf)
    return joined_items(mining.apriori(b, support_of(b, 0.005), heavy_rows=6))


@query
def son_frequent_itemsets(spark, sf):
    b = views.stored_baskets(spark, sf)
    return joined_items(mining.son(b, support_of(b, 0.005), partitions=4))


@query
def itemset_report(spark, sf):
    b = views.stored_baskets(spark, sf)
    return itemsets.itemset_report(mining.apriori(b, support_of(b, 0.005)), per_line=100)


@query
def itemset_report_file(spark, sf):
    """The report written as text and read back, the empty lines between sizes included."""
    path = new_path(spark, "itemset-report")
    b = views.stored_baskets(spark, sf)
    write_itemset_report(mining.apriori(b, support_of(b, 0.005)), path, per_line=100)
    return spark.read.text(path).select(F.col("value").alias("line"))


# --- text features ---


@query
def corpus_lines(spark, sf):
    """Each text as one line of a text file, read back as a corpus; ids are unique but not fixed."""
    path = new_path(spark, "corpus")
    line = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\r\n]+", " ")
    views.corpus(spark, sf).select(line.alias("value")).write.text(path)
    read = materialize(read_corpus(spark, path), "corpus")
    return read.groupBy("text").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("n_ids"))


@query
def term_counts(spark, sf):
    return text.term_counts(views.corpus(spark, sf))


@query
def term_frequency(spark, sf):
    return rounded(text.term_frequency(views.corpus(spark, sf)), "tf", places=9)


@query
def idf(spark, sf):
    return rounded(text.idf(views.corpus(spark, sf)), "idf")


@query
def tfidf(spark, sf):
    return rounded(text.tfidf(views.corpus(spark, sf)), "weight", places=9)


@query
def vocabulary(spark, sf):
    return text.vocabulary(views.corpus(spark, sf))


# --- clustering ---

CLUSTERS = 5
SEED = 42


def started(spark: SparkSession, sf: str) -> tuple[Packed, DataFrame, Centres]:
    """(vectors, docs, start centroids) of the corpus."""
    corpus = views.corpus(spark, sf)
    docs = corpus.select("doc_id")
    _, vecs = clustering.packed_corpus(corpus, "T", CLUSTERS)
    return vecs, docs, kmeans.init_centroids(vecs, docs, CLUSTERS, SEED)


def two_rounds(spark: SparkSession, sf: str) -> clustering.Clustering:
    return clustering.cluster_corpus(views.corpus(spark, sf), "T", CLUSTERS, iters=2, seed=SEED)


@query
def doc_centroid_distance(spark, sf):
    vecs, docs, start = started(spark, sf)
    measured = vectors.euclidean(vecs, docs, start, CLUSTERS)
    return rounded(measured.select("doc_id", "cluster", "distance"), "distance")


@query
def doc_cosine_similarity(spark, sf):
    vecs, docs, start = started(spark, sf)
    return rounded(vectors.cosine(vecs, docs, start, CLUSTERS), "similarity")


@query
def kmeans_init(spark, sf):
    return kmeans.choose_start(views.corpus(spark, sf), CLUSTERS, SEED)


@query
def kmeans_assign(spark, sf):
    vecs, docs, start = started(spark, sf)
    return rounded(kmeans.assign(vecs, docs, start, CLUSTERS).drop("sqdist"), "distance")


@query
def kmeans_update(spark, sf):
    vecs, docs, start = started(spark, sf)
    nearest = materialize(kmeans.assign(vecs, docs, start, CLUSTERS), "assignment")
    return rounded(kmeans.update_centroids(vecs, nearest, start).frame(vecs), "weight", places=9)


@query
def kmeans_shift(spark, sf):
    vecs, docs, start = started(spark, sf)
    nearest = materialize(kmeans.assign(vecs, docs, start, CLUSTERS), "assignment")
    means = kmeans.update_centroids(vecs, nearest, start)
    return rounded(kmeans.centroid_shift(start.frame(vecs), means.frame(vecs)), "l1")


@query
def kmeans_iter1(spark, sf):
    found = clustering.cluster_corpus(views.corpus(spark, sf), "T", CLUSTERS, iters=1, seed=SEED)
    return found.assignment.select("doc_id", "cluster")


@query
def kmeans_iter2(spark, sf):
    return two_rounds(spark, sf).assignment.select("doc_id", "cluster")


@query
def kmeans_iter2_counts(spark, sf):
    found = clustering.cluster_corpus(views.corpus(spark, sf), "W", CLUSTERS, iters=2, seed=SEED)
    return found.assignment.select("doc_id", "cluster")


@query
def kmeans_sse(spark, sf):
    return rounded(kmeans.sse(two_rounds(spark, sf).assignment, CLUSTERS), "error")


@query
def kmeans_wsse(spark, sf):
    return rounded(kmeans.wsse(two_rounds(spark, sf).assignment), "wsse")


@query
def cluster_sizes(spark, sf):
    return kmeans.cluster_sizes(two_rounds(spark, sf).assignment, CLUSTERS)


@query
def cluster_terms(spark, sf):
    found = two_rounds(spark, sf)
    return kmeans.cluster_terms(found.vectors, found.assignment)


def reported(found: clustering.Clustering) -> DataFrame:
    report = kmeans.cluster_report(found.vectors, found.assignment, CLUSTERS)
    return rounded(report.withColumn("terms", F.array_join("terms", ",")), "error")


@query
def cluster_report(spark, sf):
    return reported(two_rounds(spark, sf))


@query
def cluster_report_file(spark, sf):
    """The report written as JSON and read back."""
    path = new_path(spark, "cluster-report")
    found = two_rounds(spark, sf)
    write_cluster_report(kmeans.cluster_report(found.vectors, found.assignment, CLUSTERS), "K-Means", path)
    schema = "algorithm string, WSSE double, clusters array<struct<id:int,size:bigint,error:double,terms:array<string>>>"
    read = spark.read.schema(schema).json(path)
    rows = read.select("algorithm", F.col("WSSE").alias("wsse"), F.inline("clusters"))
    return rounded(rows.withColumn("terms", F.array_join("terms", ",")), "wsse", "error")


# --- Spark ML ---


@query
def als_rows(spark, sf):
    """The test rows that have a prediction; all predictions are numbers."""
    train, test = views.split_ratings(spark, sf)
    known = models.als_cf(train, test)
    return known.filter(F.col("prediction").isNotNull() & ~F.isnan("prediction")).select("user", "item", "rating")


@query
def als_predictions(spark, sf):
    train, test = views.split_ratings(spark, sf)
    return models.als_cf(train, test)


@query
def als_error_histogram(spark, sf):
    train, test = views.split_ratings(spark, sf)
    return evaluation.error_histogram(models.with_error(models.als_cf(train, test)))


@query
def als_rmse(spark, sf):
    train, test = views.split_ratings(spark, sf)
    return evaluation.rmse(models.with_error(models.als_cf(train, test)))


def factor_columns(df: DataFrame, entity: str) -> DataFrame:
    parts = [F.get("factors", F.lit(i)).alias(f"f{i}") for i in range(3)]
    return rounded(df.select(entity, "n", *parts), "f0", "f1", "f2")


@query
def als_half_step(spark, sf):
    """The factors of all users that fit start factors of the items best."""
    train, _ = views.split_ratings(spark, sf)
    return factor_columns(factors.half_step(train, factors.hashed_start(train, "item"), "user", "item"), "user")


@query
def als_round(spark, sf):
    """A whole round: users from the start factors of the items, then items from these users."""
    train, _ = views.split_ratings(spark, sf)
    users = factors.half_step(train, factors.hashed_start(train, "item"), "user", "item")
    return factor_columns(factors.half_step(train, users, "item", "user"), "item")


@query
def als_fitted(spark, sf):
    """(n_users, n_off): the fitted factors of all users, and those that do not solve their normal equations.

    Spark ML keeps factors in single precision.
    """
    train, _ = views.split_ratings(spark, sf)
    fitted = models.fit_als(train)
    found = factors.residuals(train, fitted.factors("user"), fitted.factors("item"))
    return found.agg(F.count("*").alias("n_users"), F.count(F.when(F.col("residual") > 0.0001, 1)).alias("n_off"))


def embedded(spark: SparkSession, sf: str) -> DataFrame:
    return models.dense_features(views.table(spark, sf, "embeddings"), "vec_id", "embedding")


@query
def ml_kmeans(spark, sf):
    f = embedded(spark, sf)
    model = models.kmeans_model(f, 10, 20, SEED)
    return kmeans.sse(models.member_distances(model, f, "vec_id"), len(model.clusterCenters()))


@query
def ml_bisecting_kmeans(spark, sf):
    f = embedded(spark, sf)
    model = models.bisecting_model(f, 10, 20, SEED)
    return kmeans.sse(models.member_distances(model, f, "vec_id"), len(model.clusterCenters()))


@query
def ml_kmeans_text(spark, sf):
    found = clustering.cluster_corpus_with(views.corpus(spark, sf), "K", CLUSTERS, iters=10, seed=SEED)
    return reported(found)


@query
def ml_bisecting_kmeans_text(spark, sf):
    found = clustering.cluster_corpus_with(views.corpus(spark, sf), "B", CLUSTERS, iters=10, seed=SEED)
    return reported(found)


@query
def ml_gmm(spark, sf):
    return models.gaussian_mixture(embedded(spark, sf), 3, 10, SEED)


def cluster_totals(clusters: DataFrame) -> DataFrame:
    """(n_rows, n_bad): all members, and clusters whose error is no number or below zero."""
    error = F.col("error")
    bad = error.isNull() | F.isnan(error) | (error < 0)
    return clusters.agg(F.sum("size").alias("n_rows"), F.count(F.when(bad, 1)).alias("n_bad"))


@query
def ml_kmeans_totals(spark, sf):
    return cluster_totals(ml_kmeans(spark, sf))


@query
def ml_bisecting_kmeans_totals(spark, sf):
    return cluster_totals(ml_bisecting_kmeans(spark, sf))


def mixture_moments(components: DataFrame) -> DataFrame:
    """(i, j, mean, moment): what a mixture keeps of the data in every round of its fit.

    The weighted means of the components are the column means, and weighted covariances plus
    products of means are the second moments.
    """
    cells = components.select("component", "weight", "mean", F.posexplode("covariance").alias("i", "_row")).select(
        "component", "weight", "mean", "i", F.posexplode("_row").alias("j", "_cov")
    )
    at = lambda c: F.get("mean", F.col(c))
    moments = cells.groupBy("i", "j").agg(
        F.sum(F.col("weight") * at("i")).alias("mean"),
        F.sum(F.col("weight") * (F.col("_cov") + at("i") * at("j"))).alias("moment"),
    )
    # no negative zeros
    return moments.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in ("mean", "moment")})


@query
def ml_gmm_moments(spark, sf):
    return mixture_moments(models.gaussian_mixture(embedded(spark, sf), 3, 10, SEED))


@query
def text_projection(spark, sf):
    """(doc_id, dim, value): the TF-IDF vectors of all texts in sixteen dimensions."""
    corpus = views.corpus(spark, sf)
    dense = projection.project(text.tfidf(corpus), corpus)
    cells = dense.select("doc_id", F.posexplode("projection").alias("dim", "value"))
    return cells.withColumn("value", F.round("value", 6) + F.lit(0.0))


@query
def ml_gmm_text(spark, sf):
    return clustering.mixture_of_corpus(views.corpus(spark, sf), 3, 10, seed=SEED)


@query
def ml_gmm_text_moments(spark, sf):
    return mixture_moments(ml_gmm_text(spark, sf))


# --- samples and streams ---

BLOOM = {"width": 4096, "num_hash": 6}


@query
def hashtag_counts(spark, sf):
    return hashtags.hashtag_counts(views.status_texts(spark, sf))


@query
def top_hashtags(spark, sf):
    return hashtags.top_hashtags(views.status_texts(spark, sf))


@query
def reservoir_batch(spark, sf):
    return reservoir(views.status_texts(spark, sf).select("event_id", "text"))


@query
def sample_mean_length(spark, sf):
    return rounded(hashtags.mean_length(reservoir(views.status_texts(spark, sf))), "mean_length")


@query
def sample_top_hashtags(spark, sf):
    return hashtags.top_hashtags(reservoir(views.status_texts(spark, sf)))


@query
def bloom_flags(spark, sf):
    return bloom.bloom_flags(views.tagged_events(spark, sf), **BLOOM)


@query
def bloom_quality(spark, sf):
    return rounded(bloom.bloom_quality(bloom.bloom_flags(views.ordered_events(spark, sf), **BLOOM)), "fpr")


@query
def bloom_quality_one_hash(spark, sf):
    flags = bloom.bloom_flags(views.ordered_events(spark, sf), width=2048, num_hash=1)
    return rounded(bloom.bloom_quality(flags), "fpr")


@query
def bloom_membership(spark, sf):
    """A filter of packed pages that holds the tags more frequent than the mean, asked for all tags."""
    tags = views.ordered_events(spark, sf).groupBy("tag").agg(F.count("*").alias("n"))
    tags = materialize(tags, "tag_counts")
    frequent = tags.join(tags.agg(F.avg("n").alias("mean")), F.col("n") > F.col("mean"))
    pages = materialize(bloom.bit_pages(frequent, **BLOOM), "pages")
    return bloom.maybe_seen(tags, pages, **BLOOM)


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a stream; its files arrive in one micro-batch or several.

    The table is a file or a folder of files; a pattern stands for either, where the
    plain path of a single file would be taken for a folder.
    """
    schema = views.table(spark, sf, "events").schema
    return read_stream(spark, f"{sf}/events.parque[t]", schema)


@query
def stream_reservoir(spark, sf):
    location = new_path(spark, "reservoir")
    texts = event_stream(spark, sf).select("event_id", views.status_text().alias("text"))
    reservoir_streams.reservoir_stream(texts, location).awaitTermination()
    return reservoir_streams.current_sample(spark, location)


@query
def stream_reservoir_report(spark, sf):
    location = new_path(spark, "reservoir")
    texts = event_stream(spark, sf).select("event_id", views.status_text().alias("text"))
    reservoir_streams.reservoir_stream(texts, location).awaitTermination()
    log = reservoir_streams.report_log(spark, location)
    # the number and size of micro-batches depend on the files: report the last one
    last = log.orderBy(F.col("batch_id").desc()).limit(1).drop("batch_id")
    return rounded(last, "mean_length")


@query
def stream_bloom(spark, sf):
    location = new_path(spark, "bloom")
    tagged = event_stream(spark, sf).select("ts", "event_id", views.event_tag().alias("text"))
    bloom_streams.bloom_stream(tagged, location, ["ts", "event_id"], **BLOOM).awaitTermination()
    return rounded(bloom_streams.last_report(spark, location), "fpr")


def event_files(spark: SparkSession, sf: str) -> str:
    """The events in order of time, cut into files of bounded size by one job."""
    path = new_path(spark, "events")
    events = views.table(spark, sf, "events")
    files = max(4, math.ceil(events.count() / ROWS_PER_PARTITION))
    events.repartitionByRange(files, "ts", "event_id").write.parquet(path)
    in_order(spark, path)
    return path


def in_order(spark: SparkSession, path: str) -> None:
    """Give the part files of a folder times in the order of their numbers, which is that in which a stream reads them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted((f.getPath().getName(), f) for f in system.listStatus(folder) if f.getPath().getName().startswith("part-"))
    first = min((f.getModificationTime() for _, f in parts), default=0)
    for i, (_, f) in enumerate(parts):
        system.setTimes(f.getPath(), first - 1000 * (len(parts) - i), -1)


def batched_events(spark: SparkSession, sf: str) -> DataFrame:
    """The events as a stream of several micro-batches, one file each."""
    schema = views.table(spark, sf, "events").schema
    return read_stream(spark, event_files(spark, sf), schema, max_files=1)


@query
def stream_reservoir_batches(spark, sf):
    location = new_path(spark, "reservoir")
    texts = batched_events(spark, sf).select("event_id", views.status_text().alias("text"))
    reservoir_streams.reservoir_stream(texts, location).awaitTermination()
    return reservoir_streams.current_sample(spark, location)


@query
def stream_bloom_batches(spark, sf):
    location = new_path(spark, "bloom")
    tagged = batched_events(spark, sf).select("ts", "event_id", views.event_tag().alias("text"))
    bloom_streams.bloom_stream(tagged, location, ["ts", "event_id"], **BLOOM).awaitTermination()
    return rounded(bloom_streams.last_report(spark, location), "fpr")
