import random
import tempfile

import pytest
from conftest import rows
from pyspark.sql import functions as F

from siftworks.operators.bloom import bloom_flags, bloom_quality
from siftworks.operators.hashtags import hashtag_counts, mean_length, top_hashtags
from siftworks.operators.reservoir import reservoir
from siftworks.sources.readers import read_stream
from siftworks.streaming.bloom import bloom_stream, last_report
from siftworks.streaming.bloom import report_log as bloom_log
from siftworks.streaming.reservoir import current_sample, report_log, reservoir_stream

SCHEMA = "event_id bigint, text string"


def texts(spark, n, start=0):
    return spark.range(start, start + n).select(
        F.col("id").alias("event_id"),
        F.concat(F.lit("u #t"), (F.col("id") * 7 % 11).cast("string"), F.lit(" #all,")).alias("text"),
    )


def arrive(df, folder):
    df.coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="siftworks-test-")


# --- hashtags and lengths ---


def test_hashtags(spark):
    data = [("#a,",), ("x #a\n#b y",), ("# z#c",), ("no tag",), ("#a #a",)]
    got = rows(hashtag_counts(spark.createDataFrame(data, "text string")))
    assert got == [("#", 1), ("#a", 3), ("#a#b", 1)]
    raw = rows(hashtag_counts(spark.createDataFrame(data, "text string"), clean=False))
    assert raw == [("#", 1), ("#a", 2), ("#a\n#b", 1), ("#a,", 1)]


def test_top_hashtags_break_ties_by_tag(spark):
    data = [("#b #a #c",), ("#c #d #e #f",)]
    assert rows(top_hashtags(spark.createDataFrame(data, "text string"), 3)) == [(1, "#c", 2), (2, "#a", 1), (3, "#b", 1)]


def test_length_counts_utf16_units(spark):
    df = spark.createDataFrame([("a\U0001f600",), ("abc",)], "text string")
    assert mean_length(df).first().mean_length == 3.0
    assert mean_length(df, utf16=False).first().mean_length == 2.5
    assert tuple(mean_length(df.limit(0)).first()) == (0, None)


# --- sample ---


def test_sample_size_and_merging(spark):
    df = texts(spark, 300)
    assert reservoir(df, 100).count() == 100
    assert reservoir(texts(spark, 99), 100).count() == 99
    parts = [reservoir(texts(spark, 100, s), 100) for s in (0, 100, 200)]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert rows(reservoir(merged, 100)) == rows(reservoir(df, 100))


def test_every_row_is_about_equally_likely(spark):
    hits = [0] * 40
    for seed in range(30):
        for r in reservoir(texts(spark, 40), 10, seed).collect():
            hits[r.event_id] += 1
    # 30 draws of one in four: mean 7.5
    assert sum(hits) == 300 and min(hits) >= 1 and max(hits) <= 18


@pytest.mark.parametrize("cuts", [(100,), (101,), (5, 95, 1, 60)])
def test_stream_sample_equals_batch_sample(spark, folder, cuts):
    start = 0
    for n in cuts:
        arrive(texts(spark, n, start), f"{folder}/in")
        start += n
    stream = read_stream(spark, f"{folder}/in", SCHEMA, max_files=1)
    reservoir_stream(stream, f"{folder}/out").awaitTermination()
    assert rows(current_sample(spark, f"{folder}/out")) == rows(reservoir(texts(spark, start)))
    log = rows(report_log(spark, f"{folder}/out"), "batch_id", "seen", "sample_size")
    assert len(log) == len(cuts) and log[-1][1:] == (start, min(100, start))


def test_stream_goes_on_after_a_restart(spark, folder):
    for start, n in ((0, 80), (80, 70), (150, 40)):
        arrive(texts(spark, n, start), f"{folder}/in")
        stream = read_stream(spark, f"{folder}/in", SCHEMA)
        reservoir_stream(stream, f"{folder}/out").awaitTermination()
        expected = reservoir(texts(spark, start + n))
        assert rows(current_sample(spark, f"{folder}/out")) == rows(expected)
        report = report_log(spark, f"{folder}/out").orderBy(F.col("batch_id").desc()).first()
        assert report.seen == start + n
        assert report.mean_length == pytest.approx(mean_length(expected).first().mean_length)
        assert report.top_tags == ",".join(r.tag for r in top_hashtags(expected).orderBy("rank").collect())


# --- Bloom filter ---


def positions(tag, width, num_hash):
    import hashlib

    return [int(hashlib.md5(f"{i}:{tag}".encode()).hexdigest()[:15], 16) % width for i in range(num_hash)]


def sequential(tags, width, num_hash):
    """One tag after the other against real bits and a real set."""
    bits, memory = set(), set()
    total = correct = fp = tn = 0
    for tag in tags:
        total += 1
        where = positions(tag, width, num_hash)
        exists = all(p in bits for p in where)
        if exists == (tag in memory):
            correct += 1
            if not exists:
                tn += 1
                memory.add(tag)
                bits.update(where)
        else:
            fp += 1
    return total, correct, total - correct, fp, tn, fp / (fp + tn) if fp + tn else 0.0


def random_tags(seed, n=60, kinds=12):
    rnd = random.Random(seed)
    return [f"#t{rnd.randrange(kinds)}" for _ in range(n)]


@pytest.mark.parametrize("seed,width,num_hash", [(1, 8, 2), (2, 16, 3), (3, 64, 6), (4, 8, 1)])
def test_quality_equals_the_sequential_filter(spark, seed, width, num_hash):
    tags = random_tags(seed)
    events = spark.createDataFrame(list(enumerate(tags, 1)), "seq bigint, tag string")
    got = bloom_quality(bloom_flags(events, width, num_hash)).first()
    assert tuple(got) == pytest.approx(sequential(tags, width, num_hash))


def test_quality_of_nothing(spark):
    events = spark.createDataFrame([], "seq bigint, tag string")
    assert tuple(bloom_quality(bloom_flags(events)).first()) == (0, 0, 0, 0, 0, 0.0)


@pytest.mark.parametrize("cuts", [(60,), (1, 30, 29), (20, 20, 20)])
def test_stream_filter_equals_the_sequential_filter(spark, folder, cuts):
    tags = random_tags(5, n=60, kinds=20)
    start = 0
    for i, n in enumerate(cuts):
        data = [(s, f"word {tags[s]}") for s in range(start, start + n)]
        random.Random(n).shuffle(data)
        arrive(spark.createDataFrame(data, SCHEMA), f"{folder}/in")
        start += n
        if i == 0:  # stop and start again in between
            stream = read_stream(spark, f"{folder}/in", SCHEMA, max_files=1)
            bloom_stream(stream, f"{folder}/out", ["event_id"], 16, 3).awaitTermination()
            assert tuple(last_report(spark, f"{folder}/out").first()) == pytest.approx(sequential(tags[:n], 16, 3))
    stream = read_stream(spark, f"{folder}/in", SCHEMA, max_files=1)
    bloom_stream(stream, f"{folder}/out", ["event_id"], 16, 3).awaitTermination()
    assert tuple(last_report(spark, f"{folder}/out").first()) == pytest.approx(sequential(tags, 16, 3))
    assert bloom_log(spark, f"{folder}/out").count() == len(cuts)


def test_a_batch_touches_only_the_tags_it_names(spark, folder):
    """The rows that a batch reads and the state rows it updates do not grow with the stream's age."""
    for i in range(4):
        # thirty new tags a batch, and one that comes again
        tags = ["#again", *[f"#n{i}-{j}" for j in range(30)]]
        arrive(spark.createDataFrame([(100 * i + j, t) for j, t in enumerate(tags)], SCHEMA), f"{folder}/in")
    stream = read_stream(spark, f"{folder}/in", SCHEMA, max_files=1)
    query = bloom_stream(stream, f"{folder}/out", ["event_id"], 1 << 20, 2)
    query.awaitTermination()
    batches = [p for p in query.recentProgress if p["numInputRows"]]
    assert [p["numInputRows"] for p in batches] == [31] * 4
    tags = [next(s for s in p["stateOperators"] if s["numRowsTotal"] > 31 * i and s["numRowsUpdated"] <= 31) for i, p in enumerate(batches)]
    assert all(s["numRowsUpdated"] <= 31 for s in tags)
    assert last_report(spark, f"{folder}/out").first().total == 124
    assert [r.total for r in bloom_log(spark, f"{folder}/out").orderBy("batch_id").collect()] == [31, 62, 93, 124]


def test_a_batch_run_again_gives_the_same_state(spark, folder):
    """What Spark does after a failure between writing the state and committing the batch."""
    import glob
    import os

    tags = random_tags(6, n=40, kinds=15)

    def feed(part):
        arrive(spark.createDataFrame([(s, tags[s]) for s in part], SCHEMA), f"{folder}/in")
        stream = read_stream(spark, f"{folder}/in", SCHEMA)
        bloom_stream(stream, f"{folder}/out", ["event_id"], 16, 3).awaitTermination()
        reservoir_stream(stream, f"{folder}/sample", k=10).awaitTermination()

    feed(range(0, 20))
    feed(range(20, 40))
    for out in ("out", "sample"):
        commits = f"{folder}/{out}/checkpoint/commits"
        for f in glob.glob(f"{commits}/1") + glob.glob(f"{commits}/.1.crc"):
            os.remove(f)
    stream = read_stream(spark, f"{folder}/in", SCHEMA)
    bloom_stream(stream, f"{folder}/out", ["event_id"], 16, 3).awaitTermination()
    reservoir_stream(stream, f"{folder}/sample", k=10).awaitTermination()
    assert tuple(last_report(spark, f"{folder}/out").first()) == pytest.approx(sequential(tags, 16, 3))
    everything = spark.createDataFrame(list(enumerate(tags)), SCHEMA)
    assert rows(current_sample(spark, f"{folder}/sample")) == rows(reservoir(everything, 10))


def test_events_in_a_folder_of_files_give_the_batch_result(spark, tmp_path):
    from catalog import QUERIES

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    for name, same in (("stream_reservoir", "reservoir_batch"), ("stream_bloom", "bloom_quality")):
        got, want = QUERIES[name](spark, str(tmp_path)).collect(), QUERIES[same](spark, str(tmp_path)).collect()
        assert sorted(got) == sorted(want) and got, name


def test_no_report_before_the_first_batch_is_zeros(spark, tmp_path):
    from siftworks.streaming.bloom import last_report

    assert tuple(last_report(spark, f"{tmp_path}/nothing").first()) == (0, 0, 0, 0, 0, 0.0)


def test_wide_filters_use_all_their_bits(spark):
    from pyspark.sql import functions as F

    from siftworks.functions.hashing import bit_position

    bits = spark.range(500).select(bit_position(F.col("id").cast("string"), 0, 1 << 40).alias("b"))
    assert bits.agg(F.max("b")).first()[0] > 1 << 39


def test_packed_pages_hold_what_was_put_in(spark):
    from siftworks.operators.bloom import bit_pages, maybe_seen, merge_pages

    width = 4_000_000_000
    tags = spark.range(300).selectExpr("concat('#', id) AS tag")
    parts = [bit_pages(tags.filter(f"length(tag) {c}"), width, 3) for c in ("< 4", ">= 4")]
    pages = merge_pages(*parts)
    assert rows(pages) == rows(bit_pages(tags, width, 3))
    assert pages.agg(F.max("page"), F.max(F.octet_length("bits"))).first()[1] == 4096
    assert pages.agg(F.max("page")).first()[0] > 100_000
    asked = tags.unionByName(spark.range(300, 600).selectExpr("concat('#', id) AS tag")).unionByName(tags)
    got = dict(rows(maybe_seen(asked, pages, width, 3)))
    assert len(got) == 600 and all(got[f"#{i}"] == (i < 300) for i in range(600))
    # a narrow filter against the bits one by one
    few = [f"#{i}" for i in range(40)]
    bits = {p for t in few for p in positions(t, 500, 3)}
    narrow = bit_pages(spark.createDataFrame([(t,) for t in few], "tag string"), 500, 3)
    got = dict(rows(maybe_seen(asked, narrow, 500, 3)))
    assert got == {f"#{i}": all(p in bits for p in positions(f"#{i}", 500, 3)) for i in range(600)}
    assert rows(maybe_seen(tags, narrow.limit(0), 500, 3)) == sorted((f"#{i}", False) for i in range(300))
