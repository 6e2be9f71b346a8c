import glob
import json
import tempfile

import pytest
from conftest import rows

from siftworks.operators.kmeans import cluster_report
from siftworks.plans import programs
from siftworks.plans.mining import apriori
from siftworks.sources import readers, writers
from siftworks.streaming import bloom, reservoir


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="siftworks-test-")


def put(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def lines(path):
    return [x for part in sorted(glob.glob(f"{path}/part-*")) for x in open(part).read().splitlines()]


def test_ratings_drop_every_header_line_and_extra_columns(spark, folder):
    path = put(f"{folder}/r.csv", "user_id,business_id,stars,x\nu1,b1,3,q\nuser_id,business_id,stars,x\nu2,b1,4.5,q\n")
    assert rows(readers.read_ratings(spark, path)) == [("u1", "b1", 3.0), ("u2", "b1", 4.5)]
    bad = put(f"{folder}/bad.csv", "user_id,business_id,stars\nu1,b1,many\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.read_ratings(spark, bad).collect()


def test_baskets_have_no_header_and_distinct_items(spark, folder):
    path = put(f"{folder}/b.csv", '0,ive\n0,casino,more,columns\n0,ive\n1,"ive\n')
    assert rows(readers.read_baskets(spark, path)) == [("0", "casino"), ("0", "ive"), ("1", '"ive')]


def test_corpus_has_one_document_per_line(spark, folder):
    path = put(f"{folder}/c.txt", "a b\n\nc,d \n")
    got = readers.read_corpus(spark, path).collect()
    assert sorted(r.text for r in got) == ["", "a b", "c,d "] and len({r.doc_id for r in got}) == 3


def test_streams_of_json(spark, folder):
    put(f"{folder}/a.json", '{"event_id": 1, "text": "x"}\n')
    put(f"{folder}/b.other", '{"event_id": 2, "text": "y"}\n')
    stream = readers.read_stream(spark, folder, "event_id bigint, text string", fmt="json", glob="*.json")
    q = stream.writeStream.format("memory").queryName("seen").trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows(spark.table("seen")) == [(1, "x")]


def test_predictions_are_ordered_as_strings(spark, folder):
    df = spark.createDataFrame([(10, 2, 1.5), (9, 1, 2.0), (10, 11, 3.0)], "user bigint, item bigint, prediction double")
    writers.write_predictions(df, f"{folder}/p")
    assert lines(f"{folder}/p") == ["10,11,3.0", "10,2,1.5", "9,1,2.0"]


def test_itemset_report_has_a_block_per_size(spark, folder):
    baskets = spark.createDataFrame([(b, x) for b in (1, 2) for x in "ab"], "basket bigint, item string")
    writers.write_itemset_report(apriori(baskets, 2), f"{folder}/i")
    assert lines(f"{folder}/i") == ["(a),(b)", "", "(a,b)", ""]


def test_cluster_reports(spark, folder):
    vectors = spark.createDataFrame([(0, "a", 1.0), (1, "a", 2.0)], "doc_id bigint, term string, weight double")
    members = spark.createDataFrame([(0, 0, 1.0), (1, 0, 0.5)], "doc_id bigint, cluster int, sqdist double")
    writers.write_cluster_report(cluster_report(vectors, members, 2), "K-Means", f"{folder}/k")
    (line,) = lines(f"{folder}/k")
    assert json.loads(line) == {
        "algorithm": "K-Means",
        "WSSE": 1.5,
        "clusters": [
            {"id": 0, "size": 2, "error": 1.5, "terms": ["a"]},
            {"id": 1, "size": 0, "error": 0.0, "terms": []},
        ],
    }
    mixture = spark.createDataFrame(
        [(0, 1.0, [0.5], [[2.0]])], "component int, weight double, mean array<double>, covariance array<array<double>>"
    )
    writers.write_mixture_report(mixture, f"{folder}/g")
    assert json.loads(lines(f"{folder}/g")[0])["clusters"] == [{"id": 0, "weight": 1.0, "mean": [0.5], "std": [[2.0]]}]


# --- whole programs ---


def test_recommendation_programs(spark, folder):
    header = "user_id,business_id,stars\n"
    rated = [(u, i, (u * i) % 5 + 1) for u in range(8) for i in range(8)]
    line = lambda r: f"u{r[0]},b{r[1]},{r[2]}\n"
    train = put(f"{folder}/train.csv", header + "".join(line(r) for r in rated if sum(r[:2]) % 4))
    test = put(f"{folder}/test.csv", header + "".join(line(r) for r in rated if not sum(r[:2]) % 4) + "new,b1,3\n")
    for program in (programs.item_based, programs.user_based):
        out = f"{folder}/{program.__name__}"
        found = program(spark, train, test, out)
        assert len(lines(out)) == 17 and lines(out)[0].startswith("new,b1,2.5")
        assert found.rmse.first().n == sum(r.n for r in found.histogram.collect()) == 17
    assert programs.model_based(spark, train, test, iters=3).rmse.first().n == 16


def test_itemset_program(spark, folder):
    path = put(f"{folder}/b.csv", "".join(f"{b},{x}\n" for b in range(4) for x in "abc"[: b + 1]))
    programs.frequent_itemsets(spark, path, 2, f"{folder}/out", partitions=2)
    assert lines(f"{folder}/out") == ["(a),(b),(c)", "", "(a,b),(a,c),(b,c)", "", "(a,b,c)", ""]


def test_clustering_programs(spark, folder):
    path = put(f"{folder}/c.txt", "".join(("sun moon\n", "fish sea\n")[i % 2] for i in range(10)))
    for feature in "WT":
        report = programs.cluster_lines(spark, path, feature, 2, 3, f"{folder}/{feature}")
        assert sum(r["size"] for r in report.collect()) == 10
    for kind, name in (("K", "K-Means"), ("B", "Bisecting K-Means")):
        programs.cluster_lines_with(spark, path, kind, 2, 3, f"{folder}/ml{kind}")
        written = json.loads(lines(f"{folder}/ml{kind}")[0])
        assert written["algorithm"] == name and len(written["clusters"]) == 2


def test_watching_programs(spark, folder):
    put(f"{folder}/a.json", "".join('{"event_id": %d, "text": "x #a #b"}\n' % i for i in range(5)))
    schema = "event_id bigint, text string"
    stream = readers.read_stream(spark, folder, schema, fmt="json", glob="*.json")
    out = tempfile.mkdtemp(prefix="siftworks-test-")
    watches = [
        programs.watch_sample(stream, f"{out}/sample", every="1 second"),
        programs.watch_hashtags(stream, f"{out}/bloom", ["event_id"], every="1 second"),
    ]
    for q in watches:
        q.processAllAvailable()
        q.stop()
    assert reservoir.current_sample(spark, f"{out}/sample").count() == 5
    assert tuple(bloom.last_report(spark, f"{out}/bloom").first()) == (10, 10, 0, 0, 2, 0.0)
