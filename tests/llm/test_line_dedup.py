import hashlib
from collections import Counter

from llm_fixtures import docs  # noqa: F401
from siftworks.llm.line_dedup import drop_common_lines
from siftworks.llm.queries import QUERIES


def brute(texts, min_docs):
    split = [(t or "").split("\n") for t in texts]
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\f\r"))
    seen = Counter(k for ls in split for k in {key(x) for x in ls} if k)
    out = []
    for ls in split:
        left = [x for x in ls if seen[key(x)] < min_docs]
        out.append((len(ls), len(ls) - len(left), "\n".join(left)))
    return out


TEXTS = ["a\n Common \nb", "COMMON\t\nc", "x\ncommon", "É\ncommon", "é\nÉ", "", None, "\n\n", "a\na\na", "common\ncommon", " common"]


def test_brute_force(spark, docs):
    df = docs(*[(i, t) for i, t in enumerate(TEXTS)])
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in drop_common_lines(df, min_docs=3).collect()}
    assert [got[i] for i in range(len(TEXTS))] == brute(TEXTS, 3)
    assert got[0] == (3, 1, "a\nb") and got[6] == (1, 0, "") and got[9] == (2, 2, "")


def test_repeated_rows_and_null_ids_are_documents(spark, docs):
    df = docs(*[(None, "same\nown")] * 3, (1, "same"))
    out = drop_common_lines(df, min_docs=4).collect()
    assert sorted(r.kept_text for r in out) == ["", "own", "own", "own"]


def test_long_text_min_chars_and_clashing_columns(spark, docs):
    long = "\n".join(f"line {i}" for i in range(20_000)) + "\nhot"
    df = docs((1, long), (2, "hot"), (3, "ab\nhot")).selectExpr("*", "7 AS n_lines", "'k' AS kept_text", "1 AS extra")
    got = {r.doc_id: r for r in drop_common_lines(df, min_docs=3).collect()}
    assert (got[1].n_lines, got[1].n_dropped, got[1].extra) == (20_001, 1, 1)
    assert got[1].kept_text == long.removesuffix("\nhot")
    none = drop_common_lines(df.drop("kept_text"), min_docs=2, min_chars=4)
    assert sum(r.n_dropped for r in none.collect()) == 0


def test_empty_table_and_text_in_place(spark, docs):
    assert drop_common_lines(docs().limit(0)).count() == 0
    out = drop_common_lines(docs((1, "a\nb"), (2, "a")), min_docs=2, kept="text")
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(1, "b"), (2, "")] and out.columns.count("text") == 1


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = dict(zip(texts, brute(texts.values(), 10)))
    for r in QUERIES["op1_line_dedup"](spark, sf).collect():
        n, dropped, kept = want[r.doc_id]
        assert (r.n_lines, r.n_dropped, r.kept_sha256) == (n, dropped, hashlib.sha256(kept.encode()).hexdigest())
