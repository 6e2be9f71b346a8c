import re
from collections import Counter

from llm_fixtures import docs  # noqa: F401
from siftworks.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def naive(text):
    t = text or ""
    w = WORD.findall(t)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + o for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for o in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
TEXTS = [None, "", " \n\t ", "a b c a b c", "a a a a", "one two", "x\nx\n\n \nx", "é#*$ %&|<> z", "a b c d a b c e " * 40, "q " * 49, "\x0ba\x0c"]


def test_measures(spark, docs):
    df = docs(*enumerate(TEXTS)).selectExpr("*", "'x' AS n_words", "1 AS _keep")
    got = {r.doc_id: r for r in quality.measure(df).collect()}
    assert [tuple(got[i][c] for c in COLUMNS) for i in range(len(TEXTS))] == [naive(t) for t in TEXTS]
    assert got[0]["_keep"] == 1


def test_very_long_text(spark, docs):
    text = " ".join(f"w{i % 30_000}" for i in range(60_000))
    assert tuple(quality.measure(docs((1, text))).select(*COLUMNS).first()) == naive(text)


def prose(n):
    return " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(n))


def test_policies_and_ablations(spark, docs):
    df = docs((1, prose(60)), (2, prose(10)), (3, prose(60) + " ####### $$$$$$$$"), (4, "a b c " * 30), (5, "## $$ %%"))
    rows = quality.ledger(df).cache()
    kept = lambda p: {r.doc_id for r in rows.filter(quality.passes(p)).collect()}
    assert kept(quality.BASE) == {1, 3} and kept(quality.WEB) == {1}
    assert {r.doc_id for r in quality.kept_by(quality.WEB, quality.with_failed(quality.measure(df))).collect()} == {1}
    for r in quality.ablations(rows, quality.WEB).collect():
        others = quality.Policy("without", 1, tuple(x for x in quality.WEB.rules if x != r.rule))
        alone = quality.Policy("alone", 1, (r.rule,))
        assert r.kept_without == len(kept(others))
        assert r.n_failed == 5 - len(kept(alone))
        assert r.n_alone == len(kept(others)) - len(kept(quality.WEB))


def test_empty_table(spark, docs):
    assert quality.ledger(docs().limit(0)).count() == 0
    assert {r.kept_without for r in quality.ablations(quality.ledger(docs().limit(0)), quality.WEB).collect()} <= {0}


def test_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    from siftworks.llm.queries import QUERIES

    clean = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1").collect()}
    bad = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 0").collect()}
    out = {r.doc_id: r for r in QUERIES["op5_quality"](spark, sf).collect()}
    assert all(out[i].kept or out[i].base_failed for i in clean)
    assert sum(out[i].kept for i in bad) <= 0.02 * len(bad)
