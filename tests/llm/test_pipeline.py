import math
from collections import Counter

import corpus_pipeline
from siftworks.llm import packing
from test_line_dedup import brute as drop_lines
from test_mixing import fill
from test_packing import verify
from test_quality import WORD, naive
from test_simhash import naive_components, naive_fingerprint

SF = "/root/testdata/sf0.001"


def passes(text):
    n, chars, symbols, dup, repeat = naive(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    letters = sum(c.isalpha() for c in text)
    return not (n < 50 or 2 * repeat > n or 10 * symbols > n or 2 * dup > len(lines) or chars < 2 * n or chars > 15 * n or 2 * letters < chars)


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    frame, texts = docs, {i: r.text for i, r in rows.items()}

    def stage(i):
        out = corpus_pipeline.STAGES[i][1](spark, frame, SF).cache()
        if i < 4:
            assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
        return out

    frame = stage(0)
    texts = {i: t for i, t in texts.items() if passes(t)}
    assert {r.doc_id: r.text for r in frame.collect()} == texts

    frame = stage(1)
    texts = dict(zip(texts, (kept for _, _, kept in drop_lines(list(texts.values()), 10))))
    assert {r.doc_id: r.text for r in frame.collect()} == texts
    assert all(r.n_chars == len(r.text) for r in frame.collect())

    frame = stage(2)
    ids = list(texts)
    heads = set(naive_components([naive_fingerprint(texts[i]) for i in ids], ids))
    texts = {i: t for i, t in texts.items() if i in heads}
    assert {r.doc_id: r.text for r in frame.collect()} == texts

    frame = stage(3)
    size = {i: len(WORD.findall(t)) for i, t in texts.items()}
    total = Counter()
    for i, n in size.items():
        total[rows[i].source] += n
    copies = Counter(r.doc_id for r in frame.collect())
    words = Counter()
    for i, n in copies.items():
        words[rows[i].source] += n * size[i]
    for source, target in fill(total).items():
        largest = max(size[i] for i in texts if rows[i].source == source)
        assert abs(words[source] - target) <= math.ceil(largest / 2)
    assert max(copies.values()) <= 3

    pieces = stage(4).collect()
    starts = Counter(p.doc_id for p in pieces if p.start == 0)
    assert starts == copies
    once = {i: t for i, t in texts.items() if copies[i] == 1}
    lone = [p for p in pieces if p.doc_id in once]
    assert {p.doc_id for p in lone} == once.keys()
    assert sum(p.length for p in pieces) == sum(p.doc_tokens for p in pieces if p.start == 0)
    assert all(p.offset + p.length <= packing.MAX_TOKENS for p in pieces)


def test_run_is_the_stages_in_order(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    assert out and [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules",
        "line dedup",
        "SimHash near-dedup",
        "mixing sources to target weights",
        "packing",
    ]
    assert sum(p.length for p in out) == sum(p.doc_tokens for p in out if p.start == 0)


def test_empty_documents_go_through_all_stages(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, f in corpus_pipeline.STAGES:
        frame = f(spark, frame, SF)
    assert frame.count() == 0 and verify([], {}) == []
