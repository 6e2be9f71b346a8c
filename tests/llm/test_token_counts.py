import public_tokenizers
import pytest
import numpy as np
from tokenizers import Tokenizer

from llm_fixtures import docs  # noqa: F401
from siftworks.llm import token_counts
from siftworks.llm.queries import QUERIES

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def n_tokens(text):
    return len(TOKENIZER.encode(text or "", add_special_tokens=False))


def test_query_against_the_tokenizer(spark):
    sf = "/root/testdata/sf0.01"
    got = sorted(map(tuple, QUERIES["op12_token_counts"](spark, sf).collect()))
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = [(i, len(t.encode()), n_tokens(t), n_tokens(t) > 2048) for i, t in rows]
    assert got == sorted(want)
    assert any(len(t) > token_counts.CHUNK for _, t in rows)


def test_spliced_counts_of_odd_texts(spark, docs):
    rng = np.random.default_rng(1)
    parts = ["word", " ", "  ", "\n", "it's", "'ll", "12", "3", "<|endoftext|>", "<|startof", "text|>", "é", "é", "q́", "≠", "ΑΣ", "日本語", "한", "😀", "!?", "a" * 30, "ſ", "İ", "́"]
    texts = ["".join(parts[i] for i in rng.integers(0, len(parts), rng.integers(0, 400))) for _ in range(300)]
    texts += [None, "", " " * 500, "́" * 500, "x" * 2000, "a b " * 300, "<|endoftext|>" * 60, "word " * 50 + "y" * 700 + " word" * 200]
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(docs(*enumerate(texts)).repartition(3), limit=100, chunk=64, overlap=48).collect()}
    assert got == {i: (len((t or "").encode()), n_tokens(t), n_tokens(t) > 100) for i, t in enumerate(texts)}


def test_wide_overlaps_and_long_words(spark, docs):
    rng = np.random.default_rng(2)
    words = [f"{x:x}" for x in rng.integers(1 << 40, size=30_000)]
    texts = {1: " ".join(words), 2: "".join(c for w in words for c in w if c.isalpha()), 3: "z" * 90_000 + " end", 4: " ".join(words[:5])}
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs(*texts.items())).collect()}
    assert got == {i: n_tokens(t) for i, t in texts.items()}


def test_repeats_nulls_names_and_empty(spark, docs):
    long = "several words here " * 40
    df = docs((1, long), (1, long), (None, long), (2, "few words"))
    df = df.selectExpr("*", "5 AS _t0", "6 AS _T1", "7 AS _n", "8 AS n_tokens", "9 AS t0", "10 AS chunk")
    out = token_counts.count_tokens(df, chunk=64, overlap=48)
    rows = out.collect()
    assert sorted((str(r.doc_id), r.n_tokens, r._t0, r._T1, r._n, r.t0, r.chunk) for r in rows) == [("1", 120, 5, 6, 7, 9, 10)] * 2 + [("2", 2, 5, 6, 7, 9, 10), ("None", 120, 5, 6, 7, 9, 10)]
    assert out.columns == [c for c in df.columns if c != "n_tokens"] + ["n_bytes", "n_tokens", "over_limit"]
    assert token_counts.count_tokens(docs().limit(0)).count() == 0
    with pytest.raises(ValueError):
        token_counts.count_tokens(df, chunk=64, overlap=8)
