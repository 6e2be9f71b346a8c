import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from llm_fixtures import docs  # noqa: F401
from siftworks.llm import packing
from siftworks.llm.queries import QUERIES

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def verify(pieces, texts):
    """Each id of each document in exactly one piece, sequences without gaps and within the limit."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert by_doc.keys() == texts.keys()
    for d, own in by_doc.items():
        ids = np.array([*TOKENIZER.encode(texts[d] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    lengths = []
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
        lengths.append(at)
    return lengths


def test_query_round_trip_and_padding(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    lengths = verify(QUERIES["op9_packing"](spark, sf).collect(), texts)
    padding = sum(1024 - n for n in lengths if n & (n - 1))
    assert padding < 0.01 * sum(lengths)


def test_odd_texts(spark, docs):
    texts = {1: None, 2: "", 3: "<|endoftext|>", 4: "no end " * 4000, 5: "a. " * 3000, 6: " \n\t\x00é😀", 7: "x" * 20_000, 8: "a <|endoftext|> b \n <|endoftext|>", 9: "<|endoftext" * 3 + "|><|endoftext|>  x"}
    verify(packing.pack(docs(*texts.items()).repartition(3)).collect(), texts)
    assert packing.pack(docs().limit(0)).count() == 0
    twice = packing.pack(docs((1, "a b"), (1, "a b"), (None, "c")).selectExpr("*", "1 AS start", "2 AS length")).collect()
    assert sorted(str(p.doc_id) for p in twice) == ["1", "1", "None"]


def naive_plan(places, costs, limit):
    pos = [0, *places]
    best = [0.0]
    for i in range(1, len(pos)):
        options = []
        for j in range(i):
            n = pos[i] - pos[j]
            if n <= limit:
                options.append(best[j] + (0 if n & (n - 1) == 0 else limit - n))
        best.append(min(options) + costs[i - 1] + packing.SEQUENCE_COST)
    return best[-1]


def test_the_plan_is_optimal():
    rng = np.random.default_rng(3)
    for _ in range(60):
        limit = 64
        places = np.cumsum(rng.integers(1, 20, 60))
        costs = rng.integers(0, 9, 60)
        ends = packing.plan(places, costs, limit)
        at, total, cost = 0, 0, dict(zip(places.tolist(), costs.tolist()))
        for e in ends:
            n = e - at
            assert 0 < n <= limit
            total += (0 if n & (n - 1) == 0 else limit - n) + cost[e] + packing.SEQUENCE_COST
            at = e
        assert at == places[-1] and total == naive_plan(places.tolist(), costs.tolist(), limit)
