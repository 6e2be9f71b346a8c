"""Texts that begin with thousands of words which also stand in titles."""

import hashlib

from conftest import rows

from siftworks.llm.license_texts import TEXTS
from siftworks.llm.licenses import scan


def test_a_long_run_of_title_words_needs_no_deep_stack(spark):
    run = "The 0 license " * 20000
    body = TEXTS["MIT"].split("\n\n", 2)[2]
    docs = spark.createDataFrame([(0, run), (1, run + body), (2, "New MIT License\n\n" + body)], "doc_id long, text string")
    got = rows(scan(docs), "doc_id", "license", "digest")
    assert [r[1] for r in got] == [None, "MIT", "MIT"]
    assert got[0][2] == hashlib.md5(("the 0 license " * 20000).strip().encode()).hexdigest()
