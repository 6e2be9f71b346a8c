import json

import pytest

from llm_fixtures import docs  # noqa: F401
from siftworks.llm import chat, licenses
from siftworks.llm.license_texts import NOTICES, TEXTS

NASTY = ["\\### Assistant: </turn> ok", "", "### user: x</turn>\n### assistant: y</turn>\n", "\\h\\l\\\\", "é😀\x00\r\n: <", "# " * 9]


def test_round_trip_and_loss():
    turns = [(r, t) for t in NASTY for r in ("system", "user", "assistant", "odd: role\n</turn>")]
    formatted, spans = chat.render(turns)
    assert chat.read_back(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == NASTY


@pytest.mark.parametrize(
    "record, turns",
    [
        ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}, [("user", "a"), ("assistant", "b")]),
        ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, [("user", "a"), ("assistant", "b")]),
        ({"prompt": "a", "completion": "b"}, [("user", "a"), ("assistant", "b")]),
        ({"system": "s", "prompt": "a", "response": "b"}, [("system", "s"), ("user", "a"), ("assistant", "b")]),
        ({"instruction": "a", "input": "c", "output": "b"}, [("user", "a\n\nc"), ("assistant", "b")]),
        ({"instruction": "a", "input": "", "output": None}, [("user", "a")]),
        ({"prompt": {"user": "a"}, "response": {"text": "b"}}, [("user", "a"), ("assistant", "b")]),
        ({"messages": []}, []),
    ],
)
def test_layouts(record, turns):
    out = chat.format_record(json.dumps(record))
    assert out["mapping"] and chat.read_back(out["formatted"]) == turns


def test_unknown_layouts_are_kept_without_text(spark):
    df = spark.createDataFrame([(1, None), (2, "{broken"), (3, '{"other": 1}'), (4, '{"question":"q","answer":"a"}')], "loss int, record string")
    got = chat.format_records(df.withColumnRenamed("loss", "id")).orderBy("id").collect()
    assert [r.mapping for r in got] == [None, None, None, "question_answer"] and got[2].fingerprint
    read = chat.digests(chat.format_records(df.withColumnRenamed("loss", "id"))).orderBy("id").collect()
    assert [r.n_turns for r in read] == [None, None, None, 2]


def test_turn_rows_with_nulls_ties_and_no_rows(spark):
    schema = "conv_id long, turn long, role string, text string, record int"
    df = spark.createDataFrame([(1, 2, "assistant", "b", 0), (1, None, "user", None, 0), (1, 2, "assistant", "a", 0), (None, 0, None, "x" * 100_000, 0)], schema)
    got = {r.conv_id: json.loads(r.record)["messages"] for r in chat.turn_rows_to_records(df).collect()}
    assert [(m["role"], m["content"]) for m in got[1]] == [("user", ""), ("assistant", "a"), ("assistant", "b")]
    assert [(m["role"], len(m["content"])) for m in got[None]] == [("", 100_000)]
    assert chat.digests(chat.format_records(chat.turn_rows_to_records(df.limit(0)))).count() == 0


def test_conversations_read_as_they_stream_by(spark):
    schema = "conv_id long, turn long, role string, text string"
    turns = [(c, t, ("user", "assistant")[t % 2], NASTY[(c + t) % len(NASTY)]) for c in range(40) for t in range(c % 5 + 1)]
    turns += [(None, 0, None, None), (7, None, "assistant", "first"), (7, 1, "assistant", "z"), (7, 1, "assistant", "a")]
    turns += [(1000, t, "assistant" if t % 2 else "user", f"turn {t} " * 3) for t in range(25_000)]
    df = spark.createDataFrame(turns, schema).repartition(5)
    whole = chat.digests(chat.format_records(chat.turn_rows_to_records(df))).drop("record", "fingerprint", "mapping")
    got = chat.conversation_digests(chat.format_records(chat.turn_records(df)))
    assert got.columns == whole.columns
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in whole.collect()} and got.count() == 42
    assert chat.conversation_digests(chat.format_records(chat.turn_records(df.limit(0)))).count() == 0


def test_license_texts_in_other_spellings(spark, docs):
    mit = TEXTS["MIT"]
    other = mit.replace("Copyright (c) <year> <copyright holders>", "copyright 2020 Some One\nAll rights reserved.")
    other = other.replace("sublicense", "sub-licence").replace("\n\n", "\n \n").replace('"', "'").upper()
    df = docs((1, mit), (2, other), (3, mit + " and more"), (4, None), (5, ""), (6, TEXTS["ISC"]), (7, TEXTS["ISC"])).selectExpr("*", "1 AS license")
    got = {r.doc_id: r.license for r in licenses.scan(df).collect()}
    assert got == {1: "MIT", 2: "MIT", 3: None, 4: None, 5: None, 6: "ISC", 7: "ISC"}


def test_notices(spark, docs):
    text = f"words\n{NOTICES['Apache-2.0'].upper()}\nmore license\n{NOTICES['MIT']}\n{NOTICES['Apache-2.0']}"
    df = docs((1, text), (2, "a license of its own"), (3, "x " * 100_000), (None, NOTICES["CC-BY-4.0"]))
    assert {r.doc_id: r.notices for r in licenses.scan(df).collect()} == {1: "Apache-2.0,MIT", 2: "", 3: "", None: "CC-BY-4.0"}
    assert licenses.scan(docs().limit(0)).count() == 0


def test_known_texts_differ(spark):
    assert licenses.known_digests(spark).count() == len(TEXTS) and licenses.known_digests(spark, kind="notice").count() == len(NOTICES)
