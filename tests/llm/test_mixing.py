import pytest

from llm_fixtures import docs  # noqa: F401
from siftworks.llm.mixing import Mix


def fill(sizes, weights=(1, 2, 3)):
    """Targets by sharing again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * w[s] / sum(w[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {**capped, **share}
        capped |= {s: 3.0 * sizes[s] for s in over}


ROWS = [(i, "w " * (i % 7 + 1), f"src{i % 5}") for i in range(60)] + [(100, "lone word", "tiny"), (101, "x " * 900, "big"), (102, "y", None), (103, None, None), (104, "", "void")]


def test_targets_and_budgets(spark, docs):
    out = Mix(docs(*ROWS)).taken().collect()
    sizes = {}
    for r in out:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = fill(sizes)
    taken = {}
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert len(out) == len(ROWS)
    for s, n in taken.items():
        assert abs(n - want[s]) <= 0.5
    assert sorted(map(tuple, Mix(docs(*ROWS[::-1])).taken().collect()), key=str) == sorted(map(tuple, out), key=str)


def test_many_ranges_agree_with_one(spark, docs, monkeypatch):
    rows = [(i, "w " * (i % 5), "ab"[i % 3 == 0]) for i in range(300)]
    one = sorted(map(tuple, Mix(docs(*rows)).taken().collect()))
    monkeypatch.setattr("siftworks.llm.mixing.ROWS_PER_RANGE", 4)
    assert sorted(map(tuple, Mix(docs(*rows)).taken().collect())) == one


def test_repeated_rows_share_the_budget(spark, docs):
    out = Mix(docs(*[(1, "a b c", "s")] * 5, (2, "d e f g", "t"))).taken().collect()
    assert sum(r.taken for r in out if r.source == "s") == pytest.approx(out[0].target if out[0].source == "s" else 19 - 12, abs=0.5)


def test_repeat_holds_whole_documents(spark, docs):
    df = docs(*ROWS).withColumnRenamed("lang", "taken")
    mix = Mix(df)
    texts = {r[0]: r[1] for r in ROWS}
    copies = {}
    held = mix.repeat(df)
    for r in held.collect():
        assert r.text == texts[r.doc_id]
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert held.columns == df.columns and max(copies.values()) <= 3
    whole = {r.doc_id: r for r in mix.rows.collect()}
    for i, r in whole.items():
        if r.size:
            assert copies.get(i, 0) == r.epochs + (2 * r.cut >= r.size and r.cut > 0)


def test_empty_tables(spark, docs):
    empty = docs().limit(0)
    mix = Mix(empty)
    assert mix.taken().count() == 0 and mix.repeat(empty).count() == 0
    assert [r.taken for r in Mix(docs((1, None), (2, ""))).taken().collect()] == [0, 0]
