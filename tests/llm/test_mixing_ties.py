import pytest

from llm_fixtures import docs  # noqa: F401
from siftworks.llm.mixing import Mix
from test_mixing import fill


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 200, "c": 300},  # the same cap by weight in all
        {"a": 60, "b": 60, "c": 60, "d": 60},  # equal sources, two of them with the weight 1
        {"a": 10, "b": 400, "c": 30, "d": 10},  # ties before and after the water level
    ],
)
def test_targets_with_ties(spark, docs, sizes):
    rows = [(i, "w " * 10, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n // 10))]
    mix = Mix(docs(*rows))
    out = mix.taken().collect()
    want = fill(sizes)
    assert {r.source: r.target for r in out} == pytest.approx(want)
    for s in sizes:
        assert sum(r.taken for r in out if r.source == s) == pytest.approx(want[s], abs=0.5)
    assert mix.repeat(docs(*rows)).count() == pytest.approx(sum(sizes.values()) / 10, abs=len(sizes) / 2)
