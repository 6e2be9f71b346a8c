from llm_fixtures import docs  # noqa: F401
from siftworks.llm import simhash


def words(name, n=60):
    return " ".join(f"{name}{i}" for i in range(n))


def test_each_group_keeps_a_row_whatever_its_ids(spark, docs):
    a, b, c, d, e, f = (words(x) for x in "abcdef")
    # NULL ids in groups of their own and beside an id; an id that three unrelated texts repeat
    df = docs((None, a), (None, a), (None, b), (None, c), (7, c), (9, d), (9, e), (9, f), (9, f), (3, f.upper()))
    kept = sorted(((r.doc_id, r.text) for r in simhash.keep_one(df).collect()), key=str)
    assert kept == sorted([(None, a), (None, b), (7, c), (9, d), (9, e), (3, f.upper())], key=str)
