import numpy as np
import pytest
import xxhash

from llm_fixtures import docs  # noqa: F401
from siftworks.llm import golay, simhash
from siftworks.llm.queries import QUERIES


def naive_fingerprint(text):
    words = [w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w) for w in (text or "").replace("\x0b", " ").replace("\x0c", " ").split(" ")]
    words = [w for x in words for w in x.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def naive_components(fps, ids, max_bits=4):
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                label[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        least[root(i)] = min(least.get(root(i), d), d)
    return [least[root(i)] for i in range(len(fps))]


def test_the_code_is_perfect():
    words = np.arange(1 << 23, dtype=np.int64)
    assert (np.bincount(golay.nearest(words)) == 2048).all()
    assert np.bitwise_count(golay.ERRORS).max() == 3 and len(np.unique(golay.ERRORS)) == 2048


def test_keys_are_complete_for_four_bits():
    rng = np.random.default_rng(1)
    for bits in range(5):
        a = rng.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 3000, dtype=np.uint64)
        b = a.copy()
        for i in range(len(b)):
            for place in rng.choice(64, bits, replace=False):
                b[i] ^= np.uint64(1) << np.uint64(place)
        (ra, ka), (rb, kb) = simhash.fuzzy_keys(a), simhash.fuzzy_keys(b)
        met = {r for r, _ in set(zip(ra.tolist(), ka.tolist())) & set(zip(rb.tolist(), kb.tolist()))}
        assert met == set(range(len(a)))


def test_fingerprints_match_the_definition():
    for text in (None, "", " \n", "one", "a b c", "A b C d", "É b\tC\x0bd e f g h", "x " * 50, "a b c d e f"):
        assert simhash.simhash(text) == naive_fingerprint(text)
    long = " ".join(str(i * 7919 % 10007) for i in range(70_000))
    assert simhash.simhash(long) == naive_fingerprint(long)


def test_forest_connects_what_pairs_connect():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 62, 40, dtype=np.uint64)
    fps = np.unique(np.concatenate([base] + [base ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) for _ in range(8)]))
    links = simhash.forest(fps, 4)
    assert len(links) < len(fps)
    assert all((a ^ b).bit_count() <= 4 for a, b in links)
    values = [int(x) for x in fps]
    want = naive_components(values, values)
    label = {v: v for v in values}
    for _ in values:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert [label[v] for v in values] == want


@pytest.mark.parametrize("bucket_rows", [simhash.BUCKET_ROWS, 5])
def test_links_and_components_against_all_pairs(spark, bucket_rows):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 30, dtype=np.uint64)
    steps = [base]
    for _ in range(12):  # chains: each step two bits from the last
        nxt = steps[-1].copy()
        for _ in range(2):
            nxt ^= np.uint64(1) << rng.integers(0, 64, 30).astype(np.uint64)
        steps.append(nxt)
    fps = np.unique(np.concatenate([*steps, rng.integers(0, 1 << 62, 200, dtype=np.uint64), [np.uint64(0)]])).view(np.int64)
    df = spark.createDataFrame([(int(x),) for x in fps], "fp long").repartition(3)
    linked = simhash.components(simhash.links(df, 4, bucket_rows))
    got = {r.node: r.root for r in linked.collect()}
    values = [int(x) for x in fps.view(np.uint64)]
    want = naive_components(values, [int(x) for x in fps])
    assert [got.get(int(x), int(x)) for x in fps] == want


def test_query_against_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    fps = [naive_fingerprint(d.text) for d in docs]
    want = dict(zip([d.doc_id for d in docs], zip([f"{x:016x}" for x in fps], naive_components(fps, [d.doc_id for d in docs]))))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op2_simhash"](spark, sf).collect()}
    assert got == want


def test_nulls_repeats_and_empty(spark, docs):
    df = docs((5, None), (3, ""), (9, "a b c d e"), (9, "a b c d e"), (None, "A B C D E"), (7, "entirely other words stand here now"))
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (9, 9), (9, 9), (None, 9), (7, 7)], key=str)
    kept = simhash.keep_one(df.withColumnRenamed("lang", "fp"))
    assert sorted(r.doc_id for r in kept.collect()) == [3, 7, 9] and kept.columns == ["doc_id", "text", "fp", "source", "n_chars"]
    assert simhash.near_duplicates(docs().limit(0)).count() == 0
    only = simhash.keep_one(docs((None, "a b c d"), (None, "a b c d")))
    assert only.count() == 1
    clashing = df.selectExpr("*", "1 AS _none", "2 AS _ID", "3 AS _t0", "4 AS _t1", "5 AS root", "6 AS least", "7 AS _node")
    kept = simhash.keep_one(clashing)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 7, 9] and kept.columns == clashing.columns
    assert {(r._none, r._ID, r._t0, r._t1, r.root, r.least, r._node) for r in kept.collect()} == {(1, 2, 3, 4, 5, 6, 7)}
    assert simhash.keep_one(docs().limit(0)).count() == 0


def test_too_many_bits_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 5)
