import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from siftworks.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def digest(*inputs):
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(hashes):
    paths, level = [[] for _ in hashes], [(h, [i]) for i, h in enumerate(hashes)]
    while len(level) > 1:
        above = []
        for k in range(0, len(level), 2):
            run = level[k : k + 2]
            for j, (_, members) in enumerate(run):
                for i in members:
                    paths[i].append(("".join(x[0] for x in run[:j]), "".join(x[0] for x in run[j + 1 :])))
            above.append((digest(*[x[0] for x in run]), [i for x in run for i in x[1]]))
        level = above
    return level[0][0], paths


def brute(rows):
    leaves = [digest(*map(field, r)) for r in rows]
    langs = {}
    for i, r in enumerate(rows):
        langs.setdefault(r[2], []).append(i)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    subroots, paths = [], {}
    for lang in order:
        ids = sorted(langs[lang], key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaves[i]))
        top, below = tree([leaves[i] for i in ids])
        subroots.append(top)
        paths.update(zip(ids, below))
    root, above = tree(subroots)
    out = []
    for i, r in enumerate(rows):
        at = order.index(r[2])
        path, row = paths[i] + above[at], list(r)
        if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
            row[3] += 1
        folded = digest(*map(field, row))
        for before, after in path:
            folded = digest(before, folded, after)
        out.append((r[0], leaves[i], subroots[at], root, digest(*[b + a for b, a in path]), folded, folded == root))
    return out


def got(df, digits):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return sorted((tuple(r) for r in merkle.manifest(df, tampered, digits).select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize("digits", [3, merkle.DIGITS])
def test_table_against_brute_force(spark, digits):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in df.select(*merkle.FIELDS).collect()]
    found = got(df, digits)
    assert found == sorted(brute(rows), key=str) and 0 < sum(not r[-1] for r in found) < len(found) / 2


def test_nulls_repeats_lone_leaves_and_names(spark):
    rows = [(i, "s", "en", 3, "abc") for i in range(9)]
    rows += [(5, "s", "en", 3, "abc"), (5, "s", "en", 3, "abd"), (None, None, "en", None, None), (None, "", "en", 0, "")]
    rows += [(7, "s", None, 1, "x"), (-4, "ü", "é", None, "日本" * 50_000), (1, "s", "", 2, "ab"), (2, "s", "é", 9, "y")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df, 2) == sorted(brute(rows), key=str)
    clashing = df.selectExpr("*", "1 AS grp", "2 AS hash", "3 AS changed", "4 AS at", "5 AS body", "6 AS rank", "7 AS block", "8 AS own", "9 AS path", "10 AS tree", "11 AS d0", "12 AS root")
    assert got(clashing, 2) == sorted(brute(rows), key=str)
    assert got(df.limit(0), 2) == []
    one = spark.createDataFrame(rows[:1], SCHEMA)
    assert got(one, 2) == brute(rows[:1])
