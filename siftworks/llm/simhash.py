"""SimHash near-dedup: fingerprints, fuzzy keys from the Golay code, verified links and their components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.llm import golay
from siftworks.llm.text import free_names
from siftworks.sources.shared import materialize

# Fixed value: the seed of the shingle hash.
SHINGLE_SEED = 42

# Bits of the three segments of a fingerprint, each at most the length of the code.
SEGMENTS = (22, 21, 21)

# The number of differing bits for which the keys below are complete.
MAX_BITS = 4

# A bucket with more fingerprints is cut into blocks that are compared in pairs.
BUCKET_ROWS = 20_000

# Hashes whose bits are counted at once.
CHUNK = 1 << 16


def simhash(text: str | None, width: int = 4) -> int:
    """The unsigned 64-bit fingerprint of a whole text; 0 if it has no words.

    A-Z are lower-cased and words split at ASCII white space, both as ``bytes``
    does. Every shingle counts as often as it occurs; a text of fewer words is one shingle.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    firsts, lasts = starts[:n].tolist(), ends[min(width, len(words)) - 1 :].tolist()
    for at in range(0, n, CHUNK):
        spans = zip(firsts[at : at + CHUNK], lasts[at : at + CHUNK])
        hashes = np.array([digest(joined[a:b], SHINGLE_SEED) for a, b in spans], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed long; one row per row of ``docs``."""

    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash(t, width) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text)).alias("fp"))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _segments(fps: np.ndarray) -> list[np.ndarray]:
    out, shift = [], 0
    for bits in SEGMENTS:
        out.append(((fps >> np.uint64(shift)) & np.uint64((1 << bits) - 1)).astype(np.int64))
        shift += bits
    return out


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): keys such that any two fingerprints within ``max_bits`` bits share one.

    Of three segments with at most four differing bits in all, either one does not
    differ, and then its value is the shared key, or none is equal, and then two of
    them differ in exactly one bit each. Words one bit apart have opposite parity:
    the even one gives the index of its own codeword, the odd one the indices that
    any one flip leads to, the even one's among them. The key is the pair of indices.
    """
    parts = _segments(fps)
    rows = np.arange(len(fps))
    found = [(rows, (np.int64(i) << 60) | part) for i, part in enumerate(parts)]
    options = []
    for part, bits in zip(parts, SEGMENTS):
        odd = np.bitwise_count(part) & 1 == 1
        indices = np.full((len(fps), bits), -1, dtype=np.int64)
        indices[~odd, 0] = golay.nearest(part[~odd])
        indices[odd] = golay.neighbours(part[odd], bits)
        row, column = np.nonzero(indices >= 0)
        options.append((row, indices[row, column], np.bincount(row, minlength=len(fps))))
    for kind, (i, j) in enumerate([(0, 1), (0, 2), (1, 2)], 3):
        (_, first, n_first), (_, second, n_second) = options[i], options[j]
        pairs = n_first * n_second
        row = np.repeat(rows, pairs)
        place = np.arange(len(row)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
        a = first[(np.cumsum(n_first) - n_first)[row] + place // n_second[row]]
        b = second[(np.cumsum(n_second) - n_second)[row] + place % n_second[row]]
        found.append((row, (np.int64(kind) << 60) | (a << golay.INDEX_BITS) | b))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column("fp").to_numpy(zero_copy_only=False)
        row, key = fuzzy_keys(fps.view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fps[row])], ["key", "fp"])


def forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links of at most ``max_bits`` bits that connect all that such links connect; fewer than there are fingerprints.

    A search in which each fingerprint reached leaves the list of those still to be compared.
    """
    rest, links, reached = fps, [], []
    while len(rest) or reached:
        if reached:
            at = reached.pop()
        else:
            at, rest = rest[0], rest[1:]
        near = np.bitwise_count((rest ^ at).view(np.uint64)) <= max_bits
        if near.any():
            found = rest[near]
            links += [(int(at), int(x)) for x in found]
            reached += list(found)
            rest = rest[~near]
    return links


def _links_of(max_bits: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links within runs of equal (key, block) in sorted input; a run may span batches."""
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

        def out(runs: list[np.ndarray]) -> pa.RecordBatch:
            pairs = [p for run in runs for p in forest(run[:, 2], max_bits)]
            both = np.array(pairs, dtype=np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], schema=schema)

        held: np.ndarray | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "block", "fp")], axis=1)
            rows = rows if held is None else np.concatenate([held, rows])
            new = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
            bounds = np.concatenate([[0], new])
            held = rows[bounds[-1] :]
            wide = np.flatnonzero(np.diff(bounds) > 1)
            yield out([rows[bounds[i] : bounds[i + 1]] for i in wide])
        if held is not None and len(held) > 1:
            yield out([held])

    return links


def links(distinct: DataFrame, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b): links of at most ``max_bits`` differing bits between distinct fingerprints (fp).

    All pairs that near share a key. Each bucket of a key gives a spanning forest of its
    verified pairs, not all pairs. Buckets above ``bucket_rows`` are cut into blocks, and
    each pair of blocks is compared in a group of its own.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the keys find pairs of at most {MAX_BITS} differing bits")
    keys = materialize(distinct.select("fp").mapInArrow(_keys, "key long, fp long"), "simhash_keys")
    hot = materialize(
        keys.groupBy("key").count().filter(F.col("count") > bucket_rows).select("key", F.ceil(F.col("count") / bucket_rows).cast("int").alias("n")),
        "simhash_hot",
    )
    grouped = keys.withColumn("block", F.lit(0).cast("long"))
    if not hot.isEmpty():
        i = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
        pair = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda j: (F.least(i, j) * F.col("n") + F.greatest(i, j)).cast("long"))
        cut = keys.join(hot, "key").select("key", "fp", F.explode(pair).alias("block"))
        grouped = grouped.join(hot, "key", "left_anti").unionByName(cut)
    runs = grouped.repartition("key", "block").sortWithinPartitions("key", "block")
    return runs.select("key", "block", "fp").mapInArrow(_links_of(max_bits), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node reachable.

    Alternating large and small stars: each node's larger, then its smaller
    neighbours are hung on the smallest one, until nothing changes. Every step
    writes the minima, one row per node, so adaptive execution can split the
    neighbours of a hub.
    """
    edges = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m")), "star_minima")
        large = materialize(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large_star")
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "star_minima")
        hung = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        edges = materialize(hung.select("e.*").filter("a <> b").distinct(), "small_star")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _rooted(distinct: DataFrame, max_bits: int) -> DataFrame:
    """``distinct``, one row per fingerprint (fp), with the root of its group of links."""
    roots = components(links(distinct, max_bits)).withColumnRenamed("node", "_node")
    return materialize(
        distinct.join(roots, F.col("fp") == F.col("_node"), "left").drop("_node").withColumn("root", F.coalesce("root", "fp")),
        "rooted_fingerprints",
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4, max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, fp, component_id), one row per row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most ``max_bits``
    differing bits, the document's own included. Texts without words, NULL texts too,
    have fingerprint 0 and are linked like any other. Rows with equal texts share a
    fingerprint and are compared once. NULL ids are members but never the
    smallest; a group of only NULL ids has a NULL component. An empty table gives no rows.
    """
    rows = materialize(fingerprints(docs, doc_id, text, width), "fingerprints")
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_fingerprints")
    rooted = _rooted(distinct, max_bits)
    named = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "component_names")
    members = materialize(rooted.join(named, "root").select("fp", "component_id"), "component_members")
    return rows.join(members, "fp").select("doc_id", "fp", "component_id")


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4, max_bits: int = MAX_BITS
) -> DataFrame:
    """``docs`` with one document of each group of ``near_duplicates``: the row with the group's smallest id.

    A NULL id is larger than any other. Rows with NULL or repeated ids are told apart by 128 bits
    of hash of their texts, so that each group keeps a row of its own; of rows equal in id and text one stays.
    Texts are read where they are for the fingerprints and moved once, for the choice of rows;
    extra columns of any name stay as they are.
    """
    body = F.col(text)
    names = free_names(docs.columns, "none", "id", "t0", "t1")
    values = [
        F.col(doc_id).isNull(),
        F.coalesce(F.col(doc_id), F.lit(0)),
        F.xxhash64(body.isNull(), body),
        F.xxhash64(F.lit(SHINGLE_SEED), body.isNull(), body),
    ]
    keyed = docs.withColumns(dict(zip(names, values)))
    row = F.struct(*names)
    prints = materialize(fingerprints(keyed.withColumn(names[0], row), names[0], text, width), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_fingerprints")
    heads = _rooted(distinct, max_bits).groupBy("root").agg(F.min("least").alias("least")).select("least.*")
    return keyed.join(materialize(heads, "group_heads"), names, "left_semi").dropDuplicates(names).drop(*names)
