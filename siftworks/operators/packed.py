"""Sparse vectors as one row per document, for runs that read them in many rounds.

The terms in most documents get numbers, and a document keeps its entries of these terms in two arrays, ``ids`` and
``values``; a weight is the value times the factor of its term (the IDF, or 1). Products and sums over these
entries are taken with numpy against one array of all centroids, bounded by ``DENSE`` numbers, that goes to the tasks as a
broadcast does. The entries of all other terms stay rows (doc_id, term, weight) and are joined on the term.

A term that one document alone has meets that document only. Its entry in a mean is the weight over the number of members, so all
that distances need of such terms is the sum of their squares by document, ``alone``, and who is a member.

Centroids of packed vectors are ``Centres``: that array, and rows (cluster, term, weight) of the other terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftworks.functions.skew import broadcast_if_small
from siftworks.sources.shared import materialize

# At most so many terms get numbers, and centroids have at most so many numbers in their array.
TERMS, DENSE = 1_000_000, 5_000_000


class Packed(NamedTuple):
    """``rows`` (doc_id, ids, values), ``rare`` (doc_id, term, weight) or None if all terms have numbers, ``norms``
    (doc_id, norm), ``terms`` (term, id) and the factors by number, or None if all are 1. Where terms of one document are
    told apart, they are in no other column but ``norms``: ``singles`` (doc_id, term, weight), ``alone`` (doc_id, alone)."""

    rows: DataFrame
    rare: DataFrame | None
    norms: DataFrame
    terms: DataFrame
    n_terms: int
    factors: np.ndarray | None = None
    alone: DataFrame | None = None
    singles: DataFrame | None = None

    def each(self, f) -> Packed:
        return self._replace(rows=f(self.rows), rare=None if self.rare is None else f(self.rare), norms=f(self.norms))

    def joined(self, docs: DataFrame, how: str = "inner") -> Packed:
        """With the documents of ``docs`` only, and its further columns. No vector is moved if both are dealt alike."""
        return self.each(lambda df: df.join(docs.hint("shuffle_hash"), "doc_id", how))

    def dealt(self, partitions: int) -> Packed:
        """Dealt out by document and kept."""
        alone = None if self.alone is None else self.alone.repartition(partitions, "doc_id").persist()
        return self.each(lambda df: df.repartition(partitions, "doc_id").persist())._replace(alone=alone)

    def n_entries(self) -> int:
        n = self.rows.agg(F.sum(F.size("ids"))).first()[0] or 0
        return n if self.rare is None else n + self.rare.count()

    def persist(self) -> Packed:
        return self.each(lambda df: df.persist())

    def unpersist(self) -> None:
        self.each(lambda df: df.unpersist())


def numbered(counts: DataFrame, k: int) -> tuple[DataFrame, int, bool]:
    """The most common terms of (term, df, ...) with their numbers ``id`` as a stored table, how many they are, and whether
    these are all. Terms with the same ``df`` are in or out together."""
    most = max(1, min(TERMS, DENSE // k))
    by_count = counts.groupBy("df").agg(F.count("*").alias("_terms"))
    so_far = by_count.withColumn("_so_far", F.sum("_terms").over(W.orderBy(F.col("df").desc())))
    least, n, total = so_far.agg(
        F.min(F.when(F.col("_so_far") <= most, F.col("df"))),
        F.max(F.when(F.col("_so_far") <= most, F.col("_so_far"))),
        F.max("_so_far"),
    ).first()
    chosen = counts.filter(F.col("df") >= least) if least is not None else counts.limit(0)
    # at most ``most`` rows
    number = (F.row_number().over(W.orderBy(F.col("df").desc(), "term")) - 1).alias("id")
    return materialize(chosen.select("*", number), "numbered"), n or 0, (n or 0) == (total or 0)


def pack(vectors: DataFrame, k: int) -> Packed:
    """Packed vectors from (doc_id, term, weight)."""
    counts = materialize(vectors.groupBy("term").agg(F.count("*").alias("df")), "terms")
    terms, n, all_ = numbered(counts, k)
    terms = terms.select("term", "id")
    entries = vectors.join(F.broadcast(terms), "term").groupBy("doc_id")
    rows = entries.agg(F.collect_list(F.struct("id", "weight")).alias("_all")).select(
        "doc_id", F.col("_all.id").alias("ids"), F.col("_all.weight").alias("values")
    )
    rare = None if all_ else vectors.join(F.broadcast(terms), "term", "left_anti").select("doc_id", "term", "weight")
    norms = vectors.groupBy("doc_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("norm"))
    return Packed(rows, rare, norms, terms, n)


def encode(corpus: DataFrame, terms: DataFrame, share: bool) -> DataFrame:
    """(doc_id, ids, values, others, other_values): the tokens of each text counted in its row, numbered terms by number.

    Values are counts, with ``share`` over the number of tokens. Tokens are those of ``functions.text.tokens``.
    """
    # ``numbered`` bounds the list
    names = terms.orderBy("id").select("term").toArrow()["term"].combine_chunks()
    doc_id = corpus.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_id}, ids array<int>, values array<double>, others array<string>, other_values array<double>"

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(names.to_pylist())}.get
        for batch in batches:
            # a text may have 20,000 words
            for at in range(0, batch.num_rows, 500):
                yield _encoded(batch.slice(at, 500), number, share)

    return corpus.select("doc_id", "text").mapInArrow(counted, schema)


def _encoded(batch: pa.RecordBatch, number, share: bool) -> pa.RecordBatch:
    columns = [[], [], [], []]
    for text in batch.column("text").to_pylist():
        kept = "" if text is None else text.rstrip(" ")
        found = Counter(kept.split(" ")) if kept or text == "" else {}
        total = sum(found.values()) if share else 1
        known, others = [], []
        for term, n in found.items():
            i = number(term)
            if i is None:
                others.append((term, n / total))
            else:
                known.append((i, n / total))
        known.sort()
        for column, values in zip(columns, (*_apart(known), *_apart(others)), strict=True):
            column.append(values)
    types = [pa.list_(t) for t in (pa.int32(), pa.float64(), pa.string(), pa.float64())]
    arrays = [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]]
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "ids", "values", "others", "other_values"])


def _apart(pairs: list) -> tuple:
    return tuple(zip(*pairs, strict=True)) or ((), ())


def factors_of(terms: DataFrame, column: str) -> np.ndarray:
    return terms.orderBy("id").select(column).toArrow()[column].to_numpy()


def _flat(batch: pa.RecordBatch, factors: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, id, weight) of all entries of a batch."""
    ids, values = batch.column("ids"), batch.column("values")
    sizes = np.diff(ids.offsets.to_numpy())
    ids, weights = ids.flatten().to_numpy(), values.flatten().to_numpy()
    if factors is not None:
        weights = weights * factors[ids]
    return np.repeat(np.arange(batch.num_rows), sizes), ids, weights


def _summed(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    # of no values numpy counts in integers
    return np.bincount(at, values, n).astype(float)


def row_norms(rows: DataFrame, factors: np.ndarray | None) -> DataFrame:
    """(doc_id, norm) of the numbered entries."""

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, _, weights = _flat(batch, factors)
            norm = _summed(at, weights * weights, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(norm)], names=["doc_id", "norm"])

    doc_id = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "ids", "values").mapInArrow(squares, f"doc_id {doc_id}, norm double")


class Centres(NamedTuple):
    """Centroids of packed vectors: ``table`` by cluster and number of the term, ``rare`` (cluster, term, weight) or None.

    ``members`` (doc_id, cluster, part, alone) has the documents that a centroid is the mean of, the part each has in it
    and its ``alone``; None where terms of one document are not told apart."""

    table: np.ndarray
    rare: DataFrame | None
    members: DataFrame | None = None

    def norms(self) -> Column:
        """The squared norms by cluster as a map of literals."""
        squares = _squares(self.table)
        square = lambda c: F.col(c) * F.col(c)
        parts = [] if self.rare is None else [self.rare.select("cluster", square("weight").alias("_norm"))]
        if self.members is not None:
            parts.append(self.members.select("cluster", (F.col("alone") * square("part")).alias("_norm")))
        if parts:
            all_ = reduce(DataFrame.unionByName, parts)
            squares = _plus(squares, _by_cluster(all_.groupBy("cluster").agg(F.sum("_norm").alias("_norm")), "_norm"))
        return _literal_map(squares)

    def frame(self, vectors: Packed) -> DataFrame:
        """(cluster, term, weight)."""
        cluster, at = np.nonzero(self.table)
        flat = pa.table({"cluster": pa.array(cluster, pa.int32()), "id": pa.array(at, pa.int32()), "weight": pa.array(self.table[cluster, at])})
        known = vectors.terms.sparkSession.createDataFrame(flat).join(F.broadcast(vectors.terms), "id")
        out = known.select("cluster", "term", "weight")
        out = out if self.rare is None else out.unionByName(self.rare)
        if self.members is None:
            return out
        single = vectors.singles.join(self.members, "doc_id")
        return out.unionByName(single.select("cluster", "term", (F.col("weight") * F.col("part")).alias("weight")))


def _squares(table: np.ndarray) -> dict[int, float]:
    return {c: float(row @ row) for c, row in enumerate(table)}


def _plus(one: dict[int, float], other: dict[int, float]) -> dict[int, float]:
    return {c: one.get(c, 0.0) + other.get(c, 0.0) for c in one.keys() | other.keys()}


def _literal_map(values: dict[int, float]) -> Column:
    return F.create_map(*[F.lit(x) for item in sorted(values.items()) for x in item]).cast("map<int,double>")


def _by_cluster(found: DataFrame, value: str) -> dict:
    """{cluster: value} of a table with one row per cluster."""
    entries = F.map_from_entries(F.collect_list(F.struct("cluster", value)))
    return found.agg(entries.alias("_all")).first()[0]


def _stored(rare: DataFrame) -> DataFrame:
    table = materialize(rare.select(F.col("cluster").cast("int").alias("cluster"), "term", "weight"), "centroids")
    return broadcast_if_small(table, table.count())


def _table(found: DataFrame, n_terms: int, rows: int) -> np.ndarray:
    """(cluster, id, weight) as an array; ``numbered`` bounds it."""
    part = found.toArrow()
    cluster, at = part["cluster"].to_numpy(), part["id"].to_numpy()
    out = np.zeros((max(rows, int(cluster.max()) + 1 if len(cluster) else 1), max(1, n_terms)))
    np.add.at(out, (cluster, at), part["weight"].to_numpy())
    return out


def from_rows(centroids: DataFrame, vectors: Packed) -> Centres:
    """Centroids given as (cluster, term, weight)."""
    known = centroids.join(F.broadcast(vectors.terms), "term", "left")
    rare = _stored(known.filter(F.col("id").isNull()))
    return Centres(_table(known.filter("id IS NOT NULL").select("cluster", "id", "weight"), vectors.n_terms, 1), rare)


def of_documents(vectors: Packed, start: DataFrame) -> Centres:
    """The vectors of a few documents (cluster, doc_id) as centroids."""
    often, rare = sums(vectors, start)
    members = _members(vectors, start.withColumn("part", F.lit(1.0)))
    return Centres(_table(often, vectors.n_terms, 1), None if rare is None else _stored(rare), members)


def _members(vectors: Packed, parts: DataFrame, kept: DataFrame | None = None) -> DataFrame | None:
    if vectors.alone is None:
        return None
    parts = parts.select("doc_id", F.col("cluster").cast("int").alias("cluster"), "part").join(vectors.alone, "doc_id")
    return materialize(parts if kept is None else parts.unionByName(kept), "members")


def means(vectors: Packed, assignment: DataFrame, old: Centres) -> Centres:
    """The mean of the members of each cluster; a cluster without members stays."""
    sizes = _by_cluster(assignment.groupBy("cluster").agg(F.count("*").alias("_size")), "_size")
    often, rare = sums(vectors, assignment)
    table = _table(often, vectors.n_terms, max([len(old.table) - 1, *sizes]) + 1)
    for c, row in enumerate(table):
        if c in sizes:
            row /= sizes[c]
        elif c < len(old.table):
            row[:] = old.table[c]
    if rare is not None:
        weight = F.col("weight") / F.try_element_at(_literal_map(sizes), F.col("cluster")) if sizes else F.col("weight")
        rare = rare.select("cluster", "term", weight.alias("weight"))
    if old.rare is not None:
        kept = old.rare.filter(~F.col("cluster").isin([*sizes])) if sizes else old.rare
        rare = kept if rare is None else rare.unionByName(kept)
    members = None
    if vectors.alone is not None:
        part = F.lit(1.0) / F.try_element_at(_literal_map(sizes), F.col("cluster")) if sizes else F.lit(1.0)
        stay = None if old.members is None else old.members.filter(~F.col("cluster").isin([*sizes])) if sizes else old.members
        members = _members(vectors, assignment.withColumn("part", part), stay)
    return Centres(table, None if rare is None else _stored(rare), members)


def differences(old: Centres, new: Centres) -> DataFrame:
    """(cluster, _moved, _norm): squared length of the move and squared norm of the new centroid, by parts."""
    before = np.zeros_like(new.table)
    before[: len(old.table)] = old.table
    moved, norms = _squares(new.table - before), _squares(new.table)
    spark = SparkSession.active()
    out = spark.createDataFrame([(c, moved[c], norms[c]) for c in moved], "cluster int, _moved double, _norm double")
    if old.members is None or new.members is None:
        return out
    was = old.members.withColumns({"_d": -F.col("part"), "_w": F.lit(0.0)})
    both = was.unionByName(new.members.withColumns({"_d": F.col("part"), "_w": F.col("part")}))
    by_doc = both.groupBy("doc_id", "cluster").agg(F.sum("_d").alias("_d"), F.sum("_w").alias("_w"), F.first("alone").alias("_a"))
    square = lambda c: F.sum(F.col("_a") * F.col(c) * F.col(c))
    return out.unionByName(by_doc.groupBy("cluster").agg(square("_d").alias("_moved"), square("_w").alias("_norm")))


def met(vectors: Packed, centroids: Centres, shared: tuple[str, ...]) -> DataFrame:
    """(doc_id, cluster, _p): products of documents and the centroids that agree with them in ``shared``, by parts."""
    table, factors = centroids.table, vectors.factors
    doc_id = vectors.rows.schema["doc_id"].dataType.simpleString()

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            at, ids, weights = _flat(batch, factors)
            for theirs in _candidates(batch, shared, len(table)):
                own = np.broadcast_to(theirs, n)
                there = own < len(table)
                row = np.where(there, own, 0)
                factor = table[theirs][ids] if np.ndim(theirs) == 0 else table[row[at], ids]
                found = np.where(there, _summed(at, weights * factor, n), 0.0)
                columns = [batch.column("doc_id"), pa.array(own.astype(np.int32)), pa.array(found)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "cluster", "_p"])

    columns = ["doc_id", *shared, "ids", "values"]
    often = vectors.rows.select(*columns).mapInArrow(products, f"doc_id {doc_id}, cluster int, _p double")
    if centroids.members is not None:
        alone = (F.col("part") * F.col("alone")).alias("_p")
        often = often.unionByName(centroids.members.select("doc_id", "cluster", alone))
    if vectors.rare is None or centroids.rare is None:
        return often
    theirs = centroids.rare
    for c in shared:
        theirs = theirs if c == "cluster" else theirs.withColumn(c, F.shiftright("cluster", 1))
    theirs = theirs.withColumnRenamed("weight", "_c")
    seldom = vectors.rare.join(theirs, [*shared, "term"])
    return often.unionByName(seldom.select("doc_id", "cluster", (F.col("weight") * F.col("_c")).alias("_p")))


def _candidates(batch: pa.RecordBatch, shared: tuple[str, ...], clusters: int) -> list:
    """The clusters that the rows meet, one of each row at a time."""
    if not shared:
        return [*range(clusters)]
    own = batch.column(shared[0]).to_numpy()
    return [own] if shared == ("cluster",) else [2 * own, 2 * own + 1]


def sums(vectors: Packed, members: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The summed vectors of the documents of each cluster: (cluster, id, weight), and (cluster, term, weight) of terms without a number."""
    n_terms, factors = max(1, vectors.n_terms), vectors.factors
    found = vectors.joined(members.select("doc_id", F.col("cluster").cast("int").alias("cluster")))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            at, ids, weights = _flat(batch, factors)
            own = batch.column("cluster").to_numpy()
            for c in np.unique(own):
                mine = (own == c)[at]
                total = totals.setdefault(c, np.zeros(n_terms))
                total += _summed(ids[mine], weights[mine], n_terms)
        for c, total in totals.items():
            at = np.flatnonzero(total)
            for i in range(0, len(at), 100_000):
                part = at[i : i + 100_000]
                columns = [pa.array(np.full(len(part), c, np.int32)), pa.array(part.astype(np.int32)), pa.array(total[part])]
                yield pa.RecordBatch.from_arrays(columns, names=["cluster", "id", "weight"])

    often = found.rows.select("cluster", "ids", "values").mapInArrow(summed, "cluster int, id int, weight double")
    often = often.groupBy("cluster", "id").agg(F.sum("weight").alias("weight"))
    if found.rare is None:
        return often, None
    return often, found.rare.groupBy("cluster", "term").agg(F.sum("weight").alias("weight"))
