"""Embedding whitening: vectors projected on the main components of their integer scatter and scaled to unit variance."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from functools import cached_property
from math import sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.llm import exact_eigen
from siftworks.llm.text import free_names
from siftworks.sources.shared import materialize

# An entry c becomes floor(SCALE * c).
SCALE = 256

SUMS = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("total", pa.decimal128(38, 0))])


def usable(vector: str) -> Column:
    """True for a vector without NULL, NaN and infinite entries."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))


def integers(vector: str, dimensions: int, scale: int = SCALE) -> Column:
    """The scaled and floored entries; shorter vectors end in zeros."""
    x = F.transform(vector, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))
    return F.concat(x, F.array_repeat(F.lit(0).cast("bigint"), F.lit(dimensions) - F.size(vector)))


def matrix_of(vectors: pa.ListArray, dimensions: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), dimensions)


def products(x: np.ndarray) -> np.ndarray:
    """x^T x without rounding: in doubles or 64-bit integers where all sums are exact in them."""
    largest = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    if len(x) * largest**2 < 1 << 53:
        f = x.astype(np.float64)
        return (f.T @ f).astype(np.int64)
    if len(x) * largest**2 < 1 << 63:
        return x.T @ x
    wide = x.astype(object)
    return wide.T @ wide


def _sums(dimensions: int):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of all products of a task's vectors, with a constant 1 as a last entry."""
        total = np.zeros((dimensions + 1, dimensions + 1), dtype=object)
        for batch in batches:
            x = matrix_of(batch.column(0), dimensions)
            total += products(np.hstack([x, np.ones((len(x), 1), dtype=np.int64)]))
        i, j = np.triu_indices(dimensions + 1)
        values = [Decimal(int(v)) for v in total[i, j]]
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(values, SUMS[2].type)], schema=SUMS)

    return sums


class Whitening:
    """Components fitted on the distinct integer vectors of ``df``.

    n, sums, scatter (n times the sum of products less the product of sums: n ** 2 times the
    covariance, exact integers), eigenvalues of the scatter (fractions) and components (unit vectors).
    Rows whose vector is NULL or holds a NULL, NaN or infinite entry take no part. Vectors shorter
    than the longest count as ending in zeros. Components without variance are left
    out, so a table of one distinct vector, of empty vectors or of no rows has none.

    Distinct vectors are found by a grouping with partial aggregation, so copies cost little. Only the
    sums, as many as pairs of dimensions, reach the driver.
    """

    def __init__(self, df: DataFrame, vector: str = "embedding", n_components: int = 4, scale: int = SCALE):
        self.vector, self.scale = vector, scale
        clean = df.select(F.col(vector)).filter(usable(vector))
        self.dimensions = clean.agg(F.max(F.size(vector))).first()[0] or 0
        distinct = clean.select(integers(vector, self.dimensions, scale).alias("x")).distinct()
        self.fit = materialize(distinct, "whitening_fit")
        sums = self.fit.mapInArrow(_sums(self.dimensions), "i int, j int, total decimal(38,0)").groupBy("i", "j").agg(F.sum("total").alias("total"))
        total = {(r.i, r.j): int(r.total) for r in sums.collect()}
        d = self.dimensions
        self.n = total.get((d, d), 0)
        self.sums = [total.get((i, d), 0) for i in range(d)]
        self.scatter = [
            [self.n * total.get((min(i, j), max(i, j)), 0) - self.sums[i] * self.sums[j] for j in range(d)] for i in range(d)
        ]
        self.trace = sum(self.scatter[i][i] for i in range(d))
        self.eigenvalues, self.components = [], []
        if self.trace:
            poly = exact_eigen.charpoly(df.sparkSession, self.scatter)
            self.eigenvalues = exact_eigen.largest_roots(poly, n_components, self.trace)
            self.components = [[float(x) for x in v] for v in exact_eigen.null_vectors(self.scatter, self.eigenvalues)]

    @property
    def explained(self) -> list[float]:
        """The share of each component in the sum of all variances."""
        return [float(e / self.trace) for e in self.eigenvalues]

    def _applied(self, x: Column) -> Column:
        """(deviation, whitened) of an integer vector."""
        n, sums, components, roots = self.n, self.sums, self.components, [sqrt(e) for e in self.eigenvalues]

        @F.pandas_udf("deviation decimal(38,0), whitened array<double>")
        def applied(vectors: pd.Series) -> pd.DataFrame:
            rows = np.stack(vectors.tolist()) if len(vectors) else np.zeros((0, len(sums)), dtype=np.int64)
            largest = max(abs(int(rows.max(initial=0))), abs(int(rows.min(initial=0)))) * n + max(map(abs, sums), default=0)
            kind = np.int64 if len(sums) * largest**2 < 1 << 63 else object
            centred = rows.astype(kind) * n - np.array(sums, dtype=kind)
            deviation = [Decimal(int(v)) for v in (centred * centred).sum(axis=1)]
            # the scatter is n ** 2 times the covariance, as the centred vectors are n times too long
            whitened = centred.astype(np.float64) @ np.array(components, dtype=np.float64).reshape(len(roots), len(sums)).T / np.array(roots)
            return pd.DataFrame({"deviation": deviation, "whitened": list(whitened)})

        return applied(x)

    def apply(self, df: DataFrame) -> DataFrame:
        """The usable rows of ``df`` with deviation (the exact sum of squares of n x - sums) and whitened (one double per component).

        The rows need not be those fitted, but no vector may be longer. Columns of these names are replaced, all others stay.
        """
        (done,) = free_names(df.columns, "done")
        kept = df.drop(*[c for c in ("deviation", "whitened") if c != self.vector]).filter(usable(self.vector))
        out = kept.withColumn(done, self._applied(integers(self.vector, self.dimensions, self.scale)))
        return out.withColumns({"deviation": F.col(f"{done}.deviation"), "whitened": F.col(f"{done}.whitened")}).drop(done)

    @cached_property
    def identity_error(self) -> float | None:
        """The largest entry by which the covariance of the whitened fit list differs from the identity."""
        k = len(self.components)
        if not k:
            return None
        applied = self.fit.select(self._applied(F.col("x")).alias("a")).select(*[F.col("a.whitened")[i].alias(f"w{i}") for i in range(k)])
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        found = applied.agg(*[F.covar_pop(f"w{i}", f"w{j}") for i, j in pairs]).first()
        return max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs))
