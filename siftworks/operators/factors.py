"""Half a round of alternating least squares, as sums per entity and a closed solution.

With the factors of one side fixed, those of the other solve one small linear system per
entity: A x = b, where A is the sum of v v' over the factors v of what the entity has rated,
with ``reg`` times the number of its ratings on the diagonal, and b the sum of rating * v.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.sources.shared import materialize


def _cell(i: int, j: int) -> str:
    return f"_a{min(i, j)}_{max(i, j)}"


def normal_equations(ratings: DataFrame, factors: DataFrame, entity: str, other: str, rank: int) -> DataFrame:
    """(entity, n, _a<i>_<j> for i <= j, _b<i>): the sums of each entity's system, without ``reg``.

    ``factors`` is (other, factors) with an array of ``rank`` numbers; ratings without factors take no
    part. The sums are combined before the shuffle, so a hot entity is one row per map task.
    """
    v = [F.get("factors", F.lit(i)) for i in range(rank)]
    gram = [F.sum(v[i] * v[j]).alias(_cell(i, j)) for i in range(rank) for j in range(i, rank)]
    right = [F.sum(F.col("rating") * v[i]).alias(f"_b{i}") for i in range(rank)]
    met = ratings.select(entity, other, "rating").join(factors.select(other, "factors"), other)
    return met.groupBy(entity).agg(F.count("*").alias("n"), *gram, *right)


def solve(systems: DataFrame, entity: str, rank: int, reg: float) -> DataFrame:
    """(entity, n, factors) from ``normal_equations``, by the square root free Cholesky decomposition.

    Each step is a column of the same row: with L unit lower triangular, A = L D L'. A pivot that is
    not positive, as ``reg = 0`` allows, gives NULL.
    """
    out = systems
    for j in range(rank):
        pivot: Column = F.col(_cell(j, j)) + F.lit(reg) * F.col("n")
        for m in range(j):
            pivot = pivot - F.col(f"_l{j}_{m}") * F.col(f"_l{j}_{m}") * F.col(f"_d{m}")
        out = out.withColumn(f"_d{j}", F.when(pivot > 0, pivot))
        below = {}
        for i in range(j + 1, rank):
            rest: Column = F.col(_cell(i, j))
            for m in range(j):
                rest = rest - F.col(f"_l{i}_{m}") * F.col(f"_l{j}_{m}") * F.col(f"_d{m}")
            below[f"_l{i}_{j}"] = rest / F.col(f"_d{j}")
        out = out.withColumns(below) if below else out
    for i in range(rank):
        forward: Column = F.col(f"_b{i}")
        for m in range(i):
            forward = forward - F.col(f"_l{i}_{m}") * F.col(f"_y{m}")
        out = out.withColumn(f"_y{i}", forward)
    for i in reversed(range(rank)):
        back: Column = F.col(f"_y{i}") / F.col(f"_d{i}")
        for m in range(i + 1, rank):
            back = back - F.col(f"_l{m}_{i}") * F.col(f"_x{m}")
        out = out.withColumn(f"_x{i}", back)
    return out.select(entity, "n", F.array(*[f"_x{i}" for i in range(rank)]).alias("factors"))


def half_step(
    ratings: DataFrame, factors: DataFrame, entity: str, other: str, rank: int = 3, reg: float = 0.3
) -> DataFrame:
    """(entity, n, factors): the best factors of ``entity`` for the given ones of ``other``.

    The factors are read from a stored table, so that adaptive execution can split the rows of a hot
    ``other``, or broadcast the table by its real size.
    """
    stored = materialize(factors.select(other, "factors"), "factors")
    return solve(normal_equations(ratings, stored, entity, other, rank), entity, rank, reg)


def hashed_start(entities: DataFrame, entity: str, rank: int = 3, seed: int = 42) -> DataFrame:
    """(entity, factors): start factors between 0 and 1 that depend on the entity's id alone."""

    def part(i: int) -> Column:
        digest = F.md5(F.concat(F.lit(f"{seed}-{i}-"), F.col(entity).cast("string")).cast("binary"))
        return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))

    return entities.select(entity).distinct().select(entity, F.array(*[part(i) for i in range(rank)]).alias("factors"))


def residuals(ratings: DataFrame, users: DataFrame, items: DataFrame, rank: int = 3, reg: float = 0.3) -> DataFrame:
    """(user, residual): how far each user's fitted factors are from the solution for the fitted item factors.

    The largest difference over the factors, relative to the largest factor of the solution.
    """
    best = half_step(ratings, items, "user", "item", rank, reg).withColumnRenamed("factors", "_best")
    off = F.array_max(F.zip_with("factors", "_best", lambda x, y: F.abs(x - y)))
    scale = F.array_max(F.transform("_best", F.abs))
    return users.join(best, "user").select("user", F.coalesce(F.try_divide(off, scale), off).alias("residual"))
