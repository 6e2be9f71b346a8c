"""Eigenvalues and eigenvectors of an integer positive semidefinite matrix from its exact characteristic polynomial.

The polynomial is taken modulo many primes by reduction to Hessenberg form and put together
by Chinese remainders. All its roots are real, so the sign changes of the shifted
polynomial count the roots above any point exactly, with multiplicity; bisection on this count
isolates the largest roots, and signs refine them. Eigenvectors come from inverse
iteration in decimals of many digits. All inputs are as long as the matrix, never as the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal, localcontext
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

# Primes below this have residues whose products fit into signed 64-bit integers.
PRIME_LIMIT = 1 << 31

# Binary digits of the largest eigenvalues, and decimal digits in which their vectors are found.
ROOT_BITS, DIGITS = 160, 100

Matrix = list[list[int]]


def is_prime(n: int) -> bool:
    """Exact for n below 3 * 10 ** 24 (Miller and Rabin with the first 13 primes as bases)."""
    bases = (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37, 41)
    if n < 2 or any(n % b == 0 for b in bases):
        return n in bases
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for b in bases:
        x = pow(b, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """The largest primes below ``PRIME_LIMIT`` whose product exceeds ``bound``."""
    found, product, candidate = [], 1, PRIME_LIMIT - 1
    while product <= bound:
        if is_prime(candidate):
            found.append(candidate)
            product *= candidate
        candidate -= 2
    return found


def hessenberg(matrix: np.ndarray, p: int) -> np.ndarray:
    """A similar matrix modulo ``p`` that is zero below its first subdiagonal."""
    h = matrix % p
    for k in range(1, len(h) - 1):
        filled = np.flatnonzero(h[k:, k - 1])
        if not len(filled):
            continue
        pivot = k + filled[0]
        if pivot != k:
            h[[k, pivot]] = h[[pivot, k]]
            h[:, [k, pivot]] = h[:, [pivot, k]]
        factors = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - factors[:, None] * h[k]) % p
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * factors % p).sum(axis=1)) % p
    return h


def charpoly_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """The coefficients of det(x - matrix) modulo ``p``, constant first."""
    h = hessenberg(matrix, p)
    d = len(h)
    minors = np.zeros((d + 1, d + 1), dtype=np.int64)  # of the leading blocks
    minors[0, 0] = 1
    for k in range(1, d + 1):
        row = np.zeros(d + 1, dtype=np.int64)
        row[1:] = minors[k - 1, :-1]
        weights, product = np.zeros(k, dtype=np.int64), 1
        for i in range(k - 1, -1, -1):
            weights[i] = int(h[i, k - 1]) * product % p
            product = product * int(h[i, i - 1]) % p if i else 0
        minors[k] = (row - (weights[:, None] * minors[:k] % p).sum(axis=0)) % p
    return minors[d]


def _residues(matrix: Matrix):
    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).to_pylist()
            out = [charpoly_mod(np.array([[x % p for x in row] for row in matrix], dtype=np.int64), p).tolist() for p in found]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(out, pa.list_(pa.int64()))], ["p", "coefficients"])

    return residues


def charpoly(spark: SparkSession, matrix: Matrix) -> list[int]:
    """The integer coefficients of det(x - matrix), constant first; each prime is a row of a Spark job.

    The k-th elementary symmetric function of d nonnegative eigenvalues is at most that of d equal
    ones with the same sum, the trace, which bounds the coefficients.
    """
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    bound = max(-(-comb(d, k) * trace**k // d**k) for k in range(d + 1))
    primes = primes_beyond(2 * bound + 1)
    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(min(len(primes), spark.sparkContext.defaultParallelism))
    # one row per prime: their number follows from the matrix, not from the data
    residues = {r.p: r.coefficients for r in rows.mapInArrow(_residues(matrix), "p long, coefficients array<long>").collect()}
    modulus = 1
    for p in primes:
        modulus *= p
    weights = {p: modulus // p * pow(modulus // p, -1, p) for p in primes}
    out = []
    for i in range(d + 1):
        value = sum(weights[p] * residues[p][i] for p in primes) % modulus
        out.append(value - modulus if 2 * value > modulus else value)
    return out


def roots_above(poly: list[int], at: int) -> int:
    """The number of roots above ``at``, with multiplicity, of a polynomial whose roots are all real."""
    c = poly[::-1]
    for stop in range(len(c) - 1, 0, -1):
        for i in range(1, stop + 1):
            c[i] += at * c[i - 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def value(poly: list[int], at: int) -> int:
    out = 0
    for c in reversed(poly):
        out = out * at + c
    return out


def largest_roots(poly: list[int], count: int, above: int, bits: int = ROOT_BITS) -> list[Fraction]:
    """The positive ones of the ``count`` largest roots, falling, repeated by multiplicity.

    ``above`` is at least as large as every root. Each is too large by less than 2 to the minus
    (``bits`` minus the bits of ``above``); equal roots come out equal.
    """
    shift = max(0, bits - above.bit_length())
    d = len(poly) - 1
    scaled = [c << shift * (d - k) for k, c in enumerate(poly)]
    counts: dict[int, int] = {}

    def n_above(at: int) -> int:
        if at not in counts:
            counts[at] = roots_above(scaled, at)
        return counts[at]

    out = []
    for j in range(1, min(count, n_above(0)) + 1):
        # the j-th root is above low and not above high
        low = max((at for at, n in counts.items() if n >= j), default=0)
        high = min([at for at, n in counts.items() if n < j], default=(above << shift) + 1)
        while high - low > 1 and n_above(low) - n_above(high) > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if n_above(middle) >= j else (low, middle)
        if high - low > 1:
            # one simple root is left: the sign tells on which side of it a place is
            below = value(scaled, low)
            while high - low > 1:
                middle = (low + high) // 2
                here = value(scaled, middle)
                same = here != 0 and (here > 0) == (below > 0) if below else here != 0 and (here > 0) != (value(scaled, high) > 0)
                low, high = (middle, high) if same else (low, middle)
        out.append(Fraction(high, 1 << shift))
    return out


def null_vectors(matrix: Matrix, eigenvalues: list[Fraction], digits: int = DIGITS) -> list[list[Decimal]]:
    """A unit eigenvector for each eigenvalue, orthogonal to those before it; the largest entry is positive."""
    found: list[np.ndarray] = []
    with localcontext() as context:
        context.prec = digits
        exact = np.array([[Decimal(x) for x in row] for row in matrix], dtype=object)
        size = max(map(abs, exact.ravel()), default=Decimal(1)) or Decimal(1)
        tiny = size.scaleb(-digits)
        for j, root in enumerate(eigenvalues):
            near = Decimal(root.numerator) / Decimal(root.denominator)
            lu, order = exact.copy(), list(range(len(matrix)))
            for k in range(len(lu)):
                lu[k, k] = lu[k, k] - near
            for k in range(len(lu)):
                pivot = k + max(range(len(lu) - k), key=lambda i: abs(lu[k + i, k]))
                lu[[k, pivot]], order[k], order[pivot] = lu[[pivot, k]], order[pivot], order[k]
                if abs(lu[k, k]) < tiny:
                    lu[k, k] = tiny
                lu[k + 1 :, k] = lu[k + 1 :, k] / lu[k, k]
                lu[k + 1 :, k + 1 :] = lu[k + 1 :, k + 1 :] - np.outer(lu[k + 1 :, k], lu[k, k + 1 :])
            # different starts, so that equal eigenvalues give different vectors
            vector = np.array([Decimal(1) / Decimal(1 + (i * (j + 1) + j) % 101) for i in range(len(lu))], dtype=object)
            for _ in range(3):
                y = vector[order]
                for i in range(1, len(lu)):
                    y[i] = y[i] - np.dot(lu[i, :i], y[:i])
                for i in range(len(lu) - 1, -1, -1):
                    y[i] = (y[i] - np.dot(lu[i, i + 1 :], y[i + 1 :])) / lu[i, i]
                y = y / max(map(abs, y))
                for other in found:
                    y = y - np.dot(other, y) * other
                vector = y / np.dot(y, y).sqrt()
            found.append(vector * (1 if max(vector, key=abs) > 0 else -1))
    return [v.tolist() for v in found]
