"""The perfect binary Golay code of length 23: nearest codewords, vectorised over numpy arrays.

Every 23-bit word lies within three bits of exactly one codeword, so it has one
nearest codeword, named by a 12-bit index. Words one bit apart share a codeword
among those of their one-bit neighbours.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

# The generator polynomial x^11+x^10+x^6+x^5+x^4+x^2+1 and the code's sizes.
GENERATOR = 0b110001110101
LENGTH, INDEX_BITS, CHECK_BITS, RADIUS = 23, 12, 11, 3


def _remainder(word: int) -> int:
    for i in range(LENGTH - 1, CHECK_BITS - 1, -1):
        if word >> i & 1:
            word ^= GENERATOR << (i - CHECK_BITS)
    return word


def _error_table() -> np.ndarray:
    """The error of at most three bits for each of the 2048 syndromes."""
    bits = [_remainder(1 << i) for i in range(LENGTH)]
    table = np.zeros(1 << CHECK_BITS, dtype=np.int64)
    for weight in range(1, RADIUS + 1):
        for places in combinations(range(LENGTH), weight):
            syndrome = 0
            for i in places:
                syndrome ^= bits[i]
            table[syndrome] = sum(1 << i for i in places)
    return table


def _half_syndromes(first: int, count: int) -> np.ndarray:
    """Syndromes of all words of ``count`` bits that begin at bit ``first``."""
    table = np.zeros(1, dtype=np.int64)
    for i in range(count):
        table = np.concatenate([table, table ^ _remainder(1 << (first + i))])
    return table


ERRORS = _error_table()
LOW, HIGH = _half_syndromes(0, 12), _half_syndromes(12, 11)


def nearest(words: np.ndarray) -> np.ndarray:
    """Index of the codeword nearest to each word."""
    syndromes = LOW[words & 0xFFF] ^ HIGH[words >> 12]
    return (words ^ ERRORS[syndromes]) >> CHECK_BITS


def neighbours(words: np.ndarray, bits: int) -> np.ndarray:
    """Per word the indices of the codewords nearest to it after any one of its low ``bits`` flips.

    One row per word; repeated indices are -1.
    """
    found = np.sort(nearest(words[:, None] ^ (1 << np.arange(bits))[None, :]), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return found
