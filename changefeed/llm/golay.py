"""Neighbouring indices of 23-bit words under the binary Golay code.

The code has 4096 codewords and every 23-bit word lies within three bits of
exactly one of them. A word's *index* is that codeword's 12 data bits. Flipping
any single bit first gives the indices of its neighbours: one alone where the
codeword is at most two bits away, six otherwise. Words one bit apart always
meet: the index of either is among the neighbouring indices of the other.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

# Fixed value: a generator polynomial of the binary Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
BITS, CHECK_BITS = 23, 11


def _remainder(word: int) -> int:
    for bit in range(BITS - 1, CHECK_BITS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK_BITS)
    return word


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    high = np.array([_remainder(x << 12) for x in range(1 << CHECK_BITS)], np.uint16)
    low = np.array([_remainder(x) for x in range(1 << 12)], np.uint16)
    errors = np.zeros(1 << CHECK_BITS, np.uint32)
    for weight in range(1, 4):
        for at in combinations(range(BITS), weight):
            pattern = sum(1 << i for i in at)
            errors[_remainder(pattern)] = pattern
    return high, low, errors


def index(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the codeword nearest to each 23-bit word."""
    high, low, errors = _tables()
    return ((words ^ errors[high[words >> 12] ^ low[words & 4095]]) >> CHECK_BITS).astype(np.uint16)


def indices(words: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring indices of words that use the lowest ``bits`` bits alone.

    Returns a row of candidates for each word and a mask that marks each
    different one once.
    """
    flips = np.concatenate(([0], 1 << np.arange(bits))).astype(np.uint32)
    found = np.sort(index(words.astype(np.uint32)[:, None] ^ flips[None, :]), axis=1)
    first = np.ones(found.shape, bool)
    first[:, 1:] = found[:, 1:] != found[:, :-1]
    return found, first
