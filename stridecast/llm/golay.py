"""The binary Golay code (23, 12): nearby codewords of any 23-bit word.

The code is perfect: spheres of radius 3 fill the space. A word at distance 3
from its codeword has five more at distance 4. Two words that differ in at most
two bits share at least one of these codewords.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainder of the low 12 and the high 11 bits; the error patterns of every remainder, -1 where there is none."""
    low = np.array([_remainder(x) for x in range(1 << 12)], np.int64)
    high = np.array([_remainder(x << 12) for x in range(1 << 11)], np.int64)
    single = [_remainder(1 << i) for i in range(23)]
    patterns: list[list[int]] = [[] for _ in range(1 << 11)]
    least = [9] * (1 << 11)
    for weight in range(5):
        for bits in combinations(range(23), weight):
            rest = error = 0
            for bit in bits:
                rest ^= single[bit]
                error |= 1 << bit
            if weight < 4:
                least[rest] = weight
            if weight < 4 or least[rest] == 3:
                patterns[rest].append(error)
    return low, high, np.array([p + [-1] * (6 - len(p)) for p in patterns], np.int64)


def indices(words: np.ndarray) -> np.ndarray:
    """12-bit numbers of the nearby codewords of each 23-bit word: six columns, -1 where there are fewer."""
    low, high, patterns = _tables()
    errors = patterns[low[words & 0xFFF] ^ high[words >> 12]]
    return np.where(errors >= 0, (words[:, None] ^ errors) >> 11, -1)
