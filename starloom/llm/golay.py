"""The perfect binary Golay code on 23-bit words, vectorised.

Generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 (a fixed value).
Every 23-bit word has exactly one codeword within three bits. ``keys`` gives
the codewords that the word and its one-bit neighbours decode to: one if the
word is within two bits of its codeword, six otherwise. Two words that differ
in at most two bits share one of them.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

LENGTH = 23
GENERATOR = 0b110001110101
#: Most codewords of one word.
MOST = 6


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


_made: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes by low and high half of a word, and per syndrome the bits that lead to its codewords."""
    if not _made:
        _made.append(_make())
    return _made[0]


def _make() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = np.array([_remainder(w) for w in range(1 << 12)], np.uint32)
    high = np.array([_remainder(w << 12) for w in range(1 << 11)], np.uint32)
    leader = {0: 0}
    for weight in (1, 2, 3):
        for bits in combinations(range(LENGTH), weight):
            e = sum(1 << b for b in bits)
            leader[_remainder(e)] = e
    steps = np.zeros((1 << 11, MOST), np.uint32)
    for s, e in leader.items():
        near = {e} | {1 << b ^ leader[s ^ _remainder(1 << b)] for b in range(LENGTH)}
        ways = sorted(near, key=lambda x: (x.bit_count(), x))
        steps[s] = (ways + ways[:1] * MOST)[:MOST]
    return low, high, steps


def keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices (rows of MOST, 12 bits each) of 23-bit words, and which are distinct."""
    low, high, steps = _tables()
    words = words.astype(np.uint32)
    syndrome = low[words & 0xFFF] ^ high[words >> 12]
    ways = steps[syndrome]
    index = (words[:, None] ^ ways) >> 11  # the upper 12 bits tell codewords apart
    fresh = np.ones(index.shape, bool)
    fresh[:, 1:] = ways[:, 1:] != ways[:, :1]
    return index.astype(np.uint64), fresh
