"""Fuzzy keys from the binary Golay code of length 23.

The code is perfect: every word of 23 bits lies within 3 bits of exactly one codeword.
A word's keys are the codewords within 4 bits of it. A word at distance 3 from its nearest
codeword has six keys, every other word has one. Two facts make them fuzzy keys:

* words at most 2 bits apart share a key, and
* words at most 1 bit apart have the nearest codeword of each among the keys of the other.
"""

from functools import lru_cache
from itertools import combinations

import numpy as np

LENGTH, CHECKS = 23, 11
#: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, which generates the cyclic code.
GENERATOR = 0b101011100011
#: Keys of a word at most.
MOST_KEYS = 6


def _remainders(words: np.ndarray) -> np.ndarray:
    """Remainders modulo the generator: the syndromes."""
    out = words.astype("u4").copy()
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        out ^= np.where(out >> np.uint32(bit) & np.uint32(1), np.uint32(GENERATOR << (bit - CHECKS)), np.uint32(0))
    return out


def _patterns(weight: int) -> np.ndarray:
    return np.array([sum(1 << b for b in bits) for bits in combinations(range(LENGTH), weight)], "u4")


@lru_cache(maxsize=1)
def corrections() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the error patterns of weight up to 4, nearest first, and how many there are."""
    table = np.zeros((1 << CHECKS, MOST_KEYS), "u4")
    filled = np.zeros(1 << CHECKS, "i8")
    for weight in range(5):
        patterns = _patterns(weight)
        syndromes = _remainders(patterns)
        order = np.argsort(syndromes, kind="stable")
        patterns, syndromes = patterns[order], syndromes[order]
        nth = np.arange(len(syndromes)) - np.searchsorted(syndromes, syndromes, side="left")
        table[syndromes, filled[syndromes] + nth] = patterns
        filled += np.bincount(syndromes, minlength=1 << CHECKS)
    return table, filled


@lru_cache(maxsize=1)
def _syndromes() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits; that of a word is their sum."""
    low, high = np.arange(1 << 12), np.arange(1 << 11) << 12
    return _remainders(low), _remainders(high)


def keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices (12 bits) of the codewords within 4 bits, nearest first: words x 6, and counts.

    The code is systematic: a codeword is told by its bits above the check bits.
    """
    words = words.astype("u4")
    low, high = _syndromes()
    syndrome = low[words & np.uint32(0xFFF)] ^ high[words >> np.uint32(12)]
    patterns, filled = corrections()
    return (words[:, None] ^ patterns[syndrome]) >> np.uint32(CHECKS), filled[syndrome]
