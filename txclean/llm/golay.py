"""The binary Golay code of length 23: every word lies within 3 bits of one codeword."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

#: Fixed value: generator x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
LENGTH, CHECKS = 23, 11


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECKS)
    return word


@lru_cache(maxsize=1)
def _tables():
    """Remainders of each byte of a word; by remainder, the error to the nearest codeword and
    the errors of weight 4 to the next ones, if the nearest is 3 away."""
    by_byte = np.array(
        [[_remainder((b << s) & (1 << LENGTH) - 1) for b in range(256)] for s in (0, 8, 16)], np.int32
    )
    nearest = np.zeros(1 << CHECKS, np.int32)
    single = [_remainder(1 << i) for i in range(LENGTH)]
    further: dict[int, list[int]] = {}
    for weight in range(1, 5):
        for bits in combinations(range(LENGTH), weight):
            rest = error = 0
            for b in bits:
                rest ^= single[b]
                error |= 1 << b
            if weight < 4:
                nearest[rest] = error
            else:
                further.setdefault(rest, []).append(error)
    others = np.full((1 << CHECKS, 5), -1, np.int32)
    for rest, errors in further.items():
        others[rest] = errors
    return by_byte, nearest, others


def nearby(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each 23-bit word the index of its codeword (12 bits), and an n x 6 array of the
    indices of all codewords within 4 bits, that one first, padded with -1.

    Two words that differ in at most 2 bits share one of the six: the codeword of a
    word halfway is within 3 of it, so within 4 of both.
    """
    by_byte, nearest, others = _tables()
    words = words.astype(np.int32)
    rest = by_byte[0][words & 255] ^ by_byte[1][words >> 8 & 255] ^ by_byte[2][words >> 16]
    first = (words ^ nearest[rest]) >> CHECKS
    more = others[rest]
    further = np.where(more < 0, -1, (words[:, None] ^ np.maximum(more, 0)) >> CHECKS)
    return first, np.concatenate([first[:, None], further], axis=1)
