"""The perfect binary Golay code [23, 12, 7] as a fuzzy hash.

Every 23-bit word is within 3 bits of exactly one codeword. A word at most 2
bits away gets that codeword's index alone; a word 3 bits away also gets the
five codewords 4 bits away. Two words that differ in at most 2 bits then share
an index: if their codewords differ, one word is 3 bits from its own and the
other's codeword is among the five.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

WORD, MESSAGE = 23, 12
#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
GENERATOR = 0b110001110101


def _remainder(word: int) -> int:
    for i in range(WORD - 1, WORD - MESSAGE - 1, -1):
        if word >> i & 1:
            word ^= GENERATOR << (i - (WORD - MESSAGE))
    return word


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits; error patterns by syndrome, and how many count."""
    bit = [_remainder(1 << i) for i in range(WORD)]

    def spread(at: list[int]) -> np.ndarray:
        out = np.zeros(1, "i4")
        for b in at:
            out = np.concatenate([out, out ^ b])
        return out

    errors, count = np.zeros((1 << (WORD - MESSAGE), 6), "i4"), np.ones(1 << (WORD - MESSAGE), "i4")
    for weight in range(5):
        for at in combinations(range(WORD), weight):
            s = 0
            for i in at:
                s ^= bit[i]
            pattern = sum(1 << i for i in at)
            if weight < 4:
                errors[s, 0] = pattern
            else:
                errors[s, count[s]] = pattern
                count[s] += 1
    return spread(bit[:12]), spread(bit[12:]), errors, count


def indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices of 23-bit words (n x 6), and which of them count (n x 6)."""
    low, high, errors, count = _tables()
    words = words.astype("i4")
    s = low[words & 0xFFF] ^ high[words >> 12]
    return (words[:, None] ^ errors[s]) >> (WORD - MESSAGE), np.arange(6) < count[s][:, None]
