"""Keys by which words of 23 bits that differ in at most one bit meet.

The binary Golay code has 4,096 code words, and every word of 23 bits lies within three
bits of exactly one of them.  A word with an odd number of ones gets the index of its own
code word.  A word with an even number gets that one too, and, if it lies three bits away,
the five code words that lie four bits away.  Words that differ in one bit are one odd and
one even: the odd one's code word lies within four bits of the even one, so they share a key.
"""

from __future__ import annotations

import numpy as np

#: The code's generator x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
_GENERATOR = 0b110001110101
#: Keys of a word, at most.
MOST = 6


def _remainder(word: int) -> int:
    for shift in range(11, -1, -1):
        if word >> (shift + 11) & 1:
            word ^= _GENERATOR << shift
    return word


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(remainders of each byte at each of three places, the errors of each remainder, and for
    each remainder of three errors the indices of the five code words around)."""
    bytes_ = np.array([[_remainder(b << 8 * place) if b << 8 * place < 1 << 23 else 0 for b in range(256)] for place in range(3)], np.int64)
    errors, spots = np.zeros(2048, np.int64), range(23)
    for a in spots:
        for b in range(a + 1):
            for c in range(b + 1):
                e = 1 << a | 1 << b | 1 << c
                errors[_remainder(e)] = e
    around: dict[int, list[int]] = {}
    for top in range(1, 4096):
        word = top << 11
        word |= _remainder(word)
        if word.bit_count() == 7:
            ones = [1 << i for i in spots if word >> i & 1]
            for i, x in enumerate(ones):
                for j, y in enumerate(ones[:i]):
                    for z in ones[:j]:
                        around.setdefault(x | y | z, []).append(top)
    near = np.zeros((2048, MOST - 1), np.int64)
    for e, tops in around.items():
        near[_remainder(e)] = tops
    return bytes_, errors, near


_BYTES, _ERRORS, _AROUND = _tables()
_THREE = np.bitwise_count(_ERRORS) == 3


def keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(indices, valid), each of ``MOST`` columns: the code words' indices (12 bits) of words below 2**23."""
    words = words.astype(np.int64)
    rest = _BYTES[0][words & 255] ^ _BYTES[1][words >> 8 & 255] ^ _BYTES[2][words >> 16]
    own = (words ^ _ERRORS[rest]) >> 11
    out = np.column_stack([own, own[:, None] ^ _AROUND[rest]])
    valid = np.zeros(out.shape, bool)
    valid[:, 0] = True
    valid[:, 1:] = (_THREE[rest] & (np.bitwise_count(words) % 2 == 0))[:, None]
    return out, valid
