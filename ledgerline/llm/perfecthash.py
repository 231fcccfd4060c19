"""Minimal perfect hashing of integer keys, a shard at a time, with numpy.

A shard's function is a cascade of bit arrays: a key goes to one bit of the first array,
bits hit by one key alone are set, all other keys go on to the next array.  The number of
set bits before a key's bit, over all arrays, is its index: n keys get 0 .. n - 1.
"""

from __future__ import annotations

import numpy as np

from .words import mix

#: Bits of each array per key that reaches it.
GAMMA = 2


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each key (uint64)."""
    return (mix(keys ^ np.uint64(0x9E3779B97F4A7C15)) % np.uint64(shards)).astype(np.int64)


def _bit(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys + np.uint64((level + 1) * 0xA24BAED4963EE407 & (2**64 - 1))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """``sizes``: bits of each array; ``bits``: all arrays, one after the other, packed."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.start = np.append(0, np.cumsum(sizes))
        ones = np.bitwise_count(bits).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """The function of distinct keys (uint64)."""
        sizes, arrays, level = [], [], 0
        while len(keys):
            size = max(64, GAMMA * len(keys))
            where = _bit(keys, level, size)
            alone = np.bincount(where, minlength=size) == 1
            sizes.append(size)
            arrays.append(alone)
            keys, level = keys[~alone[where]], level + 1
        return cls(np.array(sizes, np.int64), np.packbits(np.concatenate(arrays)) if arrays else np.zeros(0, np.uint8))

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key; any number in range, or -1, for a key that is not one of the function's."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (size, start) in enumerate(zip(self.sizes.tolist(), self.start.tolist())):
            if not len(open_):
                break
            at = start + _bit(keys[open_], level, size)
            byte, shift = at >> 3, (7 - (at & 7)).astype(np.uint8)
            word = self.bits[byte]
            hit = (word >> shift) & 1 == 1
            out[open_[hit]] = self.before[byte[hit]] + np.bitwise_count(word[hit] >> shift[hit] >> np.uint8(1))
            open_ = open_[~hit]
        return out
