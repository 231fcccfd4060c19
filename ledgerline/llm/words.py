"""Vectorised word hashing inside Arrow batches.

The operators that work on word shingles or windows (near-duplicates,
decontamination, token cache) hash every word of an Arrow batch with numpy.  A
word's hash is a polynomial over its bytes modulo 2**64, read off two prefix sums
and finished with a 64-bit mixer, so no Python code runs per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed at once; the temporary arrays take about 50 times that.
BLOCK = 1 << 18
#: Bytes of whole texts that an operator works on at once (or one longer text).
PART = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def byte_class(chars) -> np.ndarray:
    """A 256-entry lookup: True for the given byte values."""
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


#: ASCII white space, the separators of ``[^\\x20\\x09-\\x0D]+`` words.
WHITE = byte_class(b" \t\n\x0b\x0c\r")
#: Bytes of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` words: 0-9, a-z and all non-ASCII bytes.
ALNUM = byte_class([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
#: A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (shift, multiply, shift)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n."""
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def text_parts(texts: pa.Array, rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``rows`` rows and about ``PART`` bytes, one row at least."""
    _, offsets = text_buffer(texts)
    at = 0
    while at < len(texts):
        until = max(at + 1, min(at + rows, int(np.searchsorted(offsets, offsets[at] + PART, "right")) - 1))
        yield at, until
        at = until


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def return_memory() -> None:
    """Give the memory that numpy and Arrow have freed back to the system: Spark keeps its
    Python workers for later stages, which need that memory elsewhere."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[starts[i]:ends[i]]; the spans are ascending and disjoint.

    Works block by block, so memory follows ``BLOCK`` (or the longest span), not
    the length of the data."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        until = max(at + 1, int(np.searchsorted(ends, base + BLOCK, "right")))
        block = data[base:ends[until - 1]]
        up, down = _powers(max(len(block) + 1, BLOCK + 1))
        prefix = np.zeros(len(block) + 1, np.uint64)
        np.cumsum((block.astype(np.uint64) + np.uint64(1)) * up[:len(block)], out=prefix[1:])
        s, e = starts[at:until] - base, ends[at:until] - base
        out[at:until] = mix((prefix[e] - prefix[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        at = until
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): spans of maximal runs of ``inside`` bytes that do not
    cross a text's end; first[d]:first[d + 1] are the words of text d."""
    mask = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = mask[:-1]
    starts = np.flatnonzero(mask & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = mask[1:]
    ends = np.flatnonzero(mask & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(column: pa.Array, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first) of the lower-cased words of every text in a string column."""
    data, offsets = text_buffer(column)
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets, inside)
    return span_hashes(data, starts, ends), first


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k consecutive words (across texts too; the caller picks)."""
    n = max(0, len(words) - k + 1)
    out = np.full(n, (k * 0xA24BAED4963EE407) & (2**64 - 1), np.uint64)
    for i in range(k):
        out = (out ^ words[i:i + n]) * np.uint64(0x9FB21C651E98DF25)
        out ^= out >> np.uint64(28)
    return mix(out)
