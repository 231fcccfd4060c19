"""Near-duplicates by SimHash fingerprints, found through Golay-code keys.

A text's fingerprint has 64 bits; a bit is 1 if it is set in more than half of the text's
shingle hashes.  Documents are linked if their fingerprints differ in at most three bits.

1. Documents of one fingerprint are one node from here on.
2. A fingerprint is cut into segments of 22, 21 and 21 bits.  Three differing bits leave one
   segment equal and a second one with at most one difference, or one difference in each.
   So linked fingerprints share one of these keys:
     * a segment as it is, and a Golay key of another one (six choices of the two);
     * Golay keys of all three segments.
   A word of 23 bits has one key or six (``golay``), a fingerprint about 50 keys in the mean.
3. Fingerprints that share a key are compared, in buckets of at most ``BUCKET``.
4. Larger buckets are never paired.  All fingerprints in any of them are taken together, and
   meet at every word z within two bits: x and y differ in at most three bits if and only if
   some z lies within one bit of the one and two bits of the other.  All fingerprints within
   one bit of z (``close``) are linked with each other and with those at two bits, so a star
   from the smallest close one holds exactly what z links.  Two bits need only be flipped in
   fingerprints with an even number of ones (at three differences one of the two is even),
   and only two in the same half (two of three differences are).  This takes 65 rows for
   each fingerprint and 992 for each even one, however large the buckets are, and at most
   2,081 of them meet at a z.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, permutations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import golay
from .components import components
from .scratch import drop_written, written
from .words import LOWER, return_memory, text_buffer, text_parts

SEED = 42
#: Differing bits of linked fingerprints, at most; the keys are made for this number.
DISTANCE = 3
#: Lowest bit and width of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints of a bucket that are compared with each other.
BUCKET = 64
#: Shingles hashed at once.
_AT_ONCE = 1 << 15
_KEY_ROWS = 1 << 12

_LOWER = bytes(LOWER.tolist())


def fingerprint(text: bytes, k: int) -> int:
    """The fingerprint of a UTF-8 text, unsigned; 0 without a word."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    if len(words) > k:
        starts, ends = starts[:len(words) - k + 1], ends[k - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    votes = np.zeros(64, np.int64)
    for at in range(0, len(starts), _AT_ONCE):
        spans = zip(starts[at:at + _AT_ONCE].tolist(), ends[at:at + _AT_ONCE].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long, one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_parts(batch.column(1)):
                data, at = text_buffer(batch.column(1).slice(a, b - a))
                raw = data.tobytes()
                found = np.array([fingerprint(raw[x:y], k) for x, y in zip(at[:-1].tolist(), at[1:].tolist())], np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(found.view(np.int64))], ["doc_id", "fp"])
        return_memory()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, fp long")


def bucket_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, rows): the keys of fps[rows[i]], several for each fingerprint (uint64)."""
    cut = [(fps >> np.uint64(low)) & np.uint64((1 << width) - 1) for low, width in SEGMENTS]
    codes, valid = zip(*(golay.keys(s) for s in cut))
    keys, rows = [], []
    for tag, (i, j) in enumerate(permutations(range(3), 2)):
        for t in range(golay.MOST):
            row = np.flatnonzero(valid[j][:, t])
            keys.append(np.uint64(tag << 60) | cut[i][row] << np.uint64(12) | codes[j][row, t].astype(np.uint64))
            rows.append(row)
    for t in product(range(golay.MOST), repeat=3):
        row = np.flatnonzero(valid[0][:, t[0]] & valid[1][:, t[1]] & valid[2][:, t[2]])
        if len(row):
            key = codes[0][row, t[0]] << 24 | codes[1][row, t[1]] << 12 | codes[2][row, t[2]]
            keys.append(np.uint64(6 << 60) | key.astype(np.uint64))
            rows.append(row)
    return np.concatenate(keys), np.concatenate(rows)


def _keyed(nodes: DataFrame) -> DataFrame:
    """(key, fp) of nodes(fp)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _KEY_ROWS):
                fps = np.asarray(batch.column(0).slice(at, _KEY_ROWS)).view(np.uint64)
                keys, rows = bucket_keys(fps)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(fps[rows].view(np.int64))], ["key", "fp"])

    return nodes.select("fp").mapInArrow(run, "key long, fp long")


def _meetings(nodes: DataFrame) -> DataFrame:
    """(z, fp, close): the words at which the fingerprints of nodes(fp) meet others."""
    one = np.append(np.uint64(0), np.uint64(1) << np.arange(64, dtype=np.uint64))
    two = np.array([1 << a | 1 << b for half in (range(32), range(32, 64)) for a, b in combinations(half, 2)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                fps = np.asarray(batch.column(0).slice(at, 64)).view(np.uint64)
                even = fps[np.bitwise_count(fps) % 2 == 0]
                for some, flips, close in ((fps, one, True), (even, two, False)):
                    z = (some[:, None] ^ flips).ravel()
                    yield pa.RecordBatch.from_arrays([pa.array(z.view(np.int64)), pa.array(np.repeat(some, len(flips)).view(np.int64)),
                                                      pa.array(np.full(len(z), close))], ["z", "fp", "close"])

    return nodes.select("fp").mapInArrow(run, "z long, fp long, close boolean")


def links(nodes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a, b) of fingerprints of nodes(fp, distinct) that differ in at most three bits: all such
    pairs that meet in a bucket of at most ``bucket``, and stars that connect what larger ones hold."""
    keyed = _keyed(nodes)
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = written(keyed.join(shared.hint("merge"), "key"), "members")
    left, right = members.where(F.col("size") <= bucket).selectExpr("key", "fp a"), members.where(F.col("size") <= bucket).selectExpr("key", "fp b")
    pairs = left.join(right.hint("merge"), "key").where(f"a < b and bit_count(a ^ b) <= {DISTANCE}").select("a", "b")
    crowded = written(members.where(F.col("size") > bucket).select("fp").distinct(), "crowded")
    if not crowded.isEmpty():
        meet = _meetings(crowded)
        centre = meet.where("close").groupBy("z").agg(F.min("fp").alias("a"))
        pairs = pairs.union(meet.join(centre.hint("merge"), "z").where("fp <> a").selectExpr("a", "fp b"))
    out = written(pairs.distinct(), "links")
    for table in (members, crowded):
        drop_written(table)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``.

    Words are separated by ASCII white space, A-Z are lower-cased, shingles are k words joined
    by blanks, repeats included, hashed by XXH64 (seed 42).  ``component_id`` is the smallest id
    reachable over links.

    * A text of fewer than k words is one shingle.  Null, empty and white-space texts have the
      fingerprint zero, which is linked like any other.
    * Rows are linked by their fingerprints alone: rows that repeat an id are documents of their own.
    * A null id is never the smallest; a group without any other has a null component_id.
    * All joined tables grow with the input, so none is broadcast: a broadcast passes through the driver.
    * A very long text is hashed in blocks.  An empty table gives an empty result.  Other columns
      are ignored.
    """
    prints = written(fingerprints(docs, k, id_col, text_col), "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "nodes")
    edges = links(nodes, bucket)
    tops = components(edges)
    tops = written(tops.union(tops.selectExpr("comp node", "comp").distinct()), "tops")  # the smallest node of each, too
    drop_written(edges)
    linked = nodes.join(tops.hint("merge"), F.col("fp") == F.col("node"))
    smallest = linked.groupBy("comp").agg(F.min("rep").alias("top"))
    named = linked.join(smallest.hint("merge"), "comp").select("fp", "top", F.lit(True).alias("found"))
    labels = nodes.join(named.hint("merge"), "fp", "left").select("fp", F.when(F.col("found"), F.col("top")).otherwise(F.col("rep")).alias("component_id"))
    return prints.join(labels.hint("merge"), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
