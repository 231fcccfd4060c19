"""Benchmark decontamination by winnowed fingerprints.

A benchmark item's windows are its runs of ``window`` consecutive words; an item of
fewer words is one window.  A document's word is hit if it lies in an occurrence of
any window.

Winnowing: of every ``window - GRAM + 1`` consecutive word k-grams (k = ``GRAM``) the
smallest hash is a fingerprint.  A window shared by two texts contains the same
k-grams in both, so both select the same fingerprint inside it: joining the
fingerprints of a document with those of the benchmark misses no shared window.
Each joined fingerprint is then extended: the windows of the document around it are
looked up among the benchmark's windows.  Items shorter than a window are indexed by
their own length, with every run of that length as a fingerprint.

The benchmark's index (window hashes with their items) goes to the executors in
blocks of at most ``block_chars`` characters of benchmark text, counted before
anything is collected; a larger benchmark takes one pass over the documents a block,
and the passes are merged by document.  Documents are scanned where they lie, without
a shuffle, and nothing of them reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .scratch import fresh, written
from .words import ALNUM, gram_hashes, return_memory, text_parts, word_hashes

WINDOW, GRAM = 10, 4
#: Characters of benchmark text in one broadcast index (about 3 bytes of index each).
BLOCK_CHARS = 32_000_000


@dataclass
class Index:
    """Windows of one block of the benchmark, by their length in words."""

    window: int
    gram: int
    prints: np.ndarray  # sorted fingerprints of the items of at least ``window`` words
    windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # length: sorted hashes, start of each one's items, items


def _minima(grams: np.ndarray, span: int) -> np.ndarray:
    """Positions that are the smallest (on ties the last) of any ``span`` consecutive grams."""
    n = len(grams) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    lowest, offset = grams[:n].copy(), np.zeros(n, np.int64)
    for i in range(1, span):
        lower = grams[i:i + n] <= lowest
        lowest[lower] = grams[i:i + n][lower]
        offset[lower] = i
    at = np.arange(n) + offset  # ascending: a window's minimum never moves back
    return at[np.diff(at, prepend=-1) > 0]


def build_index(items: list, texts: list, window: int, gram: int) -> Index:
    """The index of one block of items; items without words have no window."""
    words, first = word_hashes(pa.array(texts, pa.string()), ALNUM)
    prints, found = [], {}
    for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        length = min(window, b - a)
        if length:
            hashes = gram_hashes(words[a:b], length)
            found.setdefault(length, []).append((hashes, np.full(len(hashes), i)))
        if length == window:
            grams = gram_hashes(words[a:b], gram)
            prints.append(grams[_minima(grams, window - gram + 1)])
    windows = {}
    for length, parts in found.items():
        pairs = np.unique(np.rec.fromarrays([np.concatenate([h for h, _ in parts]), np.concatenate([i for _, i in parts])],
                                            names="h,i"))
        hashes, start = np.unique(pairs.h, return_index=True)
        windows[length] = (hashes, np.append(start, len(pairs)), np.array(items, dtype=object)[pairs.i])
    return Index(window, gram, np.unique(np.concatenate(prints)) if prints else np.zeros(0, np.uint64), windows)


def _member(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of the values are in the sorted table, where)."""
    if not len(table):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    where = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[where] == values, where


def occurrences(words: np.ndarray, first: np.ndarray, index: Index) -> Iterator[tuple[int, int, np.ndarray]]:
    """(position, length, row) of the index's windows in a batch of texts; text d has
    the words first[d]:first[d + 1]."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for length, (hashes, _, _) in index.windows.items():
        if length == index.window:
            grams = gram_hashes(words, index.gram)
            # Fingerprints are selected text by text: a sliding minimum that spans two texts
            # only adds candidates, and each window inside one text still has its own.
            candidates = _minima(grams, index.window - index.gram + 1)
            candidates = candidates[_member(grams[candidates], index.prints)[0]]
            starts = (candidates[:, None] - np.arange(index.window - index.gram + 1)).ravel()
            starts = np.unique(starts[(starts >= 0) & (starts <= len(words) - length)])
        else:
            starts = np.arange(max(0, len(words) - length + 1))
        starts = starts[owner[starts] == owner[starts + length - 1]]
        if len(starts):
            if length == index.window:
                picked = np.zeros((len(starts), length), np.uint64)
                picked[:] = words[starts[:, None] + np.arange(length)]
                values = gram_hashes(picked.ravel(), length)[::length]
            else:
                values = gram_hashes(words, length)[starts]
            ok, where = _member(values, hashes)
            yield length, starts[ok], where[ok]


def scan(column: pa.Array, index: Index) -> tuple[list[int], list[list[int]], list[list]]:
    """Per text: its number of words, its hit words as flat [start, end, start, end, ...]
    runs, and the sorted items with windows in it."""
    words, first = word_hashes(column, ALNUM)
    cover = np.zeros(len(words) + 1, np.int64)
    items: list[set] = [set() for _ in range(len(first) - 1)]
    for length, starts, rows in occurrences(words, first, index):
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + length, -1)
        _, begin, of = index.windows[length]
        texts = np.searchsorted(first, starts, "right") - 1
        for d, r in np.unique(np.stack([texts, rows], 1), axis=0).tolist():
            items[d].update(of[begin[r]:begin[r + 1]])
    hit = np.cumsum(cover)[:-1] > 0
    edge = np.zeros(len(words) + 1, bool)
    edge[first] = True
    begins = np.flatnonzero(hit & (~np.append(False, hit[:-1]) | edge[:-1])) if len(hit) else np.zeros(0, np.int64)
    ends = np.flatnonzero(hit & (~np.append(hit[1:], False) | edge[1:])) + 1 if len(hit) else np.zeros(0, np.int64)
    runs: list[list[int]] = [[] for _ in range(len(first) - 1)]
    texts = np.searchsorted(first, begins, "right") - 1
    for d, a, b in zip(texts.tolist(), (begins - first[texts]).tolist(), (ends - first[texts]).tolist()):
        runs[d] += [a, b]
    return np.diff(first).tolist(), runs, [sorted(x) for x in items]


def _joined_runs(runs: list[int]) -> list[int]:
    """Runs of several blocks as ascending, disjoint runs."""
    out: list[int] = []
    for a, b in sorted(zip(runs[::2], runs[1::2])):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


_FOUND = "n_words long, runs array<long>, items array<string>"


def _scanned(docs: DataFrame, columns: list, schema: str, indexes: list[Index]) -> DataFrame:
    """The columns, then what ``scan`` finds in the last one; several blocks are scanned one
    after the other and their findings joined."""
    shared = [docs.sparkSession.sparkContext.broadcast(i) for i in indexes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, until in text_parts(batch.column(batch.num_columns - 1), 1024):
                part = batch.slice(at, until - at)
                texts = part.column(part.num_columns - 1)
                n, runs, items = scan(texts, shared[0].value)
                for more in shared[1:]:
                    _, r, i = scan(texts, more.value)
                    runs = [_joined_runs(x + y) for x, y in zip(runs, r)]
                    items = [sorted({*x, *y}) for x, y in zip(items, i)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(n, pa.int64()), pa.array(runs, pa.list_(pa.int64())),
                     pa.array(items, pa.list_(pa.string()))], [*part.schema.names[:-1], "n_words", "runs", "items"])
        return_memory()

    return docs.select(*columns).mapInArrow(run, f"{schema}, {_FOUND}")


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, gram: int, block_chars: int) -> list[Index]:
    """Indexes of the benchmark's blocks, each of about ``block_chars`` characters or one item."""
    picked = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).where("text is not null")
    chars = picked.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = -(-chars // block_chars) or 1
    out = []
    for b in range(blocks):
        rows = picked.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()
        rows = sorted((r["item"] or "", r["text"]) for r in rows)
        out.append(build_index([r[0] for r in rows], [r[1] for r in rows], window, gram))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
                  block_chars: int = BLOCK_CHARS, blocks_at_once: int = 4) -> DataFrame:
    """(doc_id, n_words, runs, items), one row per row of ``docs`` (and ``content``, a hash
    of the text, where the benchmark takes several passes).

    ``runs`` are the hit words as [start, end, start, end, ...] (word positions, ends
    exclusive), ``items`` the sorted ids, as strings, of the items with a window in the text.

    * A-Z are lower-cased; words are runs of 0-9, a-z and non-ASCII characters.
    * Null, empty or word-less texts have no words and no hits; such items have no window.
    * A null item id counts as the empty string; repeated items and rows count as they stand,
      an item once a document.
    * Empty documents give an empty result, an empty benchmark no hits.  Other columns are
      ignored.
    """
    if not 0 < gram <= window:
        raise ValueError("gram must lie between 1 and window")
    indexes = _blocks(benchmark, item_col, item_text_col, window, gram, block_chars)
    base = [F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")]
    kind = docs.schema[id_col].dataType.simpleString()
    if len(indexes) <= blocks_at_once:
        return _scanned(docs, base, f"doc_id {kind}", indexes)
    # More blocks than one worker should hold: each group of blocks is a pass of its own over the
    # documents; texts are told apart by id and content, whose findings are the same for all copies.
    key = [F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("content"), F.col(text_col).alias("text")]
    parts = None
    for i in range(0, len(indexes), blocks_at_once):
        part = _scanned(docs, key, f"doc_id {kind}, content long", indexes[i:i + blocks_at_once])
        part = part if i == 0 else part.where("size(runs) > 0").dropDuplicates(["doc_id", "content"])
        part = written(part, "scan")
        parts = part if parts is None else _merged(parts, part)
    return parts


def _merged(all_rows: DataFrame, more: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [_joined_runs((a or []) + (b or [])) for a, b in zip(batch.column("runs").to_pylist(), batch.column("runs2").to_pylist())]
            items = [sorted({*(a or []), *(b or [])}) for a, b in zip(batch.column("items").to_pylist(), batch.column("items2").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(runs, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))],
                                             [*batch.schema.names[:3], "runs", "items"])

    more = more.select(F.col("doc_id").alias("d2"), F.col("content").alias("c2"), F.col("runs").alias("runs2"), F.col("items").alias("items2"))
    both = all_rows.join(more, F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("content") == F.col("c2")), "left")
    both = both.select("doc_id", "content", "n_words", "runs", "items", "runs2", "items2")
    kind = all_rows.schema["doc_id"].dataType.simpleString()
    return both.mapInArrow(run, f"doc_id {kind}, content long, {_FOUND}")


def contamination_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256 (of the comma-joined sorted ids)
    and contaminated (any hit word)."""
    found = contamination(docs, benchmark, **options)
    odd = F.aggregate("runs", F.lit(0).cast(LongType()), lambda acc, x: x - acc)  # telescopes to the sum of end - start
    return found.select(
        "doc_id", "n_words", odd.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("runs") > 0).alias("contaminated"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that have a hit word; columns as given.

    The verdict travels with the row: no join, no shuffle of texts."""
    indexes = _blocks(benchmark, options.get("item_col", "item_id"), options.get("item_text_col", "text"),
                      options.get("window", WINDOW), options.get("gram", GRAM), options.get("block_chars", BLOCK_CHARS))
    if len(indexes) > options.get("blocks_at_once", 4):
        bad = contamination(docs, benchmark, id_col, text_col, **options).where("size(runs) > 0")
        own, key, content = F.col(id_col), fresh("hit_id", docs), fresh("hit_content", docs)
        bad = bad.select(F.col("doc_id").alias(key), F.col("content").alias(content)).distinct()
        return docs.join(bad, own.eqNullSafe(F.col(key)) & (F.xxhash64(text_col) == F.col(content)), "left_anti")
    shared = [docs.sparkSession.sparkContext.broadcast(i) for i in indexes]
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, until in text_parts(batch.column(at), 1024):
                part = batch.slice(start, until - start)
                clean = np.ones(part.num_rows, bool)
                for index in shared:
                    clean &= np.array([not r for r in scan(part.column(at), index.value)[1]], bool)
                yield part.filter(pa.array(clean))
        return_memory()

    return docs.mapInArrow(run, docs.schema)
