"""Alignment of two tokenizers' tokens over a corpus, with link counts by id pair.

A token covers a byte range of its text.  An A and a B token whose ranges end together are
linked; the offsets where both end cut a text into groups of tokens that cover the same
bytes.

1. The first pass aligns all documents; each task reports its distinct id pairs with their
   number of links.
2. The distinct pairs get a minimal perfect hash, built in shards of about ``SHARD`` pairs.
3. Tasks turn the reported numbers into dense count vectors, a segment a shard, indexed by
   the hash.  They are summed in a tree of ``FAN`` vectors at a time.  Only as many tasks
   make vectors as keep them filled (``FILL``), so their volume follows the reported rows.
4. The second pass aligns the documents again and looks each link's count up by the hash.
   The pair at that index is compared with the link's own (``keys``), so a pair that is not
   in the table is never mistaken for another.

The lookup table goes out in blocks of at most ``block`` pairs (about 13 bytes each), a
documented bound on what is collected and broadcast; with more pairs than that the
documents pass by once for each block, carrying their sums along.  The highest count of
each B id is one number an id.  Documents never move, and no group of rows is gathered.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoders import ByteLevelEncoder, SentencePieceEncoder
from .perfecthash import PerfectHash, shard_of
from .scratch import drop_written, written
from .words import return_memory, text_parts

#: Pairs in a shard of the hash, in a block of the lookup table, and kept by a task of the first pass.
SHARD, BLOCK, KEPT = 1 << 16, 1 << 22, 1 << 20
#: Vectors summed at once, and reported rows a vector should have for each pair.
FAN, FILL = 16, 1
_SIDE = 32  # bits of a B id in a pair

_DOC = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_DOC_COLUMNS = [x.split()[0] for x in _DOC.split(", ")]

_ENCODERS: dict[int, tuple[ByteLevelEncoder, SentencePieceEncoder]] = {}


def _encoders(definition: str, model: bytes) -> tuple[ByteLevelEncoder, SentencePieceEncoder]:
    """One pair of encoders for each Python worker."""
    key = zlib.crc32(model, zlib.crc32(definition.encode()))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = ByteLevelEncoder(definition, plain=True), SentencePieceEncoder(model)
        return_memory()
    return _ENCODERS[key]


class Aligned:
    """The tokens of some texts, aligned: ``a`` and ``b`` are the ids, ``a_at`` and ``b_at`` the
    texts' borders in them, ``a_cut`` and ``b_cut`` mark tokens that end a group.  Texts without
    tokens have none on either side."""

    def __init__(self, texts: pa.Array, first: ByteLevelEncoder, second: SentencePieceEncoder):
        filled = pc.fill_null(texts, "")
        spaced = pc.if_else(pc.equal(filled, ""), "", pc.binary_join_element_wise(" ", filled, ""))
        a, a_at, a_sound = first.encode(spaced)
        b, b_at, b_sound = second.encode(spaced)
        sound = a_sound & b_sound
        self.a, self.a_at = self._only(a, a_at, sound)
        self.b, self.b_at = self._only(b, b_at, sound)
        a_end, b_end = np.cumsum(first.size[self.a]), np.cumsum(second.size[self.b])
        self.a_cut, self.b_cut = self._among(a_end, b_end), self._among(b_end, a_end)

    @staticmethod
    def _only(ids: np.ndarray, at: np.ndarray, sound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count = np.diff(at)
        return ids[np.repeat(sound, count)], np.append(0, np.cumsum(count * sound))

    @staticmethod
    def _among(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x if len(y) else np.zeros(len(x), bool)

    def pairs(self) -> np.ndarray:
        """The id pair of every link, in order: a * 2**32 + b."""
        return (self.a[self.a_cut].astype(np.uint64) << np.uint64(_SIDE)) | self.b[self.b_cut].astype(np.uint64)

    def links_at(self) -> np.ndarray:
        """The texts' borders in ``pairs``."""
        return np.append(0, np.cumsum(self.a_cut))[self.a_at]

    def group_texts(self, shown: "_Shown") -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` for each text; empty without tokens."""
        a_group = np.cumsum(self.a_cut) - self.a_cut
        b_group = np.cumsum(self.b_cut) - self.b_cut
        a_upto, b_upto = np.flatnonzero(self.a_cut) + 1, np.append(0, np.flatnonzero(self.b_cut) + 1)
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[np.arange(len(self.a)) + b_upto[a_group]] = 2 * self.a.astype(np.int64) + self.a_cut
        code[np.arange(len(self.b)) + a_upto[b_group]] = 2 * (shown.a_ids + self.b.astype(np.int64)) + self.b_cut
        size = np.append(0, np.cumsum(shown.size[code]))
        raw = shown.chars[code][shown.used[code]].tobytes()
        ends = size[self.a_at + self.b_at]
        return [raw[x:y - 1] if y > x else b"" for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())]


class _Shown:
    """Ids in decimal with what follows them: a comma within a group, else | after A and ; after B."""

    def __init__(self, a_ids: int, b_ids: int):
        self.a_ids = a_ids
        shown = [f"{i}{c}".encode() for i in range(a_ids) for c in ",|"] + [f"{i}{c}".encode() for i in range(b_ids) for c in ",;"]
        self.size = np.fromiter(map(len, shown), np.int64, len(shown))
        self.chars = np.array(shown).view(np.uint8).reshape(len(shown), -1)
        self.used = np.arange(self.chars.shape[1]) < self.size[:, None]


class _Table:
    """A block of the lookup: pairs and counts by index, in shards."""

    def __init__(self, shards: int, rows: list[tuple]):
        self.shards = shards
        self.rows = {s: (PerfectHash(np.frombuffer(z, np.int64), np.frombuffer(b, np.uint8)), np.frombuffer(k, np.uint64), np.frombuffer(c, np.int64))
                     for s, z, b, k, c in rows}

    def counts(self, pairs: np.ndarray) -> np.ndarray:
        """The number of links of each pair, 0 for pairs that are not in the block."""
        out = np.zeros(len(pairs), np.int64)
        shard = shard_of(pairs, self.shards)
        order = np.argsort(shard, kind="stable")
        found, first = np.unique(shard[order], return_index=True)
        for s, rows in zip(found.tolist(), np.split(order, first[1:])):
            if s in self.rows:
                hash_, keys, counts = self.rows[s]
                at = hash_.index(pairs[rows])
                out[rows] = np.where((at >= 0) & (keys[at] == pairs[rows]), counts[at], 0)
        return out


def _count_links(docs: DataFrame, definition, model) -> DataFrame:
    """(part, pair, n): the links of each id pair, summed within tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = _encoders(definition.value, model.value)
        part = TaskContext.get().partitionId()
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def rows():
            for at in range(0, len(keys), 1 << 16):
                some = keys[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), part, np.int32)), pa.array(some.view(np.int64)),
                                                  pa.array(counts[at:at + (1 << 16)])], ["part", "pair", "n"])

        for batch in batches:
            for a, b in text_parts(batch.column(0)):
                found, n = np.unique(Aligned(batch.column(0).slice(a, b - a), first, second).pairs(), return_counts=True)
                merged, where = np.unique(np.concatenate([keys, found]), return_inverse=True)
                counts = np.bincount(where, np.concatenate([counts, n]), len(merged)).astype(np.int64)
                keys = merged
                if len(keys) > KEPT:
                    yield from rows()
                    keys, counts = keys[:0], counts[:0]
        yield from rows()
        return_memory()

    return docs.select("text").mapInArrow(run, "part int, pair long, n long")


def _functions(partials: DataFrame, shards: int) -> DataFrame:
    """(shard, n, sizes, bits, keys): the hash of each shard's distinct pairs, and the pairs by index."""

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.asarray(batch.column(0)).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(shard_of(keys, shards).astype(np.int32)), batch.column(0)], ["shard", "pair"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, (keys,) in _runs(batches, ["pair"]):
            keys = keys.view(np.uint64)
            hash_ = PerfectHash.build(keys)
            by_index = np.empty_like(keys)
            by_index[hash_.index(keys)] = keys
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int32()), pa.array([len(keys)], pa.int64()),
                 *[pa.array([x.tobytes()], pa.binary()) for x in (hash_.sizes, hash_.bits, by_index)]],
                ["shard", "n", "sizes", "bits", "keys"])

    dealt = partials.select("pair").distinct().mapInArrow(shard, "shard int, pair long")
    return (dealt.repartition(shards, "shard").sortWithinPartitions("shard")
            .mapInArrow(build, "shard int, n long, sizes binary, bits binary, keys binary"))


def _runs(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(shard, columns) of each run of equal shards in sorted batches; one run is held at a time."""
    now, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        shard = np.asarray(batch.column("shard"))
        cuts = np.flatnonzero(np.diff(shard)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(shard)]):
            if held and now != shard[a]:
                yield int(now), [np.concatenate(x) for x in zip(*held)]
                held = []
            now = shard[a]
            held.append([np.asarray(batch.column(c))[a:b] for c in columns])
    if held:
        yield int(now), [np.concatenate(x) for x in zip(*held)]


def _vectors(partials: DataFrame, hashes, shards: int, tasks: int) -> DataFrame:
    """(shard, branch, counts): dense count vectors of the shards in ``hashes`` (a broadcast of
    shard -> (n, sizes, bits)), one a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {s: (PerfectHash(np.frombuffer(z, np.int64), np.frombuffer(b, np.uint8)), n) for s, (n, z, b) in hashes.value.items()}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            pairs, n = np.asarray(batch.column(0)).view(np.uint64), np.asarray(batch.column(1))
            shard = shard_of(pairs, shards)
            order = np.argsort(shard, kind="stable")
            found, first = np.unique(shard[order], return_index=True)
            for s, rows in zip(found.tolist(), np.split(order, first[1:])):
                if s in table:
                    hash_, size = table[s]
                    if s not in sums:
                        sums[s] = np.zeros(size, np.int64)
                    np.add.at(sums[s], hash_.index(pairs[rows]), n[rows])
        branch = TaskContext.get().partitionId()
        for s, counts in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([branch], pa.int32()), pa.array([counts.tobytes()], pa.binary())],
                                             ["shard", "branch", "counts"])
        return_memory()

    return partials.select("pair", "n").repartition(tasks).mapInArrow(run, "shard int, branch int, counts binary")


def _tree_sum(vectors: DataFrame, tasks: int, shards: int) -> DataFrame:
    """(shard, counts): the vectors of each shard summed, ``FAN`` of them at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(key, total):
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                              ["shard", "branch", "counts"])
        key, total = None, None
        for batch in batches:
            for s, b, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                vector = np.frombuffer(counts.as_buffer(), np.int64)
                if key == (s, b):
                    total = total + vector
                    continue
                if key is not None:
                    yield row(key, total)
                key, total = (s, b), vector
        if key is not None:
            yield row(key, total)

    while tasks > 1:
        tasks = -(-tasks // FAN)
        dealt = vectors.withColumn("branch", F.expr(f"cast(branch div {FAN} as int)"))
        vectors = (dealt.repartition(min(4096, shards * tasks), "shard", "branch").sortWithinPartitions("shard", "branch")
                   .mapInArrow(run, "shard int, branch int, counts binary"))
    return vectors.select("shard", "counts")


def _add_counts(rows: DataFrame, definition, model, table, best) -> DataFrame:
    """The second pass: ``n_best`` and ``count_sum`` grow by what a block of the table holds.  The
    first block (empty sums) also fills in the numbers and groups of tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = _encoders(definition.value, model.value)
        lookup, highest = table.value, best.value
        shown = _Shown(len(first.size), len(second.size))
        for batch in batches:
            for x, y in text_parts(batch.column("text")):
                part = batch.slice(x, y - x)
                got = Aligned(part.column("text"), first, second)
                pairs, at = got.pairs(), got.links_at()
                counts = lookup.counts(pairs)
                is_best = (counts > 0) & (counts == highest[(pairs & np.uint64(2**_SIDE - 1)).astype(np.int64)])
                n_best, count_sum = (np.append(0, np.cumsum(v))[at] for v in (is_best, counts))
                links = pa.array(np.diff(at))
                hashes = [hashlib.sha256(g).hexdigest() if g else "" for g in got.group_texts(shown)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text"), pa.array(np.diff(got.a_at)), pa.array(np.diff(got.b_at)), links, links,
                     pc.add(part.column("n_best"), pa.array(np.diff(n_best))), pc.add(part.column("count_sum"), pa.array(np.diff(count_sum))),
                     pa.array(hashes, pa.string())], ["doc_id", "text", *_DOC_COLUMNS])
        return_memory()

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "text", "n_best", "count_sum").mapInArrow(run, f"doc_id {kind}, text string, {_DOC}")


def pair_counts(docs: DataFrame, definition, model) -> tuple[DataFrame, DataFrame, int]:
    """(functions, partials, shards): the written hash of all distinct pairs and the reported links."""
    partials = written(_count_links(docs, definition, model), "links")
    n_pairs = partials.select("pair").distinct().count()
    shards = max(1, -(-n_pairs // SHARD))
    return written(_functions(partials, shards), "pair-hash"), partials, shards


def align(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per row of ``docs``.

    ``byte_level`` (A) and ``pieces`` (B) are the paths, on the driver, of a byte-level BPE of the
    tokenizers library and of a sentencepiece model that puts a blank before a text; A gets the
    text with that blank.  A pair's count is its number of links in all of ``docs``; a link is
    best if no pair with its B id has a higher count.

    * Null and empty texts, and texts whose tokens' bytes are not the text (such as those that
      hold U+2581), have no tokens: zeros and ''.  Strings of special tokens are ordinary text.
    * Rows that repeat an id or a text each count and each get a row; ids may be null.
    * Both tokenizers must have no token without bytes, so a token of one side is linked once.
    * A very long text is aligned whole; a task holds one part of about 1 MB or one text.
    * An empty table gives an empty result.  Other columns are ignored.
    """
    spark = docs.sparkSession
    with open(byte_level, encoding="utf-8") as f, open(pieces, "rb") as g:
        definition, model = spark.sparkContext.broadcast(f.read()), spark.sparkContext.broadcast(g.read())
    _, second = _encoders(definition.value, model.value)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    functions, partials, shards = pair_counts(rows, definition, model)

    sizes = [(r.shard, r.n) for r in functions.select("shard", "n").orderBy("shard").collect()]
    blocks: list[list[int]] = [[]]
    held = 0
    for shard, n in sizes:
        if blocks[-1] and held + n > block:
            blocks.append([])
            held = 0
        blocks[-1].append(shard)
        held += n
    reported = partials.count()
    tables = []
    for shard_list in blocks:
        mine = functions.where(F.col("shard").isin(shard_list)) if len(blocks) > 1 else functions
        hashes = spark.sparkContext.broadcast({r.shard: (r.n, bytes(r.sizes), bytes(r.bits)) for r in mine.select("shard", "n", "sizes", "bits").collect()})
        pairs = sum(n for n, _, _ in hashes.value.values())
        tasks = max(1, min(int(reported // max(1, FILL * pairs)), 1 << 16))
        counted = _tree_sum(_vectors(partials, hashes, shards, tasks), tasks, shards)
        tables.append(written(mine.join(counted, "shard"), "pair-counts"))
        hashes.unpersist()
    best = spark.sparkContext.broadcast(_best(tables, len(second.size)))

    out = rows.withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")})
    for i, counted in enumerate(tables):
        table = spark.sparkContext.broadcast(_Table(shards, [
            (r.shard, bytes(r.sizes), bytes(r.bits), bytes(r["keys"]), bytes(r.counts)) for r in counted.drop("n").collect()]))
        out = _add_counts(out, definition, model, table, best)
        if i + 1 < len(tables):
            out = written(out, "aligned")
            table.unpersist()
    drop_written(partials)
    return out.drop("text")


def _best(tables: list[DataFrame], b_ids: int) -> np.ndarray:
    """The highest count of each B id: one row an id and table reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        highest = np.zeros(b_ids, np.int64)
        for batch in batches:
            for keys, counts in zip(batch.column(0), batch.column(1)):
                ids = (np.frombuffer(keys.as_buffer(), np.uint64) & np.uint64(2**_SIDE - 1)).astype(np.int64)
                np.maximum.at(highest, ids, np.frombuffer(counts.as_buffer(), np.int64))
        ids = np.flatnonzero(highest)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(highest[ids])], ["id", "n"])

    out = np.zeros(b_ids, np.int64)
    for table in tables:
        for r in table.select("keys", "counts").mapInArrow(run, "id long, n long").groupBy("id").agg(F.max("n").alias("n")).collect():
            out[r.id] = max(out[r.id], r.n)
    return out
