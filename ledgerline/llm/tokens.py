"""Token ids as Arrow files of equal-length sequences.

``write_sequences`` encodes whole texts, appends the end id to each, and writes the
ids in ascending document order as Arrow IPC files.  A file holds record batches of
``SEQUENCES`` rows with two columns, ``ids`` (fixed-size list of ``length`` ids,
16 bits wide where the vocabulary allows) and ``mask`` (fixed-size list of
``length`` bits, false on the padding of a file's last sequence).  All sequences are
of equal length and all batches but the last of equal size, so token t of a file is
found by division, in a memory-mapped file without a copy.

Order and recovery: documents are range-partitioned by id, so file order is document
order.  Each task attempt writes under names of its own and reports (document, file,
start, count) rows; these rows form the index table, committed by Spark.  A file
that the index does not name belongs to a lost attempt and is never read.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .encoders import ByteLevelEncoder
from .scratch import scratch_path, written
from .words import return_memory, text_parts

LENGTH, SEQUENCES = 2048, 64
#: Tokens after which a task goes on in a new file.
FILE_TOKENS = 1 << 26


_ENCODERS: dict[int, ByteLevelEncoder] = {}


def _encoder(definition: str) -> ByteLevelEncoder:
    """One encoder for each Python worker, whose tasks share what it remembers."""
    key = zlib.crc32(definition.encode())
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = ByteLevelEncoder(definition)
        return_memory()
    return _ENCODERS[key]


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


class SequenceWriter:
    """Packs documents' ids into sequences of one Arrow file."""

    def __init__(self, uri: str, length: int, kind):
        system, path = _file_system(uri)
        self.uri, self.length, self.tokens = uri, length, 0
        item = pa.uint16() if kind == np.uint16 else pa.uint32()
        self.schema = pa.schema([("ids", pa.list_(item, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.sink = system.open_output_stream(path)
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.rest = np.zeros(0, kind)

    def write(self, ids: np.ndarray) -> None:
        self.tokens += len(ids)
        ids = np.concatenate([self.rest, ids])
        step = self.length * SEQUENCES
        full = len(ids) // step * step
        for at in range(0, full, step):
            self._batch(ids[at:at + step], step)
        self.rest = ids[full:].copy()

    def _batch(self, ids: np.ndarray, filled: int) -> None:
        columns = [pa.array(ids), pa.array(np.arange(len(ids)) < filled)]
        lists = [pa.FixedSizeListArray.from_arrays(c, self.length) for c in columns]
        self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        if len(self.rest):
            filled = len(self.rest)
            self._batch(np.append(self.rest, np.zeros(-filled % self.length, self.rest.dtype)), filled)
        self.writer.close()
        self.sink.close()


class SequenceFile:
    """Random access to a file of ``SequenceWriter``; local files are memory-mapped."""

    def __init__(self, uri: str):
        system, path = _file_system(uri)
        self.source = pa.memory_map(path) if isinstance(system, pafs.LocalFileSystem) else system.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("ids").type.list_size
        self._at, self._ids, self._mask = -1, None, None

    def _load(self, batch: int) -> None:
        if batch != self._at:
            rows = self.reader.get_batch(batch)
            self._at, self._ids, self._mask = batch, rows.column(0).values.to_numpy(), rows.column(1).values

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of sequence i."""
        self._load(i // SEQUENCES)
        at = i % SEQUENCES * self.length
        return self._ids[at:at + self.length], self._mask.slice(at, self.length).to_numpy(zero_copy_only=False)

    def tokens(self, start: int, count: int) -> np.ndarray:
        """The ``count`` ids from token ``start`` on."""
        step, parts = self.length * SEQUENCES, []
        while count:
            self._load(start // step)
            part = self._ids[start % step:start % step + count]
            parts.append(part)
            start, count = start + len(part), count - len(part)
        return np.concatenate(parts) if parts else np.zeros(0, np.uint16)

    def close(self) -> None:
        self.source.close()


def write_sequences(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2, length: int = LENGTH,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the token files to ``folder`` and return the index: (doc_id, part, roll, file,
    start, n_tokens), ``start`` counted within the file, one row per row of ``docs``.

    ``tokenizer`` is the path, on the driver, of a byte-level BPE definition of the tokenizers
    library; its text (a few MB for any vocabulary) goes to the executors.

    * Null and empty texts give the end id alone.  A special token's string in a text is that token,
      as by the library's default.
    * Order: by id, nulls first, then by text; rows that repeat an id are all written.
    * A very long text is encoded whole; a task holds one part of about 1 MB or one text.
    * An empty table writes no file and gives an empty index.  Other columns are ignored.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(definition.value)
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        writer, roll = None, 0
        for batch in batches:
            for a, b in text_parts(batch.column(1)):
                if writer is not None and writer.tokens >= FILE_TOKENS:
                    writer.close()
                    writer, roll = None, roll + 1
                if writer is None:
                    writer = SequenceWriter(f"{folder}/part-{part:06d}-{roll:05d}-{attempt}.arrow", length, encoder.kind)
                ids, offsets, _ = encoder.encode(batch.column(1).slice(a, b - a))
                counts = np.diff(offsets) + 1
                start = writer.tokens + np.cumsum(counts) - counts
                writer.write(np.insert(ids, offsets[1:], encoder.kind(end_id)))
                n = b - a
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, n), pa.array([part] * n, pa.int32()), pa.array([roll] * n, pa.int32()),
                     pa.array([writer.uri] * n, pa.string()), pa.array(start), pa.array(counts)],
                    ["doc_id", "part", "roll", "file", "start", "n_tokens"])
            return_memory()
        if writer is not None:
            writer.close()

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = rows.repartitionByRange(shuffle_partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    return written(ordered.mapInArrow(run, f"doc_id {kind}, part int, roll int, file string, start long, n_tokens long"), "index")


def _with_offsets(index: DataFrame) -> DataFrame:
    """``index`` with ``first``, the number of tokens in all files before the row's file.
    The running sum is over one row per file."""
    files = index.groupBy("part", "roll", "file").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("part", "roll").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return index.join(written(files.select("file", before.alias("first")), "files"), "file")


def read_documents(index: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), read back from the files that the index names:
    ``start`` counts the ids of all documents before, ``ids_crc32`` is the crc32 of the
    document's ids as little-endian unsigned 32-bit integers."""
    kind = index.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for batch in batches:
            sums, counts = [], []
            for file, start, n in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "n_tokens"))):
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, SequenceFile(file)
                ids = source.tokens(start, n)
                counts.append(len(ids))
                sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
            total = pa.array(np.array(batch.column("first").to_pylist(), np.int64) + batch.column("start").to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), total, pa.array(counts, pa.int64()), pa.array(sums, pa.int64())],
                                             ["doc_id", "start", "n_tokens", "ids_crc32"])
        if source is not None:
            source.close()
        return_memory()

    located = _with_offsets(index).select("doc_id", "file", "start", "n_tokens", "first")
    placed = located.repartition(shuffle_partitions(index.sparkSession), "file").sortWithinPartitions("file", "start")
    return placed.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def token_table(docs: DataFrame, tokenizer: str, folder: str | None = None, **options) -> DataFrame:
    """Write the files (to a new folder below the checkpoint folder, unless one is given) and
    return what ``read_documents`` finds in them."""
    folder = folder or scratch_path(docs.sparkSession, "tokens")
    hadoop = docs.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    hadoop.getFileSystem(docs.sparkSession.sparkContext._jsc.hadoopConfiguration()).mkdirs(hadoop)
    return read_documents(write_sequences(docs, tokenizer, folder, **options))
