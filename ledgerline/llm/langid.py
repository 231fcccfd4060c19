"""Language identification: averaged hashed subword embeddings, linear softmax.

A text's subwords are the byte 1-, 2- and 3-grams inside its words, the words framed
by blanks and A-Z lower-cased.  Each is hashed to one of ``buckets`` rows of an embedding table; a text is the
mean of its rows, a linear layer with softmax gives the languages.  Both layers are
trained together by stochastic gradient descent in numpy on the driver, over feature
counts that the executors compute for a bounded, labelled sample (at most
``per_language`` texts of each language in expectation, chosen by a hash of id and
text).  A fifth of the sample is kept out of training, whole and thinned to a few
subwords.  It sets the softmax temperature and how strongly short texts are drawn to no
decision, so that scores are calibrated, and the threshold below which a text is rejected.

Prediction folds both layers into one (buckets x languages) table, which is all that
the executors get; its size does not depend on the data.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import BLOCK, LOWER, WHITE, return_memory, text_buffer

BUCKETS, DIMENSIONS, PER_LANGUAGE = 8192, 16, 1500
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


@dataclass
class Model:
    """counts @ ``table`` / (total + ``prior``) / ``temperature`` are the logits of ``languages``."""

    languages: list[str]
    table: np.ndarray
    prior: float
    temperature: float
    threshold: float
    trained_on: int

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Calibrated probabilities, a row for each row of feature counts."""
        return _softmax(_logits(counts, self.table, self.prior) / self.temperature)


def _logits(counts: np.ndarray, table: np.ndarray, prior: float) -> np.ndarray:
    return counts @ table / (counts.sum(1, keepdims=True) + prior)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def subword_counts(column: pa.Array, buckets: int) -> Iterator[np.ndarray]:
    """The feature counts (float32, length ``buckets``) of each text."""
    data, offsets = text_buffer(column)
    blank = np.uint8(0x20)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        counts = np.zeros(buckets, np.int64)
        # long texts in blocks; the grams across a block's edge are counted by the two bytes kept over
        last = np.array([blank], np.uint8)
        for at in range(a, b, BLOCK):
            block = LOWER[data[at:min(b, at + BLOCK)]]
            block = np.where(WHITE[block], blank, block)
            end = [blank] if at + BLOCK >= b else []
            whole = np.concatenate([last, block, np.array(end, np.uint8)]).astype(np.uint32)
            for n in (1, 2, 3):
                x = whole[max(0, len(last) - n + 1):]  # of the bytes kept over, those of no counted gram
                m = len(x) - n + 1
                if m <= 0:
                    continue
                h = np.full(m, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
                for i in range(n):
                    h = (h ^ x[i:i + m]) * np.uint32(0x85EBCA6B)
                    h ^= h >> np.uint32(15)
                inner = np.ones(m, bool)
                for i in range(1, n - 1):
                    inner &= x[i:i + m] != blank
                if n == 1:
                    inner &= x[:m] != blank
                counts += np.bincount(h[inner] & np.uint32(buckets - 1), minlength=buckets)
            last = whole[-2:].astype(np.uint8)
        yield counts.astype(np.float32)


def has_letter(column: pa.Array) -> list[bool]:
    """Whether each text has a Unicode letter (null: no)."""
    data, offsets = text_buffer(column)
    bounds = offsets.tolist()
    # block by block: memory stays small however long the batch's texts are
    out = [any(_ASCII_LETTER[data[at:min(b, at + BLOCK)]].any() for at in range(a, b, BLOCK))
           for a, b in zip(bounds[:-1], bounds[1:])]
    for i, found in enumerate(out):
        if not found and bounds[i] < bounds[i + 1]:
            out[i] = _LETTER.search(column[i].as_py()) is not None
    return out


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, languages: int, buckets: int, dimensions: int,
        epochs: int = 20, rate: float = 8.0, batch: int = 64, seed: int = 11) -> np.ndarray:
    """The (buckets x languages) table of embeddings times softmax weights, by mini-batch
    gradient descent on rows of (bucket indices, counts)."""
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 1 / dimensions, (buckets, dimensions)).astype(np.float32)
    weight = rng.normal(0, 0.1, (dimensions, languages)).astype(np.float32)
    # each language weighs the same, whatever its share of the sample
    balance = len(labels) / (languages * np.maximum(np.bincount(labels, minlength=languages), 1)).astype(np.float32)
    steps, done = epochs * -(-len(rows) // batch), 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            chosen = order[at:at + batch]
            x = np.zeros((len(chosen), buckets), np.float32)
            for i, r in enumerate(chosen):
                x[i, rows[r][0]] = rows[r][1] / rows[r][1].sum()
            hidden = x @ table
            error = _softmax(hidden @ weight)
            error[np.arange(len(chosen)), labels[chosen]] -= 1
            error *= balance[labels[chosen]][:, None] / len(chosen)
            step = rate * (1 - done / steps)
            to_table = x.T @ (error @ weight.T)
            weight -= step * (hidden.T @ error)
            table -= step * to_table
            done += 1
    return table @ weight


def calibrate(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, table: np.ndarray, reject: float,
              seed: int = 13) -> tuple[float, float, float]:
    """(prior, temperature, threshold) from rows that did not train the table.

    Prior and temperature have the least log loss over the rows, whole and thinned to 3, 10 and
    30 drawn subwords.  The threshold rejects at most the share ``reject`` of the whole rows that
    are recognised rightly, and never a text that is more likely than not of its language."""
    if not len(labels):
        return 1.0, 1.0, 0.0
    rng = np.random.default_rng(seed)
    sums, totals, truth = [], [], []
    for size in (0, 3, 10, 30):
        for (index, n), label in zip(rows, labels):
            n = rng.multinomial(size, n / n.sum()) if size else n
            sums.append(n @ table[index])
            totals.append(n.sum())
            truth.append(label)
    sums, totals, truth = np.array(sums), np.array(totals)[:, None], np.array(truth)

    def loss(prior: float, temperature: float) -> float:
        p = _softmax(sums / (totals + prior) / temperature)
        return float(-np.log(np.maximum(p[np.arange(len(truth)), truth], 1e-12)).mean())

    prior, temperature = min(((c, t) for c in (0.5, 1, 2, 4, 8, 16, 32, 64) for t in np.geomspace(0.05, 20, 61)), key=lambda x: loss(*x))
    p = _softmax(sums / (totals + prior) / temperature)[:len(labels)]
    right = p.argmax(1) == labels
    threshold = float(np.quantile(p.max(1)[right], reject)) if right.any() else 0.0
    return float(prior), float(temperature), min(threshold, 0.5)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          usable: Column | None = None, buckets: int = BUCKETS, dimensions: int = DIMENSIONS,
          per_language: int = PER_LANGUAGE, reject: float = 0.001) -> Model | None:
    """A model of the labelled rows for which ``usable`` holds (default: all); None if there are none.

    Counts the rows of every language over the whole table, then takes
    ``per_language`` of each in expectation, by a hash of id and text.  Only (index, count)
    features of that sample reach the driver."""
    if buckets & (buckets - 1):
        raise ValueError("buckets must be a power of two")
    text, lang = F.col(text_col), F.col(lang_col).cast("string")
    rows = docs.where(usable) if usable is not None else docs
    rows = rows.where(text.isNotNull() & lang.isNotNull()).select(
        text.alias("text"), lang.alias("lang"),
        (F.pmod(F.xxhash64(F.col(id_col).cast("string"), text), F.lit(1 << 30)) / float(1 << 30)).alias("draw"))
    share = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    if not share:
        return None
    limit = F.create_map(*[x for r in share for x in (F.lit(r["lang"]), F.lit(min(1.0, per_language / r["n"])))])
    sample = rows.where(F.col("draw") < limit[F.col("lang")]).select("text", "lang", "draw")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            usable_rows = has_letter(batch.column(0))
            batch = batch.filter(pa.array(usable_rows, pa.bool_()))
            where, values = [], []
            for counts in subword_counts(batch.column(0), buckets):
                index = np.flatnonzero(counts)
                where.append(index.astype(np.int32))
                values.append(counts[index])
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(where, pa.list_(pa.int32())),
                                              pa.array(values, pa.list_(pa.float32()))], ["lang", "draw", "i", "n"])

    taken = sample.mapInArrow(run, "lang string, draw double, i array<int>, n array<float>").toArrow()
    taken = taken.sort_by([("draw", "ascending"), ("lang", "ascending")])
    if not taken.num_rows:
        return None
    names = taken.column("lang").to_pylist()
    languages = sorted(set(names))
    labels = np.array([languages.index(x) for x in names])
    features = [(i.values.to_numpy(), n.values.to_numpy()) for i, n in zip(taken.column("i"), taken.column("n"))]
    aside = np.arange(len(labels)) % 5 == 4
    parts = {held: [features[i] for i in np.flatnonzero(aside == held)] for held in (False, True)}
    table = fit(parts[False], labels[~aside], len(languages), buckets, dimensions)
    model = Model(languages, table, *calibrate(parts[True], labels[aside], table, reject), trained_on=len(parts[False]))
    # the sample and what training needed go back to the system before the driver plans the next stages
    del taken, features, parts
    return_memory()
    return model


def _predictions(model: Model | None, column: pa.Array) -> tuple[list, list, list]:
    """(language, score, accepted) of each text."""
    names, scores, accepted = [], [], []
    for ok, counts in zip(has_letter(column), subword_counts(column, BUCKETS if model is None else len(model.table))):
        if ok and model is not None:
            p = model.scores(counts[None, :])[0]
            best = int(p.argmax())
            names.append(model.languages[best])
            scores.append(min(1.0, float(p[best])))
            accepted.append(scores[-1] >= model.threshold)
        else:
            names.append(UNKNOWN)
            scores.append(0.0)
            accepted.append(False)
    return names, scores, accepted


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, accepted), one row per row of ``docs``.

    * Null texts and texts without a Unicode letter are ``und`` with score 0, not accepted;
      so is everything if there is no model (no labelled row).
    * Other texts get the most probable learned language and its calibrated probability;
      accepted says that the score reaches the model's threshold.
    * Whole texts count, however long; repeated rows get the same result; an empty table gives
      an empty one.  Only the id and the text are read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, accepted = _predictions(shared.value, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                                              pa.array(accepted, pa.bool_())], ["doc_id", "lang_pred", "score", "accepted"])
        return_memory()

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, accepted boolean")


def accepted_rows(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose language is rejected (no letter, or a score below the
    model's threshold); columns as given.  Without a model only rows without a letter go."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at)
            keep = _predictions(shared.value, texts)[2] if shared.value is not None else has_letter(texts)
            yield batch.filter(pa.array(keep, pa.bool_()))
        return_memory()

    return docs.mapInArrow(run, docs.schema)


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2 (null id: of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))), F.lit(4)) == 2


def held_out_id(value) -> bool:
    return zlib.crc32(b"" if value is None else str(value).encode()) % 4 == 2
