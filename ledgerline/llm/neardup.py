"""Near-duplicate documents: one-permutation MinHash, banded buckets, star edges.

1. One pass hashes every text's distinct k-word shingles.  The top bits of a
   shingle's hash name one of ``BINS`` bins, each bin keeps its smallest hash (one
   permutation), and an empty bin copies a filled one that it finds by its own
   random probe sequence (optimal densification).  ``ROWS`` bins make a band.
2. Documents with the same shingle set are one class from here on.
3. Classes that agree in a band share a bucket.  Each bucket has one centre, the member
   with the most company over all its buckets (the original rather than an edited copy),
   and yields star edges from the centre to its members, never all pairs.
4. Star edges are measured on the full shingle sets.  Members that miss the similarity to
   their centre c could still be linked with each other or with members that reach it.  For
   such a stray x and any member y of the same centre, with M(x) = c - x and N(x) = x - c,

       |x - y| + |y - x| = |D(x)| + |D(y)| - 2 |D(x) & D(y)|,   D = M + N,

   so a link needs D(x) and D(y) to share t = (|D(x)| + |D(y)| - q (nx + ny)) / 2 shingles,
   q = (1 - s) / (1 + s).  Either t <= min(|M(x)|, |M(y)|), which sizes alone decide and
   which needs |y| < |c|, or x and y share a shingle that c does not have.  Those pairs, and
   no others, are measured too (under one shared centre): found by an equi-join on (centre, shingle) over the shortest
   prefixes of N that must meet, and by sizes; a parity bitmap of each set, whose
   differing bits never outnumber the differing shingles, rules most of them out inside
   the join.  So no link that shares a bucket is lost, and
   edited copies of one text cost a star, not a square.

With ``ROWS`` = 4 and ``BINS`` = 128 two sets of similarity s share no bucket with
probability (1 - s**4)**32, which is 5e-8 at 0.8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import drop_written, fresh, written
from .words import WHITE, gram_hashes, mix, return_memory, text_parts, word_hashes

BINS, ROWS = 128, 4
#: 64-bit words of the parity bitmap.
PARITY = 8
#: Bits of the filter that finds the texts to be hashed again (16 MB).
FILTER_BITS = 1 << 27
_EMPTY = np.uint64(2**64 - 1)


def _probes(bins: int) -> np.ndarray:
    """A random order of all bins for every bin (fixed seed)."""
    rng = np.random.default_rng(20240917)
    return np.stack([rng.permutation(bins) for _ in range(bins)])


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct k-word shingle hashes of each text; fewer words make one shingle."""
    words, first = word_hashes(column, ~WHITE)
    grams = gram_hashes(words, k)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            yield np.unique(grams[a:b - k + 1])
        elif b > a:
            yield gram_hashes(words[a:b], b - a)
        else:
            yield np.zeros(0, np.uint64)


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def densify(signature: np.ndarray, probes: np.ndarray) -> np.ndarray:
    """Fill the empty bins of each row from filled ones; rows without any stay empty."""
    out = signature.copy()
    row, col = np.nonzero((signature == _EMPTY) & (signature != _EMPTY).any(1)[:, None])
    for attempt in range(probes.shape[1]):
        if not len(row):
            break
        found = signature[row, probes[col, attempt]]
        full = found != _EMPTY
        out[row[full], col[full]] = found[full]
        row, col = row[~full], col[~full]
    return out


def band_keys(sets: list[np.ndarray], bins: int, rows: int, probes: np.ndarray) -> np.ndarray:
    """One 64-bit key for each set and band."""
    shift = np.uint64(64 - (bins - 1).bit_length())
    signature = np.full((len(sets), bins), _EMPTY, np.uint64)
    for i, s in enumerate(sets):
        if len(s):
            where = (s >> shift).astype(np.int64)
            lowest = np.flatnonzero(np.diff(where, prepend=-1))
            signature[i, where[lowest]] = s[lowest]
    signature = densify(signature, probes).reshape(len(sets), bins // rows, rows)
    keys = np.broadcast_to(mix(np.arange(1, bins // rows + 1, dtype=np.uint64)), signature.shape[:2]).copy()
    for r in range(rows):
        keys = mix(keys ^ signature[:, :, r]) + np.uint64(r)
    return keys.view(np.int64)


def _identity(id_col: str, text_col: str) -> Column:
    """A hash of a row's id and text."""
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).isNull(), F.xxhash64(F.col(text_col)))


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int, bins: int, rows: int) -> DataFrame:
    """(doc_id, n, cls, cls2, bands, text_key, row_key): set size, 128-bit set key, band keys, the
    text's hash where the id is null, and a hash of id and text."""
    if bins & (bins - 1) or bins % rows:
        raise ValueError("bins must be a power of two and a multiple of rows")
    probes = _probes(bins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, until in text_parts(batch.column(1), 512):
                part = batch.slice(at, until - at)
                sets = list(shingle_sets(part.column(1), k))
                keys = np.frombuffer(b"".join(map(set_key, sets)), np.int64).reshape(-1, 2)
                bands = pa.FixedSizeListArray.from_arrays(pa.array(band_keys(sets, bins, rows, probes).ravel()), bins // rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys[:, 0]),
                     pa.array(keys[:, 1]), bands.cast(pa.list_(pa.int64())), part.column(2), part.column(3)],
                    ["doc_id", "n", "cls", "cls2", "bands", "text_key", "row_key"])
        return_memory()

    doc_id = F.col(id_col).cast("long")
    picked = docs.select(doc_id.alias("doc_id"), F.col(text_col).alias("text"), F.when(doc_id.isNull(), F.xxhash64(F.col(text_col))).alias("text_key"),
                         _identity(id_col, text_col).alias("row_key"))
    return picked.mapInArrow(run, "doc_id long, n long, cls long, cls2 long, bands array<long>, text_key long, row_key long")


def _row_key(doc_id: Column, text_key: Column) -> Column:
    """A hash by which rows of a wanted id, or texts without one, are found again."""
    return F.when(doc_id.isNull(), text_key).otherwise(F.xxhash64(doc_id))


def _filter_words(keys: DataFrame) -> np.ndarray:
    """A Bloom filter of the hashes in column ``key``: two bits a key among at most ``FILTER_BITS``,
    so what reaches the driver and the executors is bounded; more keys let more rows through."""
    bits = 1 << min(FILTER_BITS.bit_length() - 1, max(10, (16 * keys.count()).bit_length()))
    spots = F.explode(F.array(F.col("key"), F.xxhash64("key"))).alias("spot")
    words = (keys.select(spots).select(F.expr(f"shiftright(spot & {bits - 1}L, 6)").alias("word"), F.expr("shiftleft(1L, cast(spot & 63L as int))").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bit"))).toArrow()
    table = np.zeros(bits >> 6, np.int64)
    table[np.asarray(words.column("word"))] = np.asarray(words.column("bit"))
    return table


def _maybe(table: np.ndarray, spots: list[np.ndarray]) -> np.ndarray:
    out = np.ones(len(spots[0]), bool)
    for spot in spots:
        at = spot & ((len(table) << 6) - 1)
        out &= (table[at >> 6] >> (at & 63)) & 1 == 1
    return out


def _sets_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(cls, shingles binary) of the wanted(cls, doc_id, text_key) classes, hashed again from the
    texts where they lie: a bounded filter passes the rows of wanted ids (or, without an id, texts).
    Nothing is shuffled; repeated rows repeat a class, and others may pass."""
    keys = wanted.select(_row_key(F.col("doc_id"), F.col("text_key")).alias("key"))
    filter_ = docs.sparkSession.sparkContext.broadcast(_filter_words(keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.filter(pa.array(_maybe(filter_.value, [np.asarray(batch.column(c)) for c in (1, 2)])))
            for at, until in text_parts(some.column(0), 512):
                sets = list(shingle_sets(some.column(0).slice(at, until - at), k))
                keys = np.frombuffer(b"".join(map(set_key, sets)), np.int64).reshape(-1, 2)[:, 0]
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array([s.tobytes() for s in sets], pa.binary())], ["cls", "shingles"])
        return_memory()

    text = F.col(text_col)
    spots = docs.select(text.alias("text"), _row_key(F.col(id_col).cast("long"), F.xxhash64(text)).alias("key")).select("text", "key", F.xxhash64("key").alias("key2"))
    return spots.mapInArrow(run, "cls long, shingles binary")


def _common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of the sorted x are in the sorted y."""
    return y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs(a, b) with the shingle sets of both; sets of other classes stay where they are, if the
    pairs are few enough to be broadcast."""
    needed = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls")))
    sets = sets.join(needed, "cls", "left_semi").groupBy("cls").agg(F.first("shingles").alias("shingles"))
    left = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("y"))
    return pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "x", "y")


def _parity(shingles: np.ndarray) -> np.ndarray:
    """A bit for each residue of the hashes: whether it occurs an odd number of times."""
    odd = np.bincount((shingles % np.uint64(64 * PARITY)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _stars(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Star edges measured: (a, b, na, nb, common, linked, fresh, bits) for a centre a and a member b;
    ``fresh`` are the first shingles of b - a, in hash order, of which a linked stray must share
    one, ``bits`` is b's parity bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for left, right in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (left, right))
                known = _common(y, x)
                common = int(np.count_nonzero(known))
                must = max(1, -(-percent * len(y) // 100) - common)
                rows.append((len(x), len(y), common, 100 * common >= percent * (len(x) + len(y) - common),
                             y[~known][:max(0, len(y) - common - must + 1)].view(np.int64), _parity(y)))
            na, nb, common, linked, fresh_, bits = zip(*rows) if rows else ((),) * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(na, pa.int64()), pa.array(nb, pa.int64()), pa.array(common, pa.int64()),
                 pa.array(linked, pa.bool_()), pa.array(list(fresh_), pa.list_(pa.int64())), pa.array(list(bits), pa.list_(pa.int64()))],
                ["a", "b", "na", "nb", "common", "linked", "fresh", "bits"])

    return _with_sets(pairs, sets).mapInArrow(
        run, "a long, b long, na long, nb long, common long, linked boolean, fresh array<long>, bits array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs(a, b) with 100 * intersection >= percent * union on the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (left, right))
                common = int(np.count_nonzero(_common(x, y)))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return _with_sets(pairs, sets).mapInArrow(run, "a long, b long")


def _stray_pairs(stars: DataFrame, comps: DataFrame | None, percent: int) -> DataFrame:
    """The pairs (a < b) of members of one centre that may be linked although one of them is
    not linked with the centre, and that are not connected yet.

    Every centre that two members share gives a necessary condition.  Members of the same hub,
    their centre of most company, are paired under the hub alone."""
    rows = _labelled(stars.withColumnRenamed("b", "cls"), comps).select(
        F.col("a").alias("centre"), "cls", "comp", "hub", "linked", "fresh", F.col("nb").alias("n"),
        (F.col("na") - F.col("common")).alias("m"), (F.col("nb") - F.col("common")).alias("f"),
        *[F.col("bits")[i].alias(f"p{i}") for i in range(PARITY)])
    names = [c for c in rows.columns if c not in ("centre", "linked")]
    x = rows.where("not linked").selectExpr("centre", *[f"{c} x_{c}" for c in names])
    y = rows.selectExpr("centre", *[f"{c} y_{c}" for c in names])
    most = F.expr(f"{(100 - percent) / (100 + percent)!r}D * (x_n + y_n) + 1e-6D")  # shingles that linked sets may differ in
    need = (F.expr("x_m + x_f + y_m + y_f") - most) / 2
    alike = (F.expr(f"x_comp <> y_comp and (x_hub <> y_hub or x_hub = centre) and 100 * least(x_n, y_n) >= {percent} * greatest(x_n, y_n)")
             & (F.expr(" + ".join(f"bit_count(x_p{i} ^ y_p{i})" for i in range(PARITY))) <= most))
    by_size = x.drop("x_fresh").join(y.drop("y_fresh").where("y_m > y_f"), "centre").where(
        alike & (need <= F.least("x_m", "y_m")))
    shared = x.select("*", F.explode("x_fresh").alias("shingle")).drop("x_fresh").join(
        y.select("*", F.explode("y_fresh").alias("shingle")).drop("y_fresh"), ["centre", "shingle"]).where(
        alike & (need <= F.least("x_m", "y_m") + F.least("x_f", "y_f")))
    both = by_size.select("x_cls", "y_cls").union(shared.select("x_cls", "y_cls"))
    return both.select(F.least("x_cls", "y_cls").alias("a"), F.greatest("x_cls", "y_cls").alias("b")).distinct()


def _labelled(rows: DataFrame, comps: DataFrame | None) -> DataFrame:
    """``rows`` with the component of their cls (itself where it has no link)."""
    if comps is None:
        return rows.withColumn("comp", F.col("cls"))
    return (rows.join(comps, F.col("cls") == F.col("node"), "left")
            .withColumn("comp", F.coalesce("comp", "cls")).drop("node"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80,
                    bins: int = BINS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    Two documents are linked if the Jaccard similarity of their sets of k-word
    shingles is at least percent / 100.  ``component_id`` is the smallest id
    reachable over links, ``kept`` says that it is the document's own.

    * Null, empty and white-space texts have no shingle and are linked with nothing.
    * Texts of fewer than k words are one shingle: the whole sequence.
    * Rows that repeat an id and a text get the same result; rows that share an id but
      not the text are one node of the graph.
    * A null id is never a component's smallest; if a group has no other, its
      component_id is null.  kept compares null-safely.
    * An empty table gives an empty result.  Other columns are ignored.
    """
    found = _judged(docs, id_col, text_col, k, percent, bins, rows)
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                        F.col("doc_id").eqNullSafe(component).alias("kept"))


def _judged(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int, bins: int, rows: int) -> DataFrame:
    """(doc_id, row_key, n, comp, component_id), one row per row of ``docs``; without shingles comp is null."""
    sig = written(signatures(docs, id_col, text_col, k, bins, rows), "signatures")
    out = sig.select("doc_id", "row_key", "n", "cls")
    classes = written(sig.where("n > 0").groupBy("cls", "cls2").agg(
        F.min("doc_id").alias("rep"), F.min("text_key").alias("text_key"), F.first("bands").alias("bands")).drop("cls2"), "classes")
    in_band = classes.select("cls", F.explode("bands").alias("key"))
    shared = in_band.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = written(in_band.join(shared, "key"), "members")
    company = written(members.groupBy("cls").agg(F.sum("size").alias("company")), "company")
    ranked = members.join(company, "cls").select("key", "cls", "company")
    centres = ranked.groupBy("key").agg(F.max_by("cls", F.struct("company", "cls")).alias("centre"))
    pairs = members.join(centres, "key").where("cls <> centre").select(F.col("centre").alias("a"), F.col("cls").alias("b")).distinct()
    pairs = written(pairs, "pairs")

    nodes = pairs.select("a").union(pairs.select("b")).distinct()
    wanted = classes.join(nodes, F.col("cls") == F.col("a"), "left_semi").select("cls", F.col("rep").alias("doc_id"), "text_key")
    sets = written(_sets_of(docs, written(wanted, "wanted"), id_col, text_col, k), "sets")
    stars = written(_stars(pairs, sets, percent), "stars")
    links = stars.where("linked").select("a", "b")
    comps = None if links.isEmpty() else components(links)
    hubs = written(stars.select("a", "b").join(company, F.col("a") == F.col("cls")).groupBy("b").agg(
        F.max_by("a", F.struct("company", "a")).alias("hub")), "hubs")
    strays = written(_stray_pairs(stars.join(hubs, "b"), comps, percent), "stray-pairs")
    more = written(_confirmed(strays, sets, percent), "links")
    if not more.isEmpty():
        comps = components(links.union(more))

    labels = _labelled(classes.select("cls", "rep"), comps)
    # a class's component, its smallest id, and ids that stand for several classes
    groups = _id_groups(labels, sig)
    for table in (sets, members, company, pairs, stars, hubs, strays):
        drop_written(table)
    return out.join(groups, "cls", "left").select("doc_id", "row_key", "n", "comp", "component_id")


def _id_groups(labels: DataFrame, sig: DataFrame) -> DataFrame:
    """(cls, comp, component_id): each class's component and its smallest id.  Ids that occur
    with several texts connect their classes."""
    several = (sig.where("n > 0 and doc_id is not null").groupBy("doc_id")
               .agg(F.min("cls").alias("a"), F.max("cls").alias("b")).where("a <> b"))
    if not several.isEmpty():
        same = sig.where("n > 0").join(several.select("doc_id", "a"), "doc_id").select("a", F.col("cls").alias("b"))
        now = labels.select("cls", "comp")
        joined = (same.join(now.selectExpr("cls a", "comp ca"), "a").join(now.selectExpr("cls b", "comp cb"), "b")
                  .selectExpr("ca a", "cb b"))
        merged = components(joined)
        labels = (labels.join(merged.selectExpr("node", "comp top"), F.col("comp") == F.col("node"), "left")
                  .withColumn("comp", F.coalesce("top", "comp")).drop("node", "top"))
    smallest = labels.groupBy("comp").agg(F.min("rep").alias("component_id"))
    return labels.join(smallest, "comp").select("cls", "comp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80,
                         bins: int = BINS, rows: int = ROWS) -> DataFrame:
    """``docs`` without near-duplicates: of each group the row of the smallest id stays, once.
    Columns as given.

    * Of rows of a group that share the smallest id, and of rows without an id in a group that
      has none, one stays.  Rows without shingles are groups of their own; of such rows that
      repeat both id and text one stays.
    * The texts of rows that stay are not shuffled, but for those that a bounded filter of the
      dropped rows cannot tell from them.
    * An empty table gives an empty result.
    """
    judged = written(_judged(docs, id_col, text_col, k, percent, bins, rows), "judged")
    group = F.when(F.col("n") > 0, F.struct(F.lit(True).alias("of"), F.col("comp").alias("key"))).otherwise(
        F.struct(F.lit(False).alias("of"), F.col("row_key").alias("key")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("row_key").alias("row_key")))
    kept = judged.groupBy(group.alias("g")).agg(first.alias("f")).select("f.row_key", F.lit(True).alias("kept")).distinct()
    times = judged.groupBy("row_key").agg(F.count(F.lit(1)).alias("times"))
    verdicts = written(times.join(kept, "row_key", "left"), "verdicts")  # read by all that follows
    doubtful = verdicts.where("kept is null or times > 1")
    filter_ = docs.sparkSession.sparkContext.broadcast(_filter_words(doubtful.select(F.col("row_key").alias("key"))))

    @F.pandas_udf("boolean")
    def maybe(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(_maybe(filter_.value, [x.to_numpy(), y.to_numpy()]), dtype=bool)

    name = fresh("row_key", docs)
    marked = docs.withColumn(name, _identity(id_col, text_col))
    passed = maybe(F.col(name), F.xxhash64(name))
    some = marked.where(passed)
    once, several = (verdicts.where(f"kept and times {op} 1").select(F.col("row_key").alias(name)) for op in ("=", ">"))
    out = docs.where(~maybe(_identity(id_col, text_col), F.xxhash64(_identity(id_col, text_col)))).union(
        some.join(once, name, "left_semi").drop(name))
    if several.isEmpty():
        return out
    one = some.join(several, name, "left_semi").groupBy(name).agg(F.first(F.struct(*docs.columns)).alias("row"))
    return out.union(one.select("row.*"))
