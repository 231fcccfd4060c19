"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed draw, 60 bits of the md5 of its id.  A source whose target
is e whole epochs and a remainder takes every document e times, and those whose draw
lies below the source's threshold once more.  Thresholds are found without sorting
documents: words are summed by (source, top ``BITS`` bits of the draw), a running sum
over that histogram finds the bucket in which the remainder is met, and only the
documents of that boundary bucket are summed again by the next ``BITS`` bits,
``LEVELS`` times in all.  The last boundary cell (2**-36 of the draws) is taken if that
comes nearer to the target.  Thresholds of smaller budgets lie below those of larger
ones, so the mixes of growing budgets are nested.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import fresh, written

BITS, LEVELS, DRAW = 12, 3, 60


def word_count(text: Column) -> Column:
    """The number of ``[^\\x20\\x09-\\x0D]+`` in a text (null: 0)."""
    marked = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "w")
    return F.coalesce(F.length(F.translate(marked, " \t\n\x0b\x0c\r", "")), F.lit(0)).cast("long")


def draw(id_col: Column) -> Column:
    """The first 60 bits of md5(id as text); null ids draw as the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(id_col.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def _key(source: Column) -> Column:
    """A source as a non-null join key."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(key, source_size, target) from sizes(key, source, source_size).

    Sources in code-point order, null last, weigh ``weights``, repeating, and share
    ``share`` times all words.  A target stops at ``most`` times its source's words; the excess
    is shared again by weight until none is above: in ascending order of most * size / weight a
    source is full if its part of what the earlier, full ones leave exceeds that.
    The windows run over one row per source."""
    rank = F.row_number().over(W.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    full = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    total = F.sum("source_size").over(W.partitionBy()) * F.lit(float(share))
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    level = full.withColumn("level", (total - before) / after)
    open_level = F.when(F.col("level") * F.col("weight") < F.col("cap"), F.col("level"))
    level = level.withColumn("final", F.max(open_level).over(W.partitionBy()))
    return level.select("key", "source_size", F.least("cap", F.coalesce(F.col("final") * F.col("weight"), F.col("cap"))).alias("target"))


def _thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """(key, source_size, target, epochs, threshold): draws below the threshold count once more."""
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = targets.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    state = written(state.withColumn("cell", F.lit(0).cast("long")).withColumn("below", F.lit(0).cast("long"))
                    .withColumn("inside", F.col("source_size")), "targets")
    for level in range(LEVELS):
        shift = DRAW - BITS * (level + 1)
        cell = F.shiftright("draw", shift)
        in_boundary = F.shiftright("draw", shift + BITS) == F.col("cell")
        histogram = (sized.join(state.where("rest > 0").select("key", "cell"), "key").where(in_boundary)
                     .groupBy("key", cell.alias("at")).agg(F.sum("size").alias("words")))
        running = F.sum("words").over(W.partitionBy("key").orderBy("at"))  # at most 2**BITS rows a source
        summed = histogram.withColumn("upto", running).join(state.select("key", "rest", "below"), "key")
        met = summed.where(F.col("below") + F.col("upto") >= F.col("rest")).groupBy("key").agg(
            F.min(F.struct("at", "upto", "words")).alias("m")).select("key", "m.*")
        state = written(state.join(met, "key", "left").select(
            "key", "source_size", "target", "epochs", "rest", F.coalesce("at", "cell").alias("cell"),
            (F.col("below") + F.coalesce(F.col("upto") - F.col("words"), F.lit(0))).alias("below"),
            F.coalesce("words", F.lit(0)).alias("inside")), "targets")
    nearer = F.col("below") + F.col("inside") - F.col("rest") < F.col("rest") - F.col("below")
    edge = F.shiftleft(F.col("cell") + F.when(nearer, 1).otherwise(0), DRAW - BITS * LEVELS)
    return state.select("key", "source_size", "target", "epochs", F.when(F.col("rest") > 0, edge).otherwise(0).alias("threshold"))


def mixture(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
            id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(doc_id, source, size, source_size, target, epochs, taken), one row per row of ``docs``.

    ``epochs`` says how often the mix takes the document, ``taken`` = epochs * size.

    * Null texts have size 0; a null source is a source of its own, the last in order.
    * Rows that repeat an id share one draw and are taken alike; so are rows without an id.
    * Sources without words have target 0.  An empty table gives an empty result.
    * Only the id, source and text columns are read.
    """
    # Sizes and draws are written once (a few bytes a document), so texts are scanned once.
    sized = written(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                word_count(F.col(text_col)).alias("size"), draw(F.col(id_col)).alias("draw"),
                                _key(F.col(source_col)).alias("key")), "sized")
    sizes = sized.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    # The plan is a written table of one row a source: Spark broadcasts it only if its files are small.
    plan = written(_thresholds(sized, source_targets(sizes, weights, share, most)), "plan")
    epochs = F.col("epochs") + (F.col("draw") < F.col("threshold")).cast("long")
    return sized.join(plan, "key").select(
        "doc_id", "source", "size", "source_size", "target", epochs.alias("epochs"), (epochs * F.col("size")).alias("taken"), "draw")


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """``docs`` as the mix takes them: rows it leaves out are gone, rows of several epochs
    appear as often; columns as given.

    Each row's epochs follow from its own draw and its source's plan, so texts are neither
    sorted nor shuffled (the plan is joined by source)."""
    sized = written(docs.select(F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
                                draw(F.col(id_col)).alias("draw"), _key(F.col(source_col)).alias("key")), "sized")
    sizes = sized.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    weights, share, most = options.get("weights", (5, 2, 1)), options.get("share", 1.5), options.get("most", 2.0)
    plan = written(_thresholds(sized, source_targets(sizes, weights, share, most)), "plan")
    key, times, limit, again = (fresh(x, docs) for x in ("key", "epochs", "threshold", "again"))
    plan = plan.select(F.col("key").alias(key), F.col("epochs").alias(times), F.col("threshold").alias(limit))
    total = F.col(times) + (draw(F.col(id_col)) < F.col(limit)).cast("long")
    joined = docs.join(plan, _key(F.col(source_col)) == F.col(key)).where(total > 0)
    return joined.select(*docs.columns, F.explode(F.sequence(F.lit(1).cast("long"), total)).alias(again)).drop(again)
