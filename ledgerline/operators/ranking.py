"""Exact ranks and running sums inside groups without one-task windows.

``Window.partitionBy(g).orderBy(v)`` puts a whole group into one task; a group
may hold a third of all rows, and a global order (no partition) puts *all* rows
into one task.  Here a quantile sketch of the values gives each group borders of
about equal buckets.  Rows are dealt once, by (group, bucket); counts and sums of
the buckets (pre-aggregated, a few rows a group) give every bucket its offset, and a
window inside the bucket does the rest.

* The borders come from a bounded sketch of a hash sample of the rows; they decide
  how even the buckets are, never a rank.  They are collected (``buckets`` values a
  group) and are constants of the plan, so every branch and every retry of a lost task
  cuts alike; nothing is written.
* A value that fills a bucket of its own (a border that occurs twice) is a bucket
  apart, split further by the first characters of the tiebreak.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions

#: One in so many rows is sketched, by hash of the tiebreak.
SAMPLE = 16
#: Characters of the tiebreak that split rows of one value.
PREFIX = 4


def borders(df: DataFrame, group_cols: list[str], value: str, tie: str, buckets: int, sample: int = SAMPLE) -> DataFrame:
    """(groups, _cuts, _heavy): descending borders of each group, and those that occur twice.
    One row a group reaches the driver and comes back as a constant table."""
    probabilities = F.array(*[F.lit(1 - i / buckets) for i in range(1, buckets)])
    some = df.where(F.pmod(F.xxhash64(tie), F.lit(sample)) == 0) if sample > 1 else df
    cuts = some.where(F.col(value).isNotNull()).groupBy(*group_cols).agg(
        F.percentile_approx(value, probabilities, F.lit(20 * buckets)).alias("_cuts"))
    rows = cuts.collect()
    kind = cuts.schema["_cuts"].dataType
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in cuts.schema if f.name != "_cuts"]
                       + [f"_cuts {kind.simpleString()}", f"_heavy {kind.simpleString()}"])
    out = [(*[r[g] for g in group_cols], r._cuts, sorted({a for a, b in zip(r._cuts, r._cuts[1:]) if a == b}))
           for r in rows if r._cuts]
    return df.sparkSession.createDataFrame(out, schema)


def _above(cuts: Column, value: Column, size: int) -> Column:
    """How many of the descending ``cuts`` are above ``value``: first by every ``step``-th, then among ``step``."""
    step = max(1, math.isqrt(size))
    coarse = F.size(F.filter(F.filter(cuts, lambda _, i: i % step == 0), lambda c: c > value))
    inside = F.size(F.filter(F.slice(cuts, (coarse - 1) * step + 1, F.lit(step)), lambda c: c > value))
    return F.when(coarse == 0, F.lit(0)).otherwise((coarse - 1) * step + inside)


def _with_buckets(df: DataFrame, group_cols: list[str], value: str, tie: str, buckets: int, cuts: DataFrame) -> DataFrame:
    """``df`` with ``_b``, ``_e``, ``_p``: bucket, whether the value is a heavy one, and then the
    start of the tiebreak.  Their order is the order of the values."""
    if group_cols:
        named = cuts.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group_cols)], "_cuts", "_heavy")
        same = F.lit(True)
        for i, g in enumerate(group_cols):
            same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
        x = df.join(named, same, "left").drop(*[f"_g{i}" for i in range(len(group_cols))])
    else:
        kind = cuts.schema["_cuts"].dataType
        row = cuts.first()
        constant = {c: (F.array(*[F.lit(v) for v in row[c]]) if row else F.array()).cast(kind) for c in ("_cuts", "_heavy")}
        x = df.withColumns(constant)
    v = F.col(value)
    x = x.withColumn("_b", F.when(v.isNull(), F.lit(buckets)).when(F.col("_cuts").isNull(), F.lit(0))
                     .otherwise(_above(F.col("_cuts"), v, buckets)))
    x = x.withColumn("_e", F.coalesce(F.array_contains("_heavy", v), v.isNull()).cast("int"))
    return x.withColumn("_p", F.when(F.col("_e") == 1, F.substring(F.col(tie).cast("string"), 1, PREFIX)).otherwise("")).drop("_cuts", "_heavy")


def rank_in_groups(df: DataFrame, group_cols: list[str], value: str, tie: str, sum_col: str | None = None,
                   buckets: int | None = None, sample: int = SAMPLE) -> DataFrame:
    """Add ``_rank`` (1-based row number by ``value`` descending, nulls last, then ``tie`` ascending
    inside each group), ``_group_n`` (group size) and, when ``sum_col`` is given, ``_cum`` (running
    sum of ``sum_col`` in rank order) and ``_group_sum``.

    ``tie`` must be a string column that is unique among equal values of a group.
    """
    if df.schema[tie].dataType.simpleString() != "string":
        raise ValueError("the tiebreak must be a string column")
    n = buckets or min(1024, max(8, shuffle_partitions(df.sparkSession)))
    cuts = borders(df, group_cols, value, tie, n, sample)
    x = _with_buckets(df, group_cols, value, tie, n, cuts)
    key = [*group_cols, "_b", "_e", "_p"]

    aggs = [F.count(F.lit(1)).alias("_n")] + ([F.sum(sum_col).alias("_s")] if sum_col else [])
    # One row per bucket: at most 2 x buckets rows a group, and the prefixes of heavy values.
    stats = x.groupBy(*key).agg(*aggs)
    whole = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy()
    before = whole.orderBy("_b", "_e", "_p").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("_group_n", F.sum("_n").over(whole))
    if sum_col:
        kind = stats.schema["_s"].dataType
        stats = (stats.withColumn("_sbefore", F.coalesce(F.sum("_s").over(before), F.lit(0).cast(kind)))
                 .withColumn("_group_sum", F.sum("_s").over(whole)).drop("_s"))
    stats = stats.drop("_n").select(*[F.col(c).alias(f"_k{i}") if c in key else F.col(c)
                                      for i, c in [(key.index(c) if c in key else -1, c) for c in stats.drop("_n").columns]])

    inside = Window.partitionBy(*key).orderBy(F.col(value).desc(), F.col(tie).asc())
    x = x.withColumn("_row", F.row_number().over(inside))
    if sum_col:
        x = x.withColumn("_lcum", F.sum(sum_col).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    same = F.lit(True)
    for i, c in enumerate(key):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    out = x.join(stats, same).withColumn("_rank", F.col("_before") + F.col("_row"))
    if sum_col:
        out = out.withColumn("_cum", F.col("_sbefore") + F.coalesce("_lcum", F.lit(0))).drop("_sbefore", "_lcum")
    return out.drop(*[f"_k{i}" for i in range(len(key))], "_b", "_e", "_p", "_row", "_before")
