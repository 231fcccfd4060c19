"""Financial aggregations (F1–F24) over the PlayerRecord fact.

Input ``pa``: one row per player report (``id, brand, report_month, client,
country, wb_tag, segment`` + money measures as DECIMAL + ``deposit_count``).
Money stays DECIMAL inside the operators so every sum is exact and order-free;
``as_report`` casts it to DOUBLE for output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..functions.core import (MONEY, count_if, dbl, distinct_count, money_sum, month_from_index, month_index,
                              quarter_label, rev_share, safe_div, safe_pct)
from .. import session

COMBINED = "Combined"

# Summary measures: output name → PlayerRecord column.
SUM_MEASURES = {
    "ggr": "revenue", "ngr": "ngr", "total_handle": "bet",
    "turnover_casino": "bet_casino", "ggr_casino": "revenue_casino", "ngr_casino": "ngr_casino",
    "turnover_sports": "bet_sports", "ggr_sports": "revenue_sports", "ngr_sports": "ngr_sports",
    "deposits": "deposits", "withdrawals": "withdrawals", "bonus_total": "bonus_total",
    "bonus_casino": "bonus_casino", "bonus_sports": "bonus_sports", "tax_total": "tax_total",
}

# The monthly brand summary column order.
SUMMARY_COLS = [
    "month", "brand", "negative_yield_players", "profitable_players", "flat", "total_players",
    "profitable_pct", "ggr", "ngr", "total_handle", "turnover_casino", "ggr_casino", "ngr_casino",
    "turnover_sports", "ggr_sports", "ngr_sports", "hold_pct", "ggr_per_player",
    "turnover_per_player", "top_10_pct_ggr_share", "new_players", "returning_players",
    "reactivated_players", "conversions", "retention_pct", "new_player_ggr",
    "returning_player_ggr", "revenue_share_deduction", "deposit_count", "deposits",
    "withdrawals", "net_deposits", "bonus_total", "bonus_casino", "bonus_sports", "tax_total",
]

# The columns that Combined sums, in the order of ``SUMMARY_COLS``: all but keys and ratios.
_RATIO_COLS = {"profitable_pct", "hold_pct", "ggr_per_player", "turnover_per_player", "top_10_pct_ggr_share", "retention_pct"}
ADDITIVE_COLS = [c for c in SUMMARY_COLS if c not in _RATIO_COLS | {"month", "brand"}]

COUNT_COLS = {"negative_yield_players", "profitable_players", "flat", "total_players",
              "deposit_count", "new_players", "returning_players", "reactivated_players",
              "conversions"}


def as_report(df: DataFrame) -> DataFrame:
    """Cast DECIMAL columns to DOUBLE and integral counts to BIGINT for output."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        elif f.dataType.typeName() in ("integer", "short", "byte"):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _keyed(pa: DataFrame, keys: list[str]) -> DataFrame:
    """pandas ``groupby`` drops null keys."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return pa.where(cond) if cond is not None else pa


# ---------------------------------------------------------------------------
# F1 / F2 / F3
# ---------------------------------------------------------------------------

def monthly_financials(pa: DataFrame) -> DataFrame:
    """per (brand, month) player-status counts, 15 sums and ratios."""
    rev = F.col("revenue")
    aggs = [
        count_if(rev < 0).alias("negative_yield_players"),
        count_if(rev > 0).alias("profitable_players"),
        count_if(rev == 0).alias("flat"),
        F.count("id").alias("total_players"),
    ]
    aggs += [money_sum(src).alias(name) for name, src in SUM_MEASURES.items()]
    aggs.append(F.coalesce(F.sum("deposit_count"), F.lit(0)).cast("bigint").alias("deposit_count"))
    out = (_keyed(pa, ["brand", "report_month"])
           .groupBy("brand", F.col("report_month").alias("month")).agg(*aggs))
    return (out
            .withColumn("net_deposits", (F.col("deposits") - F.col("withdrawals")).cast(MONEY))
            .withColumn("profitable_pct", safe_pct("profitable_players", "total_players"))
            .withColumn("ggr_per_player", safe_div("ggr", "total_players"))
            .withColumn("hold_pct", safe_pct("ggr", "total_handle")))


def _amount_bucket(value):
    """An order-keeping bucket of a positive amount, about 1 % wide (null for others): a money
    amount of 18 digits falls in one of some 4,200."""
    return F.when(F.col(value) > 0, F.floor(F.log(dbl(value)) * 100))


def whale_shares(pa: DataFrame) -> DataFrame:
    """F2 for both levels: per (brand, month) and, with ``brand = 'Combined'``, per month
    over all brands.

    n = max(1, ⌊count/10⌋) of rows with revenue > 0; share = top-n revenue /
    total GGR of the group × 100, 0 when GGR is 0.  The top-n sum does not
    depend on tie order, so no row needs a rank: a histogram of amounts finds the
    bucket where the n-th largest lies, whole buckets above are summed, and only
    the distinct amounts inside that bucket are ordered.  The Combined level
    rolls up the same histogram.  All consumers read one exchange of
    (brand, month, amount) counts, which a hot brand spreads over its amounts.
    """
    amounts = (_keyed(pa.withColumn("month", F.col("report_month")), ["month"])
               .groupBy("brand", "month", "revenue")
               .agg(F.count(F.lit(1)).alias("_n"), F.sum("revenue").alias("_s"))
               .withColumn("_bucket", _amount_bucket("revenue")))
    sums = [F.sum("_n").alias("_n"), F.sum("_s").alias("_s")]
    per_brand = amounts.groupBy("brand", "month", "_bucket").agg(*sums)
    keys = ["_level", "_entity", "month"]
    hist = per_brand.where(F.col("brand").isNotNull()).select(
        F.lit(0).alias("_level"), F.col("brand").alias("_entity"), "month", "_bucket", "_n", "_s")
    hist = hist.unionByName(per_brand.groupBy("month", "_bucket").agg(*sums).select(
        F.lit(1).alias("_level"), F.lit(COMBINED).alias("_entity"), "month", "_bucket", "_n", "_s"))

    # windows over one group's buckets
    group = Window.partitionBy(*keys)
    larger = group.orderBy(F.col("_bucket").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    positive = F.sum(F.when(F.col("_bucket").isNotNull(), F.col("_n"))).over(group)
    hist = (hist.withColumn("_top_n", F.greatest(F.lit(1), F.floor(positive / 10)))
            .withColumn("_before", F.coalesce(F.sum("_n").over(larger), F.lit(0)))
            .withColumn("_above", F.coalesce(F.sum("_s").over(larger), F.lit(0))))
    is_edge = (F.col("_bucket").isNotNull() & (F.col("_before") < F.col("_top_n"))
               & (F.col("_before") + F.col("_n") >= F.col("_top_n")))
    edge = F.struct("_bucket", (F.col("_top_n") - F.col("_before")).alias("_rest"), "_above")
    edges = hist.groupBy(*keys).agg(F.coalesce(F.sum("_s"), F.lit(0)).alias("_ggr"),
                                    F.max(F.when(is_edge, edge)).alias("_edge"))

    open_edges = edges.where(F.col("_edge").isNotNull()).select(*keys, "_edge._bucket", "_edge._rest")
    of_brand = open_edges.where("_level = 0").withColumn("brand", F.col("_entity"))
    inside = amounts.join(of_brand, ["brand", "month", "_bucket"]).select(*keys, "_rest", "revenue", "_n").unionByName(
        amounts.join(open_edges.where("_level = 1"), ["month", "_bucket"]).select(*keys, "_rest", "revenue", "_n"))
    inside = inside.groupBy(*keys, "_rest", "revenue").agg(F.sum("_n").alias("_n"))
    # the distinct amounts of one group that lie within 1 % of each other
    before = Window.partitionBy(*keys).orderBy(F.col("revenue").desc()).rowsBetween(Window.unboundedPreceding, -1)
    rest = F.col("_rest") - F.coalesce(F.sum("_n").over(before), F.lit(0))
    taken = (inside.withColumn("_take", F.greatest(F.lit(0), F.least(F.col("_n"), rest)))
             .groupBy(*keys).agg(F.sum(F.col("revenue") * F.col("_take")).alias("_part")))
    top = F.coalesce(F.col("_edge._above") + F.col("_part"), F.lit(0))
    share = F.when(F.col("_ggr") != 0, dbl(top) / dbl("_ggr") * F.lit(100.0)).otherwise(F.lit(0.0))
    return edges.join(taken, keys, "left").select(
        "_level", F.col("_entity").alias("brand"), "month", share.alias("top_10_pct_ggr_share"))


def whale_share(pa: DataFrame, by_brand: bool = True) -> DataFrame:
    """F2 at one level (see ``whale_shares``)."""
    w = whale_shares(pa).where(F.col("_level") == (0 if by_brand else 1))
    return w.select("brand", "month", "top_10_pct_ggr_share") if by_brand else w.select("month", "top_10_pct_ggr_share")


def cohort_counts(pa: DataFrame) -> DataFrame:
    """new / returning / reactivated players per brand month.

    ``new`` = first month of the player in the brand; ``returning`` = seen
    before; ``reactivated`` = returning but absent from the brand's previous
    month *that has data*.  Months are ranked per brand on the small distinct
    (brand, month) table; the per-player ``lag`` runs on (brand, id) partitions,
    so no window ever holds a whole brand.
    """
    # One exchange on (brand, id) serves both the per-player aggregate and the
    # per-player lag window below (hash partitioning on a subset of the keys).  Its parts
    # follow the rows, not their bytes (these rows take far more memory) or the session alone.
    parts = session.counted_parts(pa, session.COHORT_ROWS_A_TASK)
    bim = (_keyed(pa, ["brand", "report_month", "id"])
           .repartition(parts, "brand", "id")
           .groupBy("brand", "id", F.col("report_month").alias("month"))
           .agg(money_sum("revenue").alias("rev")))
    # Months with data per brand, straight from the scan (partial distinct
    # before the exchange), so the big (brand, id) exchange is not repeated.
    months = (_keyed(pa, ["brand", "report_month"])
              .select("brand", F.col("report_month").alias("month")).distinct())
    months = months.withColumn("_mrank", F.dense_rank().over(Window.partitionBy("brand").orderBy("month")))
    # (brand, month) pairs are bounded by registered brands × calendar months.
    x = bim.join(F.broadcast(months), ["brand", "month"])
    prev = F.lag("_mrank").over(Window.partitionBy("brand", "id").orderBy("month"))
    x = x.withColumn("_prev", prev)
    is_new = F.col("_prev").isNull()
    is_ret = F.col("_prev").isNotNull()
    is_react = F.col("_prev") < F.col("_mrank") - 1
    zero = F.lit(0).cast(MONEY)
    out = x.groupBy("brand", "month").agg(
        count_if(is_new).alias("new_players"),
        count_if(is_ret).alias("returning_players"),
        count_if(is_react).alias("reactivated_players"),
        F.sum(F.when(is_new, F.col("rev")).otherwise(zero)).cast(MONEY).alias("new_player_ggr"),
        F.sum(F.when(is_ret, F.col("rev")).otherwise(zero)).cast(MONEY).alias("returning_player_ggr"),
    )
    return out.withColumn("conversions", (F.col("new_players") + F.col("reactivated_players")).cast("bigint"))


# ---------------------------------------------------------------------------
# F4 padding, F5 summary, F6 combined
# ---------------------------------------------------------------------------

def pad_months(df: DataFrame, entity: str = "brand", month: str = "month",
               force_start: str | None = None, force_end: str | None = None,
               present: DataFrame | None = None) -> DataFrame:
    """every entity gets every month between the global min and max (or the
    forced bounds); missing measures become 0.

    The spine is built per entity with ``explode(sequence(...))`` from the small
    per-entity table — no cross join.  ``present`` may give the (entity, month)
    pairs of ``df`` where they are cheaper to compute than ``df`` itself.
    """
    ents = (df if present is None else present).groupBy(entity).agg(F.min(month_index(month)).alias("_lo"), F.max(month_index(month)).alias("_hi"))
    allw = Window.partitionBy()
    lo = F.lit(force_start) if force_start else None
    hi = F.lit(force_end) if force_end else None
    ents = ents.withColumn("_glo", month_index(lo) if lo is not None else F.min("_lo").over(allw))
    ents = ents.withColumn("_ghi", month_index(hi) if hi is not None else F.max("_hi").over(allw))
    spine = ents.select(entity, F.explode(F.sequence("_glo", "_ghi")).alias("_mi")) \
        .select(entity, month_from_index("_mi").alias(month))
    padded = spine.join(df, [entity, month], "left")
    fills = {}
    for f in df.schema.fields:
        if f.name in (entity, month):
            continue
        t = f.dataType.typeName()
        if isinstance(f.dataType, DecimalType) or t in ("double", "float", "long", "integer", "short"):
            fills[f.name] = F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType))
    return padded.select(entity, month, *[fills.get(c, F.col(c)).alias(c) for c in df.columns
                                          if c not in (entity, month)])


def _derive_summary_ratios(df: DataFrame) -> DataFrame:
    return (df
            .withColumn("profitable_pct", safe_pct("profitable_players", "total_players"))
            .withColumn("hold_pct", safe_pct("ggr", "total_handle"))
            .withColumn("ggr_per_player", safe_div("ggr", "total_players"))
            .withColumn("retention_pct", safe_pct("returning_players", "total_players"))
            .withColumn("turnover_per_player", safe_div("total_handle", "total_players")))


def monthly_brand_summary(pa: DataFrame, force_start: str | None = None,
                          force_end: str | None = None, include_combined: bool = True,
                          whales: bool = True) -> DataFrame:
    """F1 ⟕ F3, padded (F4), + Combined (F6), ⟕ F2; SUMMARY_COLS order.

    Views that do not show the whale share leave it out with ``whales=False``
    (the column is null).  Nothing runs before an action."""
    fin = monthly_financials(pa)
    rows = pad_months(fin.join(cohort_counts(pa), ["brand", "month"], "left"), "brand", "month", force_start, force_end,
                      present=fin.select("brand", "month"))
    rows = rows.withColumn("revenue_share_deduction", rev_share("ggr")).select("brand", "month", *ADDITIVE_COLS)
    summ = with_combined(rows) if include_combined else rows.withColumn("_level", F.lit(0))
    summ = _derive_summary_ratios(summ)
    if whales:
        summ = summ.join(whale_shares(pa), ["_level", "brand", "month"], "left").withColumn(
            "top_10_pct_ggr_share", F.coalesce("top_10_pct_ggr_share", F.lit(0.0)))
    else:
        summ = summ.withColumn("top_10_pct_ggr_share", F.lit(None).cast("double"))
    return summ.select(*SUMMARY_COLS)


def with_combined(brand_rows: DataFrame) -> DataFrame:
    """the brand rows (``_level`` 0) and the sums of their additive columns per month
    (``_level`` 1, brand Combined), from one evaluation of the brand rows."""
    entity = F.explode(F.array(F.struct(F.lit(0).alias("_level"), F.col("brand").alias("_entity")),
                               F.struct(F.lit(1).alias("_level"), F.lit(COMBINED).alias("_entity"))))
    rows = brand_rows.select(entity.alias("_e"), "month", *ADDITIVE_COLS)
    sums = [F.sum(c).cast("bigint" if c in COUNT_COLS else MONEY).alias(c) for c in ADDITIVE_COLS]
    return rows.groupBy(F.col("_e._level").alias("_level"), F.col("_e._entity").alias("brand"), "month").agg(*sums)


# ---------------------------------------------------------------------------
# F7 all-business summary
# ---------------------------------------------------------------------------

# The all-business summary column order.
BOTH_BUSINESS_COLS = [
    "month", "turnover", "ggr", "ngr", "margin", "turnover_casino", "ggr_casino", "ngr_casino",
    "turnover_sports", "ggr_sports", "ngr_sports", "revenue_share_deduction", "net_income",
    "new_players", "returning_players", "reactivated_players", "conversions", "total_players",
    "profitable_players", "negative_yield_players", "new_players_pct", "returning_players_pct",
    "ggr_per_player", "turnover_per_player", "income_per_player", "new_player_ggr",
    "returning_player_ggr", "deposit_count", "deposits", "withdrawals", "net_deposits",
    "bonus_total", "bonus_casino", "bonus_sports", "tax_total",
]


def both_business_summary(brand_summary: DataFrame) -> DataFrame:
    """from brand rows only; total players = new + returning."""
    real = brand_summary.where(F.col("brand") != COMBINED)
    money_cols = ["ggr", "ngr", "turnover_casino", "ggr_casino", "ngr_casino", "turnover_sports",
                  "ggr_sports", "ngr_sports", "new_player_ggr", "returning_player_ggr", "deposits",
                  "withdrawals", "bonus_total", "bonus_casino", "bonus_sports", "tax_total"]
    count_cols = ["new_players", "returning_players", "reactivated_players", "conversions",
                  "profitable_players", "negative_yield_players", "deposit_count"]
    bb = real.groupBy("month").agg(
        F.sum("total_handle").cast(MONEY).alias("turnover"),
        *[F.sum(c).cast(MONEY).alias(c) for c in money_cols],
        *[F.sum(c).cast("bigint").alias(c) for c in count_cols])
    bb = (bb
          .withColumn("net_deposits", (F.col("deposits") - F.col("withdrawals")).cast(MONEY))
          .withColumn("margin", safe_pct("ggr", "turnover"))
          .withColumn("revenue_share_deduction", rev_share("ggr"))
          .withColumn("net_income", (F.col("ggr") - F.col("revenue_share_deduction")).cast(MONEY))
          .withColumn("total_players", (F.col("new_players") + F.col("returning_players")).cast("bigint"))
          .withColumn("new_players_pct", safe_pct("new_players", "total_players"))
          .withColumn("returning_players_pct", safe_pct("returning_players", "total_players"))
          .withColumn("ggr_per_player", safe_div("ggr", "total_players"))
          .withColumn("income_per_player", safe_div("net_income", "total_players"))
          .withColumn("turnover_per_player", safe_div("turnover", "total_players")))
    return bb.select(*BOTH_BUSINESS_COLS)


# ---------------------------------------------------------------------------
# F8–F11 time series
# ---------------------------------------------------------------------------

# Metrics carried through the time-series report.
TS_METRICS = ["turnover", "ggr", "ngr", "revenue_share_deduction", "total_players", "new_players",
              "returning_players", "reactivated_players", "conversions", "profitable_players",
              "negative_yield_players"]


def _ts_input(summary: DataFrame, entity: str) -> DataFrame:
    if "turnover" not in summary.columns and "total_handle" in summary.columns:
        summary = summary.withColumn("turnover", F.col("total_handle"))
    if entity not in summary.columns:
        summary = summary.withColumn(entity, F.lit(COMBINED))
    return summary


def time_series(summary: DataFrame, entity: str = "brand") -> DataFrame:
    """F8 MoM / YoY, F9 YTD and F10 EOY projections per entity.

    Input must be month-padded (F4) so ``lag(1)``/``lag(12)`` are calendar
    shifts.  Windows are partitioned by entity (brand count × months rows).
    """
    s = _ts_input(summary, entity)
    avail = [m for m in TS_METRICS if m in s.columns]
    s = s.select(entity, "month", *avail)
    w = Window.partitionBy(entity).orderBy("month")
    year = F.substring("month", 1, 4)
    mon = F.substring("month", 6, 2).cast("int")
    wy = Window.partitionBy(entity, year).orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    cols = [F.col(entity), F.col("month")] + [F.col(m) for m in avail]
    for m in avail:
        prev = F.lag(m, 1).over(w)
        cols += [(F.col(m) - prev).alias(f"{m}_mom_delta"),
                 safe_pct(F.col(m) - prev, prev).alias(f"{m}_mom_pct")]
    for m in avail:
        prev = F.lag(m, 12).over(w)
        cols += [(F.col(m) - prev).alias(f"{m}_yoy_delta"),
                 safe_pct(F.col(m) - prev, prev).alias(f"{m}_yoy_pct")]
    for m in avail:
        cols.append(F.sum(m).over(wy).alias(f"{m}_ytd"))
    out = s.select(*cols)
    # EOY projections for ggr and turnover.
    for p in ["ggr", "turnover"]:
        if p not in avail:
            continue
        ytd = F.col(f"{p}_ytd")
        frame = w.rowsBetween(-2, 0)
        rolling3 = dbl(F.sum(p).over(frame)) / F.count(p).over(frame)
        naive = dbl(ytd) / mon * 12
        prev_ytd = F.lag(f"{p}_ytd", 12).over(w)
        year_total = F.sum(p).over(Window.partitionBy(entity, year))
        out = out.withColumn(f"_{p}_year_total", year_total)
        prev_total = F.lag(f"_{p}_year_total", 12).over(w)
        out = out.withColumn(f"eoy_momentum_{p}", dbl(ytd) + rolling3 * (F.lit(12) - mon))
        out = out.withColumn(
            f"eoy_seasonal_{p}",
            F.when(prev_ytd.isNotNull() & (prev_ytd != 0), dbl(ytd) * (dbl(prev_total) / dbl(prev_ytd)))
             .otherwise(naive)).drop(f"_{p}_year_total")
    if "eoy_momentum_ggr" in out.columns:
        out = out.withColumn("eoy_momentum_revenue_share_deduction", F.col("eoy_momentum_ggr") * 0.15)
        out = out.withColumn("eoy_seasonal_revenue_share_deduction", F.col("eoy_seasonal_ggr") * 0.15)
    return out


def quarterly(summary: DataFrame, entity: str = "brand") -> DataFrame:
    """sums by calendar quarter, delta and pct vs the previous quarter row."""
    s = _ts_input(summary, entity)
    avail = [m for m in TS_METRICS if m in s.columns]
    q = s.groupBy(entity, quarter_label("month").alias("quarter")).agg(
        *[F.sum(m).alias(m) for m in avail])
    w = Window.partitionBy(entity).orderBy("quarter")
    cols = [F.col(entity), F.col("quarter")] + [F.col(m) for m in avail]
    for m in avail:
        prev = F.lag(m, 1).over(w)
        cols += [(F.col(m) - prev).alias(f"{m}_qoq_delta"),
                 safe_pct(F.col(m) - prev, prev).alias(f"{m}_qoq_pct")]
    return q.select(*cols)


# ---------------------------------------------------------------------------
# F12–F16 breakdowns
# ---------------------------------------------------------------------------

def segmentation(pa: DataFrame) -> DataFrame:
    """(brand, month, wb_tag) → player row count and GGR."""
    return (_keyed(pa, ["brand", "report_month", "wb_tag"])
            .groupBy("brand", F.col("report_month").alias("month"), "wb_tag")
            .agg(F.count("id").alias("total_players"), money_sum("revenue").alias("ggr")))


def program_summary(pa: DataFrame, approx: bool = False) -> DataFrame:
    """(brand, month, program) → GGR, turnover, distinct players, margin."""
    g = (_keyed(pa, ["brand", "report_month", "wb_tag"])
         .groupBy("brand", F.col("report_month").alias("month"), F.col("wb_tag").alias("program"))
         .agg(money_sum("revenue").alias("ggr"), money_sum("bet").alias("turnover"),
              distinct_count("id", approx).alias("total_players")))
    return g.withColumn("margin", safe_pct("ggr", "turnover"))


def geographic_summary(pa: DataFrame, approx: bool = False) -> DataFrame:
    """by country; ``Global`` relabelled ``Unknown`` after grouping."""
    g = (_keyed(pa, ["country"]).groupBy("country")
         .agg(distinct_count("id", approx).alias("total_players"), money_sum("bet").alias("turnover"),
              money_sum("revenue").alias("ggr"), money_sum("ngr").alias("ngr"),
              money_sum("deposits").alias("deposits")))
    return (g.withColumn("country", F.when(F.col("country") == "Global", F.lit("Unknown"))
                         .otherwise(F.col("country")))
            .withColumn("margin", safe_pct("ggr", "turnover")))


def segment_roi(pa: DataFrame, approx: bool = False) -> DataFrame:
    """by segment (fallback wb_tag): players, turnover, GGR, NGR, bonus,
    NGR per player, margin, 15 % of NGR and the actual earning."""
    seg = F.coalesce(F.col("segment"), F.col("wb_tag")) if "segment" in pa.columns else F.col("wb_tag")
    g = (pa.withColumn("_seg", seg).where(F.col("_seg").isNotNull()).groupBy(F.col("_seg").alias("segment"))
         .agg(distinct_count("id", approx).alias("total_players"), money_sum("bet").alias("total_turnover"),
              money_sum("revenue").alias("total_ggr"), money_sum("ngr").alias("total_ngr"),
              money_sum("bonus_total").alias("total_bonus")))
    return (g.withColumn("avg_ngr_per_player", safe_div("total_ngr", "total_players"))
            .withColumn("margin_pct", F.when(F.col("total_turnover") > 0,
                                             dbl("total_ggr") / dbl("total_turnover") * 100.0).otherwise(0.0))
            .withColumn("rev_share_15", rev_share("total_ngr"))
            .withColumn("actual_earning", (F.col("total_ngr") - F.col("rev_share_15")).cast(MONEY)))


def campaign_summary(cm: DataFrame, include_combined: bool = True) -> DataFrame:
    """F16: LI scrub (type exactly ``LI`` → records and logins 0), sums of six
    counters by (brand, month), two rates, Combined rows."""
    is_li = F.upper(F.trim(F.col("campaign_type"))) == "LI"
    c = (cm.withColumn("records", F.when(is_li, F.lit(0)).otherwise(F.col("records")))
         .withColumn("kpi2_logins", F.when(is_li, F.lit(0)).otherwise(F.col("kpi2_logins"))))
    sums = [F.coalesce(F.sum(src), F.lit(0)).cast("bigint").alias(dst) for dst, src in [
        ("total_records", "records"), ("total_kpi1", "kpi1_conversions"), ("total_kpi2", "kpi2_logins"),
        ("total_calls", "calls"), ("total_emails", "emails_sent"), ("total_sms", "sms_sent")]]
    s = _keyed(c, ["brand", "report_month"]).groupBy("brand", F.col("report_month").alias("month")).agg(*sums)

    def rates(df):
        return (df.withColumn("kpi1_conversion_rate", safe_pct("total_kpi1", "total_records"))
                .withColumn("kpi2_login_rate", safe_pct("total_kpi2", "total_records")))

    out = rates(s)
    if include_combined:
        add = ["total_records", "total_kpi1", "total_kpi2", "total_calls", "total_emails", "total_sms"]
        comb = s.groupBy("month").agg(*[F.sum(a).cast("bigint").alias(a) for a in add]) \
            .withColumn("brand", F.lit(COMBINED))
        out = out.unionByName(rates(comb))
    return out


# ---------------------------------------------------------------------------
# F17–F24 latest-month views
# ---------------------------------------------------------------------------

def vertical_split(summary: DataFrame) -> DataFrame:
    """Per entity and month, casino vs sports GGR and NGR."""
    return summary.select("brand", "month", "ggr_casino", "ggr_sports", "ngr_casino", "ngr_sports")


def gross_to_net_bridge(summary: DataFrame) -> DataFrame:
    """For each entity's latest active month, rows GGR, −bonus, −tax, NGR."""
    latest = latest_active(summary)
    return latest.select("brand", "month", F.expr(
        "stack(4, 'GGR', cast(ggr as double), 'Bonus', -cast(bonus_total as double), "
        "'Tax', -cast(tax_total as double), 'NGR', cast(ngr as double)) as (step, amount)"))


def latest_active(summary: DataFrame, entity: str = "brand") -> DataFrame:
    """H4: each entity's latest month with players > 0 (padded zero rows skipped)."""
    active = summary.where(F.col("total_players") > 0)
    last = active.groupBy(entity).agg(F.max("month").alias("month"))
    return summary.join(last, [entity, "month"])


# The executive matrix, metric → summary column.
EXEC_METRICS = {"turnover": "total_handle", "ggr": "ggr", "margin_pct": "hold_pct", "revenue_15": "revenue_share_deduction",
                "conversions": "conversions", "turnover_per_player": "turnover_per_player",
                "whale_risk_pct": "top_10_pct_ggr_share"}


def executive_matrix(summary: DataFrame) -> DataFrame:
    """per entity's latest active month, seven metric rows with MoM % and YoY %.

    The changes come from the time series; the ratio metrics, which it does not
    carry, have none."""
    changes = {"turnover": "turnover", "ggr": "ggr", "revenue_15": "revenue_share_deduction", "conversions": "conversions"}
    ts = time_series(summary, "brand").select(
        "brand", "month", *[f"{c}_{k}_pct" for c in changes.values() for k in ("mom", "yoy")])
    k = latest_active(summary).join(ts, ["brand", "month"], "left")
    rows = []
    for metric, col in EXEC_METRICS.items():
        pct = [f"cast({changes[metric]}_{x}_pct as double)" if metric in changes else "cast(null as double)" for x in ("mom", "yoy")]
        rows.append(f"'{metric}', cast({col} as double), {', '.join(pct)}")
    return k.select("brand", "month", F.expr(f"stack({len(rows)}, {', '.join(rows)}) as (metric, value, mom_pct, yoy_pct)"))


def comparative_table(summary: DataFrame) -> DataFrame:
    """each entity's latest active month as metric rows — value, MoM Δ/%,
    YoY Δ/%, YTD and QoQ Δ/% for three money and seven player metrics — plus the
    EOY projection rows (momentum and seasonal engines × ggr, turnover and the
    15 % revenue share)."""
    ts = time_series(summary, "brand")
    q = quarterly(summary, "brand")
    latest = latest_active(summary.withColumn("turnover", F.col("total_handle"))).select("brand", "month")
    k = ts.join(latest, ["brand", "month"]).withColumn("quarter", quarter_label("month"))
    k = k.join(q.select("brand", "quarter", *[c for c in q.columns if c.endswith("_qoq_delta") or c.endswith("_qoq_pct")]),
               ["brand", "quarter"], "left")
    money = ["turnover", "ggr", "revenue_share_deduction"]
    players = ["total_players", "new_players", "returning_players", "reactivated_players", "conversions",
               "profitable_players", "negative_yield_players"]
    parts = []
    for m in money + players:
        parts.append(f"'{m}', cast({m} as double), cast({m}_mom_delta as double), cast({m}_mom_pct as double), "
                     f"cast({m}_yoy_delta as double), cast({m}_yoy_pct as double), cast({m}_ytd as double), "
                     f"cast({m}_qoq_delta as double), cast({m}_qoq_pct as double)")
    for eng in ("momentum", "seasonal"):
        for m in ("ggr", "turnover", "revenue_share_deduction"):
            parts.append(f"'eoy_{eng}_{m}', cast(eoy_{eng}_{m} as double), null, null, null, null, null, null, null")
    return k.select("brand", "month", F.expr(
        f"stack({len(parts)}, {', '.join(parts)}) as (metric, value, mom_delta, mom_pct, yoy_delta, yoy_pct, ytd, "
        f"qoq_delta, qoq_pct)"))


# The demographics and the cash-flow matrix.
DEMOGRAPHICS = ["total_players", "conversions", "new_players", "reactivated_players", "returning_players",
                "profitable_players", "negative_yield_players"]
CASH_FLOW = ["net_deposits", "deposits", "withdrawals", "bonus_total"]


def demographics_matrix(summary: DataFrame) -> DataFrame:
    """player counts and cash flow at each entity's latest active month."""
    rows = [f"'{m}', cast({m} as double)" for m in DEMOGRAPHICS + CASH_FLOW]
    return latest_active(summary).select("brand", "month", F.expr(f"stack({len(rows)}, {', '.join(rows)}) as (metric, value)"))


def revenue_composition(summary: DataFrame) -> DataFrame:
    """new/returning GGR clipped into profit (≥0) and loss (≤0) series."""
    z = F.lit(0).cast(MONEY)
    return summary.select(
        "brand", "month",
        F.greatest("new_player_ggr", z).alias("new_profit"), F.least("new_player_ggr", z).alias("new_loss"),
        F.greatest("returning_player_ggr", z).alias("returning_profit"),
        F.least("returning_player_ggr", z).alias("returning_loss"))


def fixed(x, digits: int):
    """A number as text with ``digits`` decimals, rounded half-up in the decimal
    domain (engine-independent, unlike float formatting)."""
    d = F.round(dbl(x).cast("decimal(38,10)"), digits).cast(f"decimal(38,{digits})")
    return d.cast("string")


def grouped_int(x):
    """A number rounded half-up to an integer, with thousands separators."""
    return F.format_number(F.round(dbl(x).cast("decimal(38,10)"), 0).cast("bigint"), 0)


# The narrative sentence templates (pieces around the numbers).
NARRATIVE = {
    "grew": ("GGR grew +", "% month-over-month ($", "), signalling positive revenue momentum."),
    "declined": ("GGR declined ", "% month-over-month ($", "), indicating revenue contraction."),
    "margin_ok": ("Operating margin is healthy at ", "%, well above the 2.5% alert threshold."),
    "margin_mid": ("Operating margin at ", "% is adequate but approaching the 2.5% caution zone."),
    "margin_low": ("⚠️ MARGIN ALERT: Operating margin has dropped to ", "%, below the 2.5% threshold."),
    "whale_high": ("🚨 HIGH WHALE RISK: Top 10% of players account for ", "% of GGR — extreme concentration."),
    "whale_mid": ("Whale dependency is elevated at ", "% — revenue is moderately concentrated in top players."),
    "whale_low": ("Revenue is well-diversified with top 10% accounting for ", "% of GGR."),
}


def diagnostic_narrative(summary: DataFrame) -> DataFrame:
    """three sentences chosen by thresholds (MoM sign; margin ≥ 5, ≥ 2.5;
    whale share ≥ 70, ≥ 50), one row per entity at its latest active month."""
    ts = time_series(summary, "brand").select("brand", "month", "ggr_mom_pct", "ggr_mom_delta")
    latest = latest_active(summary).select(
        "brand", "month", safe_pct("ggr", "total_handle").alias("margin"), "top_10_pct_ggr_share")
    x = latest.join(ts, ["brand", "month"], "left")
    mom = F.coalesce("ggr_mom_pct", F.lit(0.0))
    delta = F.coalesce(dbl("ggr_mom_delta"), F.lit(0.0))
    t = NARRATIVE
    delta_rounded = F.round(delta.cast("decimal(38,10)"), 0)
    signed = F.concat(F.when(delta_rounded >= 0, F.lit("+")).otherwise(F.lit("")), grouped_int(delta))
    s1 = F.when(mom >= 0, F.concat(F.lit(t["grew"][0]), fixed(mom, 1), F.lit(t["grew"][1]), signed, F.lit(t["grew"][2]))) \
        .otherwise(F.concat(F.lit(t["declined"][0]), fixed(mom, 1), F.lit(t["declined"][1]), grouped_int(delta),
                            F.lit(t["declined"][2])))
    m = F.col("margin")

    def sentence(key, value, digits):
        return F.concat(F.lit(t[key][0]), fixed(value, digits), F.lit(t[key][1]))

    s2 = F.when(m >= 5.0, sentence("margin_ok", m, 2)).when(m >= 2.5, sentence("margin_mid", m, 2)) \
        .otherwise(sentence("margin_low", m, 2))
    wd = F.col("top_10_pct_ggr_share")
    s3 = F.when(wd >= 70, sentence("whale_high", wd, 1)).when(wd >= 50, sentence("whale_mid", wd, 1)) \
        .otherwise(sentence("whale_low", wd, 1))
    return x.select("brand", "month", F.concat_ws("\n\n", s1, s2, s3).alias("narrative"))


def ingest_diagnostics(pa: DataFrame) -> DataFrame:
    """rows per brand and rows per month, as one long table."""
    by_brand = pa.groupBy(F.col("brand").alias("key")).agg(F.count(F.lit(1)).alias("rows")) \
        .withColumn("level", F.lit("brand"))
    by_month = pa.groupBy(F.col("report_month").alias("key")).agg(F.count(F.lit(1)).alias("rows")) \
        .withColumn("level", F.lit("month"))
    return by_brand.unionByName(by_month).select("level", "key", "rows")


KPI_CARDS = ["ggr", "total_handle", "total_players"]
KPI_RATIOS = ["hold_pct", "retention_pct", "profitable_pct", "turnover_per_player"]


def kpi_deltas(summary: DataFrame) -> DataFrame:
    """KPI cards of each entity's latest month: three totals with the change from
    the row before, and four ratios.  Brands show their last row; Combined
    skips padded months at the end."""
    prev = Window.partitionBy("brand").orderBy("month")
    x = summary.select("brand", "month", *KPI_CARDS, *KPI_RATIOS,
                       *[(F.col(m) - F.lag(m).over(prev)).alias(f"{m}_delta") for m in KPI_CARDS])
    shown = (F.col("brand") != COMBINED) | (F.col("total_players") > 0)
    last = summary.where(shown).groupBy("brand").agg(F.max("month").alias("month"))
    return x.join(last, ["brand", "month"])
