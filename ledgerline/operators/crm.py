"""Player-level CRM operators.

Player grain work is one ``groupBy(id[, brand])`` (partial aggregation first,
so a hot brand never lands in one task); global scalars such as the latest
report month are scalar subqueries, not single-partition windows; global
orders (Pareto) use the range-partitioned ranking of ``ranking.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.core import MONEY, dbl, distinct_count, money_sum, month_index, safe_div, safe_pct
from .. import session
from .ranking import rank_in_groups

# Profile labels (output values of the recommendation rules).
IRONMAN = "🏆 Ironman Legend"
PROMO_EXCLUSION = "🛑 Promo Exclusion"
EARLY_CHURN = "🚨 Early Churn VIP"
RISING_STAR = "🌟 Rising Star"
COLD_CROWN = "🎯 Cold Crown Jewel"
ACTIVE_CROWN = "👑 Active Crown Jewel"
COOLING = "📉 Cooling Down"
STANDARD = "✉️ Standard Lifecycle"
COOLING_B = "📉 Cooling Down (Velocity Risk)"
PROMO_EXCLUSION_B = "🛑 Promo Exclusion (Risk)"
PROFILE_ORDER_B = [IRONMAN, ACTIVE_CROWN, COOLING_B, PROMO_EXCLUSION_B, EARLY_CHURN, RISING_STAR,
                   COLD_CROWN, STANDARD]

# K13 velocity bins (right-closed) and labels.
VELOCITY_BINS = [
    (-1, 1, "1. Immediate (0-1 Days)"),
    (1, 7, "2. Fast (2-7 Days)"),
    (7, 14, "3. Warm (8-14 Days)"),
    (14, 30, "4. Slow (15-30 Days)"),
    (30, None, "5. Delayed (31+ Days)"),
]

# K11 Pareto tier labels.
PARETO_TIERS = ["Top 1% (Super Whales)", "Next 4% (Core VIPs)", "Next 15% (Mid-Tier)",
                "Bottom 80% (Casuals)"]


def scalar(df_one_value: DataFrame):
    """A one-row, one-column aggregate as a Column (scalar subquery)."""
    return df_one_value.scalar()


def _first_by_month(c: str):
    """pandas ``first`` in month order: the value of the earliest row holding one."""
    key = F.concat(F.coalesce(F.col("report_month"), F.lit("")), F.lit("|"), F.coalesce(F.col(c), F.lit("")))
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), key))


def _last_bet(tiebreak: str | None):
    key = F.col("report_month") if tiebreak is None else F.concat(
        F.coalesce(F.col("report_month"), F.lit("")), F.lit("|"), F.coalesce(F.col(tiebreak), F.lit("")))
    return F.max_by(F.col("bet"), F.when(F.col("bet").isNotNull(), key))


def months_distinct():
    """Distinct report months of a player: a set bounded by the calendar, so it
    is collected per player (one exchange) instead of a two-exchange distinct."""
    return F.size(F.collect_set("report_month")).cast("bigint")


def _lifetime_aggs():
    return [
        money_sum("revenue").alias("lifetime_ggr"),
        money_sum("ngr").alias("lifetime_ngr"),
        money_sum("bet").alias("lifetime_turnover"),
        money_sum("deposits").alias("lifetime_deposits"),
        F.coalesce(F.sum("deposit_count"), F.lit(0)).cast("bigint").alias("lifetime_deposit_count"),
        money_sum("withdrawals").alias("lifetime_withdrawals"),
        money_sum("bonus_total").alias("lifetime_bonus"),
        F.min("report_month").alias("first_month"),
        F.max("report_month").alias("last_month"),
        months_distinct().alias("months_active"),
    ]


def _recency(df: DataFrame, pa: DataFrame) -> DataFrame:
    gmax = scalar(pa.select(F.max(month_index("report_month"))))
    return (df
            .withColumn("months_inactive", (gmax - month_index("last_month")).cast("int"))
            .withColumn("tenure_months", (month_index("last_month") - month_index("first_month") + 1).cast("int"))
            .withColumn("avg_deposit_value", safe_div("lifetime_deposits", "lifetime_deposit_count")))


def player_master_list(pa: DataFrame) -> DataFrame:
    """K1 (+K2): lifetime view per (id, brand) with the recommended campaign (order A)."""
    g = (pa.where(F.col("id").isNotNull() & F.col("brand").isNotNull())
         .groupBy("id", "brand")
         .agg(_first_by_month("client").alias("client"), *_lifetime_aggs(),
              _last_bet(None).alias("last_month_turnover")))
    g = _recency(g, pa)
    g = (g.withColumn("last_month_turnover", F.coalesce("last_month_turnover", F.lit(0).cast(MONEY)))
         .withColumn("avg_monthly_turnover",
                     dbl("lifetime_turnover") / F.greatest(F.col("months_active"), F.lit(1))))
    return g.withColumn("recommended_campaign", recommended_campaign_a())


def recommended_campaign_a():
    """K2: rule order A (the master-list variant)."""
    c = F.col
    return (F.when((c("months_active") >= 6) & (c("months_inactive") == 0) & (c("months_active") == c("tenure_months")), IRONMAN)
            .when((c("lifetime_ggr") < 0) & (c("lifetime_turnover") > 5000), PROMO_EXCLUSION)
            .when((c("months_inactive") == 1) & (c("lifetime_ggr") > 500), EARLY_CHURN)
            .when((c("months_active") <= 2) & (c("lifetime_turnover") > 1000) & (c("months_inactive") == 0), RISING_STAR)
            .when((c("months_inactive") >= 3) & (c("lifetime_ggr") > 1000), COLD_CROWN)
            .when((c("lifetime_ggr") >= 1000) & (c("months_inactive") == 0), ACTIVE_CROWN)
            .when((c("months_inactive") == 0) & (dbl("last_month_turnover") < c("avg_monthly_turnover") * 0.5)
                  & (c("lifetime_turnover") >= 1000), COOLING)
            .otherwise(STANDARD))


def rfm_summary(pa: DataFrame, vip_threshold: float = 500) -> DataFrame:
    """K3: per player across brands; brand/country/client = first in month order."""
    g = (pa.where(F.col("id").isNotNull()).groupBy("id")
         .agg(*_lifetime_aggs(),
              _first_by_month("brand").alias("brand"),
              _first_by_month("country").alias("country"),
              _first_by_month("client").alias("client"),
              _last_bet("brand").alias("last_month_turnover")))
    g = _recency(g, pa)
    return (g.withColumn("last_month_turnover", F.coalesce("last_month_turnover", F.lit(0).cast(MONEY)))
            .withColumn("avg_monthly_turnover", safe_div("lifetime_turnover", "months_active"))
            .withColumn("is_vip", F.col("lifetime_ggr") >= F.lit(vip_threshold)))


def smart_profile():
    """K4: rule order B (the specification's order, used by the CRM view)."""
    c = F.col
    return (F.when((c("months_active") >= 6) & (c("months_inactive") == 0) & (c("months_active") == c("tenure_months")), IRONMAN)
            .when((c("lifetime_ggr") >= 1000) & (c("months_inactive") == 0), ACTIVE_CROWN)
            .when((c("months_inactive") == 0) & (dbl("last_month_turnover") < c("avg_monthly_turnover") * 0.5)
                  & (c("lifetime_turnover") >= 1000), COOLING_B)
            .when((c("lifetime_ggr") < 0) & (c("lifetime_turnover") > 5000), PROMO_EXCLUSION_B)
            .when((c("months_inactive") == 1) & (c("lifetime_ggr") > 500), EARLY_CHURN)
            .when((c("months_active") <= 2) & (c("lifetime_turnover") > 1000) & (c("months_inactive") == 0), RISING_STAR)
            .when((c("months_inactive") >= 3) & (c("lifetime_ggr") > 1000), COLD_CROWN)
            .otherwise(STANDARD))


def smart_profiles(pa: DataFrame) -> DataFrame:
    return rfm_summary(pa).withColumn("smart_profile", smart_profile())


def tier_summary(pa: DataFrame, target_month: str | None = None) -> DataFrame:
    """K5: True VIP / Churn Risk / Casual by frequency, monetary and recency."""
    target = F.lit(target_month) if target_month else scalar(pa.select(F.max("report_month")))
    player = (pa.where(F.col("id").isNotNull()).groupBy("id")
              .agg(months_distinct().alias("frequency"),
                   money_sum("revenue").alias("monetary"),
                   F.max(F.when(F.col("report_month") == target, 1).otherwise(0)).alias("recent")))
    return _tiers(player, [])


def _tiers(player: DataFrame, keys: list[str]) -> DataFrame:
    core = (F.col("frequency") >= 3) & (F.col("monetary") > 0)
    tier = (F.when(core & (F.col("recent") == 1), "True VIP")
            .when(core & (F.col("recent") == 0), "Churn Risk").otherwise("Casual"))
    return (player.withColumn("tier", tier).groupBy(*keys, "tier")
            .agg(F.count(F.lit(1)).alias("players"), F.sum("monetary").cast(MONEY).alias("ggr")))


def tier_summary_by_brand(pa: DataFrame) -> DataFrame:
    """K5 per brand, each with its own latest month as the recency target."""
    latest = pa.groupBy("brand").agg(F.max("report_month").alias("_target"))
    # players first, so that the join on the brand alone moves (or, when broadcast, meets) player rows
    player = (pa.where(F.col("id").isNotNull() & F.col("brand").isNotNull()).groupBy("brand", "id")
              .agg(months_distinct().alias("frequency"), money_sum("revenue").alias("monetary"), F.max("report_month").alias("_last")))
    player = player.join(latest, "brand").withColumn("recent", F.coalesce((F.col("_last") == F.col("_target")).cast("int"), F.lit(0)))
    return _tiers(player, ["brand"])


def overlap_stats(pa: DataFrame, brand_1: str, brand_2: str) -> DataFrame:
    """K6: players active on both brands; their count and all-brand revenue."""
    both = (pa.where(F.col("brand").isin(brand_1, brand_2)).groupBy("id")
            .agg(F.size(F.collect_set("brand")).alias("_nb")).where(F.col("_nb") > 1).select("id"))
    shared = pa.join(both, "id", "left_semi")
    totals = shared.agg(money_sum("revenue").alias("overlap_ggr"))
    return totals.select(F.lit(brand_1).alias("brand_1"), F.lit(brand_2).alias("brand_2"),
                         scalar(both.select(F.count(F.lit(1)))).alias("overlap_count"), "overlap_ggr")


def multi_brand_overlap(pa: DataFrame) -> DataFrame:
    """K6 generalised without pairing: per brand, its players also active on any
    other brand, and the all-brand revenue of those players."""
    nb = pa.groupBy("id").agg(F.size(F.collect_set("brand")).alias("_nb"))  # brands per player: registry-bounded
    x = pa.join(nb.where(F.col("_nb") > 1), "id", "left_semi")
    per_player = x.groupBy("id").agg(money_sum("revenue").alias("_rev"))
    by_brand = x.select("brand", "id").distinct().join(per_player, "id")
    return by_brand.groupBy("brand").agg(F.count(F.lit(1)).alias("shared_players"),
                                         F.sum("_rev").cast(MONEY).alias("shared_players_ggr"))


def _cohort_rows(pa: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct (keys, id, month) with the player's first month in ``keys``.

    One exchange on (keys, id) serves both the per-player aggregate and the
    first-month window; its parts follow the rows, as in ``cohort_counts``."""
    parts = session.counted_parts(pa, session.COHORT_ROWS_A_TASK)
    base = pa.where(F.col("id").isNotNull() & F.col("report_month").isNotNull())
    rows = base.repartition(parts, *keys, "id").groupBy(*keys, "id", F.col("report_month").alias("month")).agg(
        money_sum("revenue").alias("revenue"))
    w = Window.partitionBy(*keys, "id")
    return rows.withColumn("cohort_month", F.min("month").over(w))


def ltv_curves(pa: DataFrame) -> DataFrame:
    """K7: GGR by (cohort month, calendar month index) and its running sum."""
    r = _cohort_rows(pa, [])
    r = r.withColumn("month_index", month_index("month") - month_index("cohort_month")) \
        .where(F.col("month_index") >= 0)
    g = r.groupBy("cohort_month", "month_index").agg(F.sum("revenue").cast(MONEY).alias("ggr"))
    w = Window.partitionBy("cohort_month").orderBy("month_index").rowsBetween(Window.unboundedPreceding, 0)
    return g.withColumn("cumulative_ggr", F.sum("ggr").over(w).cast(MONEY))


def cohort_retention_matrix(pa: DataFrame) -> DataFrame:
    """K8: per brand and Combined — offset = distance in the sorted list of
    months *with data* (of that brand, or of all data for Combined); long form,
    offsets > 0; retention % of cohort size."""
    def one(df: DataFrame, keys: list[str]) -> DataFrame:
        r = _cohort_rows(df, keys)
        # Months with data, from the scan (partial distinct); bounded by
        # registered brands × calendar months, so broadcast.
        months = (df.where(F.col("id").isNotNull() & F.col("report_month").isNotNull())
                  .select(*keys, F.col("report_month").alias("month")).distinct())
        mw = Window.partitionBy(*keys).orderBy("month") if keys else Window.orderBy("month")
        months = months.withColumn("_mi", F.dense_rank().over(mw))
        r = r.join(F.broadcast(months), [*keys, "month"]).join(
            F.broadcast(months.select(*keys, F.col("month").alias("cohort_month"), F.col("_mi").alias("_ci"))),
            [*keys, "cohort_month"])
        r = r.withColumn("offset", (F.col("_mi") - F.col("_ci")).cast("int"))
        counts = r.groupBy(*keys, "cohort_month", "offset").agg(F.count(F.lit(1)).alias("players"))
        sizes = counts.where(F.col("offset") == 0).select(*keys, "cohort_month", F.col("players").alias("cohort_size"))
        act = counts.where(F.col("offset") > 0).select(*keys, "cohort_month", "offset",
                                                       F.col("players").alias("active_players"))
        out = act.join(sizes, [*keys, "cohort_month"])
        return out.withColumn("retention_pct", dbl("active_players") / dbl("cohort_size") * 100.0)

    per_brand = one(pa.where(F.col("brand").isNotNull()), ["brand"])
    combined = one(pa, []).withColumn("brand", F.lit("Combined"))
    return per_brand.unionByName(combined.select(*per_brand.columns))


def cohort_retention_pivot(long_df: DataFrame, max_offset: int) -> DataFrame:
    """K8 matrix form: one column per offset (``Month 1`` …), explicit values."""
    return (long_df.groupBy("brand", "cohort_month")
            .pivot("offset", list(range(1, max_offset + 1))).agg(F.first("retention_pct"))
            .select("brand", "cohort_month",
                    *[F.col(str(i)).alias(f"Month {i}") for i in range(1, max_offset + 1)]))


def retention_heatmap(pa: DataFrame) -> DataFrame:
    """K9: cohort × calendar month index; distinct players / index-0 players."""
    r = _cohort_rows(pa, [])
    r = r.withColumn("month_index", month_index("month") - month_index("cohort_month"))
    g = r.groupBy("cohort_month", "month_index").agg(F.count(F.lit(1)).alias("players"))
    base = g.where(F.col("month_index") == 0).select("cohort_month", F.col("players").alias("_p0"))
    return g.join(base, "cohort_month", "left").withColumn(
        "retention", dbl("players") / dbl("_p0")).drop("_p0")


def pareto_curve(pa: DataFrame) -> DataFrame:
    """Players with lifetime GGR > 0, descending (ties by id): running GGR,
    its share, rank and the cumulative player share — without a global window."""
    pl = (pa.where(F.col("id").isNotNull()).groupBy("id").agg(money_sum("revenue").alias("lifetime_ggr"))
          .where(F.col("lifetime_ggr") > 0))
    r = rank_in_groups(pl, [], "lifetime_ggr", "id", sum_col="lifetime_ggr")
    return r.select(
        "id", "lifetime_ggr",
        F.col("_cum").cast(MONEY).alias("cumulative_ggr"),
        (dbl("_cum") / dbl("_group_sum") * 100.0).alias("cumulative_ggr_pct"),
        F.col("_rank").cast("bigint").alias("player_rank"),
        (dbl("_rank") / dbl("_group_n") * 100.0).alias("cumulative_players_pct"))


def pareto_tiers(pa: DataFrame) -> DataFrame:
    """NGR > 0 players ranked; cut at t1 = max(1,⌊1 %⌋), t5 = max(t1+1,⌊5 %⌋),
    t20 = max(t5+1,⌊20 %⌋), all clamped to the player count (ruling Q12)."""
    pl = (pa.where(F.col("id").isNotNull()).groupBy("id").agg(money_sum("ngr").alias("ngr"))
          .where(F.col("ngr") > 0))
    r = rank_in_groups(pl, [], "ngr", "id")
    n = F.col("_group_n")
    t1 = F.least(F.greatest(F.lit(1), F.floor(n / 100)), n)
    t5 = F.least(F.greatest(t1 + 1, F.floor(n / 20)), n)
    t20 = F.least(F.greatest(t5 + 1, F.floor(n / 5)), n)
    rank = F.col("_rank")
    tier = (F.when(rank <= t1, 0).when(rank <= t5, 1).when(rank <= t20, 2).otherwise(3))
    g = r.withColumn("_tier", tier).groupBy("_tier").agg(
        F.count(F.lit(1)).alias("player_count"), F.sum("ngr").cast(MONEY).alias("ngr_generated"))
    spark = pa.sparkSession
    tiers = F.broadcast(spark.createDataFrame([(i, t) for i, t in enumerate(PARETO_TIERS)], "_tier int, tier string"))
    total = scalar(pl.select(F.sum("ngr")))
    out = tiers.join(g, "_tier", "left")
    return out.select(
        "tier",
        F.coalesce("player_count", F.lit(0)).cast("bigint").alias("player_count"),
        F.coalesce("ngr_generated", F.lit(0).cast(MONEY)).alias("ngr_generated"),
        safe_pct(F.coalesce("ngr_generated", F.lit(0).cast(MONEY)), total).alias("revenue_share"))


def product_affinity(pa: DataFrame) -> DataFrame:
    """Omnichannel / Casino Only / Sportsbook Only / Inactive."""
    pl = pa.where(F.col("id").isNotNull()).groupBy("id").agg(
        money_sum("bet_casino").alias("bc"), money_sum("bet_sports").alias("bs"), money_sum("ngr").alias("ngr"))
    aff = (F.when((F.col("bc") > 0) & (F.col("bs") > 0), "Omnichannel")
           .when((F.col("bc") > 0) & (F.col("bs") <= 0), "Casino Only")
           .when((F.col("bc") <= 0) & (F.col("bs") > 0), "Sportsbook Only").otherwise("Inactive"))
    g = pl.withColumn("affinity", aff).groupBy("affinity").agg(
        F.count(F.lit(1)).alias("players"), F.sum("ngr").cast(MONEY).alias("total_ngr"))
    return g.withColumn("avg_ngr_per_player", safe_div("total_ngr", "players"))


def reactivation_velocity(lines: DataFrame, approx: bool = False) -> DataFrame:
    """Right-closed delay bins; out-of-range rows dropped; empty bins kept."""
    d = F.col("reactivation_days")
    label = None
    for lo, hi, name in VELOCITY_BINS:
        cond = (d > lo) if hi is None else ((d > lo) & (d <= hi))
        label = F.when(cond, name) if label is None else label.when(cond, name)
    x = lines.where(d.isNotNull()).withColumn("velocity", label).where(F.col("velocity").isNotNull())
    g = x.groupBy("velocity").agg(distinct_count("id", approx).alias("reactivated_players"),
                                  money_sum("deposits").alias("total_deposits"),
                                  money_sum("ngr").alias("total_ngr"))
    spark = lines.sparkSession
    bins = F.broadcast(spark.createDataFrame([(b[2],) for b in VELOCITY_BINS], "velocity string"))
    out = bins.join(g, "velocity", "left")
    return out.select("velocity",
                      F.coalesce("reactivated_players", F.lit(0)).cast("bigint").alias("reactivated_players"),
                      F.coalesce("total_deposits", F.lit(0).cast(MONEY)).alias("total_deposits"),
                      F.coalesce("total_ngr", F.lit(0).cast(MONEY)).alias("total_ngr"))


def vip_churn_radar(pa: DataFrame, top: int = 50) -> DataFrame:
    """Last two months of the slice; VIPs of the previous month whose NGR
    fell ≥ 30 % and ≥ 200; the 50 largest drops (a top-k report)."""
    latest = scalar(pa.select(F.max("report_month")))
    prev = scalar(pa.where(F.col("report_month") < latest).select(F.max("report_month")))
    x = pa.where(F.col("report_month").isin(latest, prev))
    z = F.lit(0).cast(MONEY)
    pv = x.groupBy("id", "brand").agg(
        F.sum(F.when(F.col("report_month") == prev, F.col("ngr")).otherwise(z)).cast(MONEY).alias("prev_month_ngr"),
        F.sum(F.when(F.col("report_month") == latest, F.col("ngr")).otherwise(z)).cast(MONEY).alias("curr_month_ngr"),
        F.sum(F.when(F.col("report_month") == prev, F.col("bet")).otherwise(z)).cast(MONEY).alias("prev_month_turnover"),
        F.sum(F.when(F.col("report_month") == latest, F.col("bet")).otherwise(z)).cast(MONEY).alias("curr_month_turnover"))
    vips = pv.where((F.col("prev_month_ngr") >= 500) | (F.col("prev_month_turnover") >= 5000))
    vips = vips.withColumn("ngr_drop_value", (F.col("prev_month_ngr") - F.col("curr_month_ngr")).cast(MONEY))
    vips = vips.withColumn("ngr_drop_pct", F.when(F.col("prev_month_ngr") > 0,
                                                  dbl("ngr_drop_value") / dbl("prev_month_ngr") * 100.0).otherwise(0.0))
    hits = vips.where((F.col("ngr_drop_pct") >= 30) & (F.col("ngr_drop_value") >= 200))
    return hits.orderBy(F.col("ngr_drop_value").desc(), F.col("id"), F.col("brand")).limit(top)


# ---------------------------------------------------------------------------
# K15–K20 leaderboards over the smart profiles
# ---------------------------------------------------------------------------

_LB_COLS = ["id", "brand", "lifetime_ggr", "lifetime_ngr", "lifetime_turnover", "lifetime_bonus",
            "lifetime_withdrawals", "lifetime_deposit_count", "avg_deposit_value", "first_month",
            "last_month", "months_active", "months_inactive", "smart_profile"]


def crown_jewels(profiles: DataFrame, top: int = 50) -> DataFrame:
    """Top lifetime GGR."""
    return profiles.select(*_LB_COLS).orderBy(F.col("lifetime_ggr").desc(), "id").limit(top)


def bonus_abusers(profiles: DataFrame, top: int = 50) -> DataFrame:
    """Negative lifetime GGR, top turnover."""
    return (profiles.where(F.col("lifetime_ggr") < 0).select(*_LB_COLS)
            .orderBy(F.col("lifetime_turnover").desc(), "id").limit(top))


def promo_exploitation(profiles: DataFrame, top: int = 50) -> DataFrame:
    """NGR < 0, bonus > 50, withdrawals > 0; the lowest NGR first."""
    return (profiles.where((F.col("lifetime_ngr") < 0) & (F.col("lifetime_bonus") > 50)
                           & (F.col("lifetime_withdrawals") > 0))
            .select(*_LB_COLS).orderBy(F.col("lifetime_ngr").asc(), "id").limit(top))


def payment_friction(profiles: DataFrame, top: int = 50, min_deposits: int = 10,
                     max_avg: float = 25.0) -> DataFrame:
    """Many small deposits (≥ 10, 0 < average ≤ 25)."""
    return (profiles.where((F.col("lifetime_deposit_count") >= min_deposits)
                           & (F.col("avg_deposit_value") <= max_avg) & (F.col("avg_deposit_value") > 0))
            .select(*_LB_COLS).orderBy(F.col("lifetime_deposit_count").desc(), "id").limit(top))


def churn_targets(profiles: DataFrame, min_inactive: int = 3, min_ggr: float = 500.0) -> DataFrame:
    """Inactive ≥ x months and lifetime GGR ≥ y, by GGR desc (no cap)."""
    return (profiles.where((F.col("months_inactive") >= min_inactive) & (F.col("lifetime_ggr") >= min_ggr))
            .select("id", "brand", "last_month", "months_inactive", "lifetime_ggr", "lifetime_turnover",
                    "smart_profile"))


def profile_counts(profiles: DataFrame) -> DataFrame:
    """Players per profile in the fixed order, missing profiles as 0."""
    spark = profiles.sparkSession
    order = F.broadcast(spark.createDataFrame([(i, p) for i, p in enumerate(PROFILE_ORDER_B)],
                                              "position int, smart_profile string"))
    g = profiles.groupBy("smart_profile").agg(F.count(F.lit(1)).alias("players"))
    return order.join(g, "smart_profile", "left").select(
        "position", "smart_profile", F.coalesce("players", F.lit(0)).cast("bigint").alias("players"))


def profile_extract(profiles: DataFrame, profile: str) -> DataFrame:
    """The list for one profile."""
    return profiles.where(F.col("smart_profile") == profile).select(
        "id", "brand", "first_month", "last_month", "months_active", "months_inactive", "lifetime_ggr",
        "lifetime_turnover", "smart_profile")


