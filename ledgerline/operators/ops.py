"""Operations / campaign operators (O1–O26, C7–C12 views).

Input ``ops``: the operations fact (one row per campaign × day, see
``sources/testdata.ops_daily``).  ``as_of`` is always a parameter (default: the
latest ``ops_date``, as a scalar subquery), never the wall clock.

Scale notes: every report is a ``groupBy`` with partial aggregation; windows
over dates are expressed as conditional sums on ``datediff(as_of, ops_date)``
(no date spine, no cross join); dimension tables (SLA minimums, registry,
targets, literal label tables) are bounded and broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import campaign as C
from ..functions.core import (MONEY, dbl, half_label, last_thursday,
                              week_start_friday)

PULSE_WINDOWS = [7, 14, 30, 90]


def scalar(df: DataFrame) -> Column:
    return df.scalar()


def max_date(ops: DataFrame) -> Column:
    return scalar(ops.select(F.max("ops_date")))


def _as_of(ops: DataFrame, as_of: str | None) -> Column:
    return F.to_date(F.lit(as_of)) if as_of else max_date(ops)


# ---------------------------------------------------------------------------
# O1 / O2 materialized bases, C7–C12 name views
# ---------------------------------------------------------------------------

def ops_base(ops: DataFrame) -> DataFrame:
    """O1: signatures (C8–C11) added in one projection."""
    core = C.core_signature("campaign_name")
    return ops.select(
        "*",
        core.alias("core_signature"),
        C.campaign_signature("campaign_name").alias("campaign_signature"),
        C.strategy_signature("ops_brand", "country", "extracted_lifecycle", "extracted_engagement")
         .alias("strategy_signature"),
        C.display_lifecycle(core).alias("ops_lifecycle"),
    )


def snapshots_base(snaps: DataFrame) -> DataFrame:
    """O2."""
    return snaps.withColumn("strategy_signature", C.strategy_signature(
        "ops_brand", "country", "extracted_lifecycle", "extracted_engagement"))


def raw_campaign(ops: DataFrame) -> Column:
    """The delivered campaign name (the fact key minus its ``_yyyy-MM-dd`` day)."""
    return F.regexp_replace(F.col("campaign_name"), r"_\d{4}-\d{2}-\d{2}$", "")


def campaign_parts(ops: DataFrame) -> DataFrame:
    """C1–C7 view: every parsed component of each delivered name."""
    t = C.tokens(raw_campaign(ops))
    return ops.select(
        "campaign_name", "ops_date", C.brand_tag(t).alias("tag"), "extracted_lifecycle", "extracted_segment",
        "extracted_engagement", "extracted_product", "extracted_sublifecycle", "country",
        "extracted_language", "campaign_data_age_days",
        F.coalesce(C.data_age_days(t, "ops_date"), F.lit(-1)).alias("data_age_sink"),
        C.data_age_from_range_suffix("campaign_name", "ops_date").alias("data_age_range_suffix"),
        C.engagement_label("extracted_engagement").alias("engagement_label"),
        C.product_label("extracted_product").alias("product_label"))


# The short-name aggregator's word lists.
SHORT_BASE_BLACKLIST = ["DAY", "A", "B", "J1", "J2", "J3", "NLI", "LI", "2024DATA", "2025DATA", "SP", "NEW"]
SHORT_MONTHS_PATTERN = "(JAN|FEB|MAR|APR|MAY|JUN|JUL|AUG|SEP|OCT|NOV|DEC)"
SHORT_EXCEPTION = "YU-JP-CAS-RND"
_NUMERIC = r"^\s*([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|0[xX][0-9a-fA-F]+|0[bB][01]+|0[oO][0-7]+)?\s*$"


def short_name_totals(ops: DataFrame) -> DataFrame:
    """NLI names (or the listed exception) → ``brand-rest-LIFECYCLE`` with
    vocabulary, dates, month names and numbers removed; ``New Data`` summed."""
    name = raw_campaign(ops)
    parts = F.transform(F.split(name, "-"), lambda p: F.when(F.upper(p) == "WBD", F.lit("WB")).otherwise(p))
    vocab = F.array(*[F.lit(v) for v in C.LIFECYCLES])
    black = F.array(*[F.lit(v) for v in C.PRODUCTS + C.SEGMENTS + SHORT_BASE_BLACKLIST])
    x = ops.select(name.alias("_name"), parts.alias("_parts"), "records")
    x = x.where(F.col("_name").contains("NLI") | F.upper("_name").contains(SHORT_EXCEPTION))
    x = x.where(F.size("_parts") >= 2)
    x = x.withColumn("_lc", F.upper(F.get(F.filter("_parts", lambda p: F.array_contains(vocab, F.upper(p))), 0)))
    x = x.where(F.col("_lc").isNotNull())
    rest = F.transform(
        F.filter("_parts", lambda p, i: (i >= 1) & (F.upper(p) != F.col("_lc"))
                 & ~F.array_contains(black, F.upper(p)) & ~F.upper(p).rlike(_NUMERIC)
                 & ~F.upper(p).rlike(SHORT_MONTHS_PATTERN)),
        lambda p: F.upper(p))
    short = F.when(F.size(rest) > 0, F.concat_ws("-", F.get("_parts", 0), F.array_join(rest, "-"), F.col("_lc"))) \
        .otherwise(F.concat_ws("-", F.get("_parts", 0), F.col("_lc")))
    return x.withColumn("short_name", short).groupBy("short_name").agg(
        F.sum("records").cast("bigint").alias("total"))


# ---------------------------------------------------------------------------
# O3 / O4 pulse
# ---------------------------------------------------------------------------

def daily_pulse(ops: DataFrame) -> DataFrame:
    """O3: (ops_date, engagement) → records, conversions, logins."""
    return (ops.where(F.col("ops_date").isNotNull() & F.col("extracted_engagement").isNotNull())
            .groupBy("ops_date", "extracted_engagement")
            .agg(F.sum("records").cast("bigint").alias("total_records"),
                 F.sum("conversions").cast("bigint").alias("total_conversions"),
                 F.sum("kpi2_logins").cast("bigint").alias("total_logins")))


def capped_pct(num, den) -> Column:
    """Daily percentage capped at 100; x/0 and 0/0 → 0."""
    return F.when(dbl(den) != 0, F.least(dbl(num) / dbl(den) * 100.0, F.lit(100.0))).otherwise(F.lit(0.0))


def pulse_windows(pulse: DataFrame, windows: list[int] = PULSE_WINDOWS) -> DataFrame:
    """Per engagement (LI/NLI) and window w: the window ``(max−w, max]`` vs
    the prior ``(max−2w, max−w]``; volume = sum, login/conv % = mean of the
    daily capped percentages; delta = current − prior."""
    p = (pulse.withColumn("engagement", F.upper("extracted_engagement"))
         .where(F.col("engagement").isin("LI", "NLI"))
         .withColumn("conv_pct", capped_pct("total_conversions", "total_records"))
         .withColumn("login_pct", capped_pct("total_logins", "total_records")))
    mx = p.groupBy("engagement").agg(F.max("ops_date").alias("_max"))
    p = p.join(mx, "engagement")
    p = p.withColumn("window_days", F.explode(F.array(*[F.lit(w) for w in windows])))
    age = F.datediff("_max", "ops_date")
    cur = (age >= 0) & (age < F.col("window_days"))
    pri = (age >= F.col("window_days")) & (age < 2 * F.col("window_days"))

    def mean_if(cond, c):
        return F.round(F.coalesce(F.avg(F.when(cond, F.col(c))), F.lit(0.0)), 6)

    g = p.groupBy("engagement", "window_days").agg(
        F.coalesce(F.sum(F.when(cur, F.col("total_records"))), F.lit(0)).cast("bigint").alias("volume_current"),
        F.coalesce(F.sum(F.when(pri, F.col("total_records"))), F.lit(0)).cast("bigint").alias("volume_prior"),
        mean_if(cur, "login_pct").alias("login_pct_current"), mean_if(pri, "login_pct").alias("login_pct_prior"),
        mean_if(cur, "conv_pct").alias("conv_pct_current"), mean_if(pri, "conv_pct").alias("conv_pct_prior"))
    return (g.withColumn("volume_delta", F.col("volume_current") - F.col("volume_prior"))
            .withColumn("login_pct_delta", F.round(F.col("login_pct_current") - F.col("login_pct_prior"), 6))
            .withColumn("conv_pct_delta", F.round(F.col("conv_pct_current") - F.col("conv_pct_prior"), 6)))


# ---------------------------------------------------------------------------
# O5 benchmarks, O6 half-over-half
# ---------------------------------------------------------------------------

BENCH_KEYS = ["brand", "country", "extracted_lifecycle", "extracted_segment", "extracted_engagement"]


def historical_benchmarks(ops: DataFrame) -> DataFrame:
    """O5 for every half-year period at once: daily sums per signature, then the
    mean over the active days of that signature."""
    x = ops.select(
        half_label("ops_date").alias("benchmark_period"), "ops_date",
        *[F.coalesce(F.col("ops_brand" if k == "brand" else k), F.lit("UNKNOWN")).alias(k) for k in BENCH_KEYS],
        "records", "calls", "kpi2_logins", "conversions",
        (F.col("d_plus") + F.col("d_neutral") + F.col("d_minus")).alias("deliveries"),
        (F.col("cost_sip") + F.col("cost_sms") + F.col("cost_email")).cast(MONEY).alias("telecom_cost"))
    x = x.where(F.col("ops_date").isNotNull())
    daily = x.groupBy("benchmark_period", "ops_date", *BENCH_KEYS).agg(
        *[F.sum(c).alias(c) for c in ["records", "calls", "kpi2_logins", "conversions", "deliveries"]],
        F.sum("telecom_cost").cast(MONEY).alias("telecom_cost"))
    names = {"records": "avg_daily_records", "calls": "avg_daily_calls", "kpi2_logins": "avg_daily_logins",
             "conversions": "avg_daily_conversions", "deliveries": "avg_daily_deliveries",
             "telecom_cost": "avg_daily_telecom_cost"}
    b = daily.groupBy("benchmark_period", *BENCH_KEYS).agg(
        *[(dbl(F.sum(c)) / F.count(F.lit(1))).alias(n) for c, n in names.items()])
    return b.withColumn("avg_daily_true_cac", F.when(F.col("avg_daily_conversions") > 0,
                                                     F.col("avg_daily_telecom_cost") / F.col("avg_daily_conversions"))
                        .otherwise(F.lit(0.0)))


HOH_SUMS = ["records", "kpi2_logins", "conversions", "d_plus", "d_minus", "d_neutral", "na", "t", "dnc", "dx",
            "wn", "am", "es", "ed", "eo", "ec", "ef", "sd", "sf", "sp"]


def half_over_half(ops: DataFrame, current_half: str | None = None, prior_half: str | None = None) -> DataFrame:
    """Current half vs a prior half; prior sums scaled by the day ratio and
    truncated; rates as % (dispositions of records, email of ``es``, SMS of
    sd+sf+sp); change in % (volumes) or percentage points (rates)."""
    lab = half_label("ops_date")
    cur_lab = F.lit(current_half) if current_half else scalar(ops.select(F.max_by(lab, "ops_date")))
    if prior_half:
        pri_lab = F.lit(prior_half)
    else:  # the half before the current one
        yr = F.substring(cur_lab, 4, 4).cast("int")
        pri_lab = F.when(F.substring(cur_lab, 1, 2) == "H2", F.concat(F.lit("H1 "), yr.cast("string"))) \
            .otherwise(F.concat(F.lit("H2 "), (yr - 1).cast("string")))
    x = ops.withColumn("_half", lab).where(F.col("_half").isin(cur_lab, pri_lab))
    is_cur = F.col("_half") == cur_lab
    aggs = [F.countDistinct(F.when(is_cur, F.col("ops_date"))).alias("cur_days"),
            F.countDistinct(F.when(~is_cur, F.col("ops_date"))).alias("pri_days")]
    for c in HOH_SUMS:
        aggs.append(F.coalesce(F.sum(F.when(is_cur, F.col(c))), F.lit(0)).alias(f"c_{c}"))
        aggs.append(F.coalesce(F.sum(F.when(~is_cur, F.col(c))), F.lit(0)).alias(f"r_{c}"))
    one = x.agg(*aggs)
    scale = F.when(F.col("pri_days") > 0, dbl("cur_days") / dbl("pri_days")).otherwise(F.lit(1.0))
    for c in HOH_SUMS:
        one = one.withColumn(f"p_{c}", (dbl(f"r_{c}") * scale).cast("bigint"))
    for side in ("c", "p"):
        one = one.withColumn(f"{side}_ss", F.col(f"{side}_sd") + F.col(f"{side}_sf") + F.col(f"{side}_sp"))

    def rate(side, num_cols, den):
        num = None
        for n in num_cols:
            num = F.col(f"{side}_{n}") if num is None else num + F.col(f"{side}_{n}")
        return F.when(F.col(f"{side}_{den}") > 0, dbl(num) / dbl(f"{side}_{den}") * 100.0).otherwise(F.lit(0.0))

    vol = [("Records", "records"), ("Logins", "kpi2_logins"), ("Conversions", "conversions")]
    rates = [("Calls Delivered %", ["d_plus", "d_minus", "d_neutral"], "records"),
             ("No Answer %", ["na"], "records"),
             ("Invalid %", ["t", "dnc", "dx", "wn", "am"], "records"),
             ("Email Delivered %", ["ed"], "es"), ("Email Opened %", ["eo"], "es"),
             ("Email Clicked %", ["ec"], "es"), ("Email Failed %", ["ef"], "es"),
             ("SMS Delivered %", ["sd"], "ss"), ("SMS Failed %", ["sf"], "ss"), ("SMS Pending %", ["sp"], "ss")]
    rows = []
    for i, (label, c) in enumerate(vol):
        prior, cur = dbl(f"p_{c}"), dbl(f"c_{c}")
        change = F.when(prior != 0, (cur - prior) / prior * 100.0)
        rows.append(F.struct(F.lit(i).alias("position"), F.lit(label).alias("metric"), prior.alias("prior"),
                             cur.alias("current"), change.alias("change"), F.lit("pct").alias("change_unit")))
    for j, (label, nums, den) in enumerate(rates):
        prior, cur = rate("p", nums, den), rate("c", nums, den)
        rows.append(F.struct(F.lit(len(vol) + j).alias("position"), F.lit(label).alias("metric"),
                             prior.alias("prior"), cur.alias("current"), (cur - prior).alias("change"),
                             F.lit("pp").alias("change_unit")))
    out = one.select(cur_lab.alias("current_half"), pri_lab.alias("prior_half"), "cur_days", "pri_days",
                     F.explode(F.array(*rows)).alias("r"))
    return out.select("current_half", "prior_half", "cur_days", "pri_days", "r.*")


# ---------------------------------------------------------------------------
# O7–O10 SLA and volume
# ---------------------------------------------------------------------------

SLA_SUMS = ["records", "kpi2_logins", "conversions", "calls", "sa", "sd", "sf", "sp", "ev", "es", "ed", "ef",
            "eo", "ec", "d_plus", "d_total", "d_minus"]


#: What the prior-year benchmark of O7 scales.
# The measures compared with the benchmark.
SLA_BENCH = ["records", "kpi2_logins", "conversions", "calls", "sa", "ev", "sd", "sf", "sp", "ed", "ef", "eo"]


def sla_fulfilment(ops: DataFrame, snaps: DataFrame, as_of: str | None = None) -> DataFrame:
    """Per client (known lifecycles and clients): sums, the sorted active
    lifecycles, and what the snapshot log holds for the same half of the previous
    year (all lifecycles), scaled by days; change of volume, logins, conversions."""
    known = ops.where((F.col("extracted_lifecycle") != "UNKNOWN") & (F.col("ops_client") != "UNKNOWN"))
    cur = known.groupBy("ops_client").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in SLA_SUMS],
        F.array_sort(F.collect_set("extracted_lifecycle")).alias("active_lifecycles"))
    days = scalar(ops.select(F.countDistinct("ops_date")))
    ref = _as_of(ops, as_of)
    bench_half = F.concat(F.when(F.month(ref) <= 6, F.lit("H1 ")).otherwise(F.lit("H2 ")),
                          (F.year(ref) - 1).cast("string"))
    prev = snaps.where(half_label("ops_date") == bench_half)
    bdays = scalar(prev.select(F.countDistinct("ops_date")))
    bench = prev.groupBy("ops_client").agg(*[F.sum(c).alias(f"_b_{c}") for c in SLA_BENCH])
    out = cur.join(bench, "ops_client", "left").withColumn("num_days", days).withColumn("bench_days", bdays)
    scale = dbl("num_days") / dbl("bench_days")
    for c in SLA_BENCH:
        out = out.withColumn(f"bench_{c}", F.when(F.col("bench_days") > 0, (
            dbl(F.coalesce(f"_b_{c}", F.lit(0))) * scale).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    for c in ("records", "kpi2_logins", "conversions"):
        out = out.withColumn(f"{c}_delta_pct", F.when(
            F.col(f"bench_{c}") != 0, (dbl(c) - dbl(f"bench_{c}")) / dbl(f"bench_{c}") * 100.0))
    return out.drop(*[f"_b_{c}" for c in SLA_BENCH])


def sla_breaches(ops: DataFrame, sla: DataFrame, days: int | None = None) -> DataFrame:
    """Per client × lifecycle, records vs the pro-rated minimum
    ``monthly / 30 × days``; a breach when below.  Lifecycles match the parsed
    ``extracted_lifecycle`` (ruling Q13); the SLA table is a bounded dimension."""
    mins = (sla.where(F.col("monthly_minimum_records") > 0).groupBy("client_name", "lifecycle")
            .agg(F.sum("monthly_minimum_records").cast("bigint").alias("monthly_minimum_records")))
    ndays = F.lit(days) if days else scalar(ops.select(F.datediff(F.max("ops_date"), F.min("ops_date")) + 1))
    vol = ops.groupBy(F.col("ops_client").alias("client_name"), F.col("extracted_lifecycle").alias("lifecycle")) \
        .agg(F.sum("records").cast("bigint").alias("actual_records"))
    active = ops.select(F.col("ops_client").alias("client_name")).distinct()
    x = F.broadcast(mins).join(active, "client_name", "left_semi").join(vol, ["client_name", "lifecycle"], "left")
    x = x.withColumn("actual_records", F.coalesce("actual_records", F.lit(0)).cast("bigint"))
    x = x.withColumn("timeframe_days", ndays.cast("int"))
    x = x.withColumn("pro_rated_target", dbl("monthly_minimum_records") / 30.0 * F.col("timeframe_days"))
    return x.withColumn("breach", dbl("actual_records") < F.col("pro_rated_target"))


def volume_90d(ops: DataFrame, as_of: str | None = None) -> DataFrame:
    """Per client, 90-day daily average (sum / 90) vs the latest day; the
    difference ratio; 'Bulk campaigns' when ≤ −50 %; plus a Total row computed
    from the exact sums."""
    ref = _as_of(ops, as_of)
    age = F.datediff(ref, F.col("ops_date"))
    x = ops.where(~F.col("ops_client").isin("UNKNOWN", "N/A", "") & (age >= 0) & (age <= 90))
    g = x.groupBy(F.col("ops_client").alias("client")).agg(
        F.sum("records").cast("bigint").alias("_s90"),
        F.coalesce(F.sum(F.when(age == 0, F.col("records"))), F.lit(0)).cast("bigint").alias("_s0"))

    def finish(df):
        avg = dbl("_s90") / 90.0
        diff = F.when(avg > 0, (dbl("_s0") - avg) / avg).otherwise(0.0)
        return df.select("client", avg.alias("avg_90d"), dbl("_s0").alias("latest_day"), diff.alias("difference"))

    rows = finish(g).withColumn("note", F.when(F.col("difference") <= -0.5, "Bulk campaigns").otherwise(""))
    total = finish(g.agg(F.sum("_s90").alias("_s90"), F.sum("_s0").alias("_s0")).withColumn("client", F.lit("Total")))
    return rows.unionByName(total.withColumn("note", F.lit("")))


def cac_header(ops: DataFrame, bench: DataFrame) -> DataFrame:
    """Spend, calls, conversions, contact rate D/Calls, CAC; deltas vs the
    benchmark daily averages (all signatures of the latest period) × days."""
    g = ops.agg(F.sum("total_cost").cast(MONEY).alias("total_spend"),
                F.sum("calls").cast("bigint").alias("total_calls"),
                F.sum("conversions").cast("bigint").alias("total_conversions"),
                F.sum("d_total").cast("bigint").alias("total_d"),
                F.sum("records").cast("bigint").alias("total_records"),
                F.countDistinct("ops_date").alias("num_days"))
    latest = scalar(bench.select(F.max_by("benchmark_period", F.concat(F.substring("benchmark_period", 4, 4),
                                                                       F.substring("benchmark_period", 1, 2)))))
    b = bench.where(F.col("benchmark_period") == latest).agg(
        F.round(F.sum("avg_daily_calls"), 6).alias("exp_daily_calls"),
        F.round(F.sum("avg_daily_conversions"), 6).alias("exp_daily_convs"),
        F.round(F.sum("avg_daily_deliveries"), 6).alias("exp_daily_delivs"))
    x = g.withColumn("exp_daily_calls", scalar(b.select("exp_daily_calls"))) \
        .withColumn("exp_daily_convs", scalar(b.select("exp_daily_convs"))) \
        .withColumn("exp_daily_delivs", scalar(b.select("exp_daily_delivs")))
    return x.select(
        "total_records", "total_spend", "total_calls", "total_conversions",
        F.when(F.col("total_calls") > 0, dbl("total_d") / dbl("total_calls") * 100.0).otherwise(0.0).alias("contact_rate"),
        F.when(F.col("total_conversions") > 0, dbl("total_spend") / dbl("total_conversions")).otherwise(0.0).alias("true_cac"),
        (dbl("total_calls") - F.col("exp_daily_calls") * F.col("num_days")).cast("bigint").alias("calls_vs_benchmark"),
        (dbl("total_conversions") - F.col("exp_daily_convs") * F.col("num_days")).cast("bigint").alias("conversions_vs_benchmark"),
        (F.when(F.col("total_calls") > 0, dbl("total_d") / dbl("total_calls") * 100.0).otherwise(0.0)
         - F.when(F.col("exp_daily_calls") > 0, F.col("exp_daily_delivs") / F.col("exp_daily_calls") * 100.0).otherwise(0.0))
        .alias("contact_rate_vs_benchmark"))


# ---------------------------------------------------------------------------
# O11–O15 weekly and daily trends
# ---------------------------------------------------------------------------

def _completed_weeks(ops: DataFrame, as_of: str | None, weeks: int | None) -> DataFrame:
    ref = _as_of(ops, as_of)
    cutoff = last_thursday(ref)
    x = ops.where(F.col("ops_date") <= cutoff).withColumn("week_start", week_start_friday("ops_date"))
    if weeks:
        x = x.where(F.col("week_start") > F.date_sub(cutoff, 7 * weeks))
    return x


def weekly_conversions(ops: DataFrame, as_of: str | None = None, weeks: int = 52) -> DataFrame:
    """Completed Fri→Thu weeks; conversions per (week, lifecycle) without
    UNKNOWN, plus the per-week total (all lifecycles)."""
    x = _completed_weeks(ops, as_of, weeks)
    per = x.where(F.col("extracted_lifecycle") != "UNKNOWN").groupBy("week_start", "extracted_lifecycle").agg(
        F.sum("conversions").cast("bigint").alias("conversions"))
    tot = x.groupBy("week_start").agg(F.sum("conversions").cast("bigint").alias("conversions")) \
        .withColumn("extracted_lifecycle", F.lit("TOTAL"))
    return per.unionByName(tot)


def weekly_logins_cpc(ops: DataFrame, as_of: str | None = None, weeks: int = 52) -> DataFrame:
    """Per week conversions, logins, cost per conversion (0 conversions → 1)
    and the mean campaign data age over rows with an age ≥ 0."""
    x = _completed_weeks(ops, as_of, weeks)
    g = x.groupBy("week_start").agg(
        F.sum("conversions").cast("bigint").alias("conversions"), F.sum("kpi2_logins").cast("bigint").alias("logins"),
        F.sum("total_cost").cast(MONEY).alias("total_cost"),
        F.sum(F.when(F.col("campaign_data_age_days") >= 0, F.col("campaign_data_age_days"))).alias("_age_sum"),
        F.count(F.when(F.col("campaign_data_age_days") >= 0, F.lit(1))).alias("_age_n"))
    return (g.withColumn("cpc", dbl("total_cost") / dbl(F.when(F.col("conversions") == 0, F.lit(1)).otherwise(F.col("conversions"))))
            .withColumn("avg_data_age", F.when(F.col("_age_n") > 0, dbl("_age_sum") / dbl("_age_n")))
            .drop("_age_sum", "_age_n"))


def latest_snapshots(snaps: DataFrame) -> DataFrame:
    """The latest delivery per (campaign, day); of equal delivery times the row with
    the greatest remaining columns, so reruns agree."""
    keys = ["campaign_name", "ops_date"]
    rest = ["snapshot_timestamp"] + [c for c in snaps.columns if c not in [*keys, "snapshot_timestamp"]]
    last = snaps.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_last"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in snaps.columns])


def _trend(rows: DataFrame, period: str, sla: DataFrame | None, targets: DataFrame | None, days: float) -> DataFrame:
    """Sums per view and period, with the lines of the chart.  Views are every client and
    ``All``, which rolls up the client rows; its signature lines need one signature overall."""
    sums = ["records", "calls", "conversions", "logins"]
    per = rows.groupBy(F.col("ops_client").alias("client"), period).agg(
        *[F.sum("kpi2_logins" if c == "logins" else c).cast("bigint").alias(c) for c in sums],
        F.sum(F.col("li_pct") * 100.0).alias("_li"), F.count("li_pct").alias("_li_n"),
        F.min("campaign_signature").alias("_lo"), F.max("campaign_signature").alias("_hi"))
    total = per.groupBy(period).agg(*[F.sum(c).cast("bigint").alias(c) for c in sums], F.sum("_li").alias("_li"),
                                    F.sum("_li_n").alias("_li_n"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    g = per.unionByName(total.withColumn("client", F.lit("All")))
    # one view's periods: days or weeks
    view = Window.partitionBy("client")
    lo, hi = F.min("_lo").over(view), F.max("_hi").over(view)
    g = g.select("client", period, *sums, F.round(F.col("_li") / F.col("_li_n"), 6).alias("li_pct_mean"),
                 capped_pct("conversions", "records").alias("conv_pct"), capped_pct("logins", "records").alias("login_pct"),
                 (dbl(F.sum("records").over(view)) / F.count(F.lit(1)).over(view)).alias("mean_volume"),
                 F.when(lo == hi, lo).alias("campaign_signature"))
    if sla is not None:
        lines = sla.where("brand_code = 'ALL'").groupBy(F.col("client_name").alias("client")).agg(
            (F.sum("monthly_minimum_records") / 30.0 * days).alias("sla_minimum"))
        g = g.join(lines.where("sla_minimum > 0"), "client", "left")
    if targets is not None:
        t = targets.groupBy("campaign_signature").agg(
            (F.min("target_conv_pct") * 100.0).alias("target_conv_pct"), (F.min("target_li_pct") * 100.0).alias("target_li_pct"))
        g = g.join(t, "campaign_signature", "left")
    return g.drop("campaign_signature")


def daily_efficiency(latest: DataFrame, sla: DataFrame | None = None, targets: DataFrame | None = None) -> DataFrame:
    """O14 over the latest snapshots: per view (client or All) and date: sums, mean LI %, Conv %
    and Login % of records capped at 100, the mean-volume line, the client's SLA / 30 line (brand
    ALL) and target lines where the view holds exactly one signature."""
    rows = latest.withColumn("campaign_signature", C.campaign_signature("campaign_name"))
    return _trend(rows, "ops_date", sla, targets, 1.0)


def weekly_efficiency(latest: DataFrame, sla: DataFrame | None = None, targets: DataFrame | None = None,
                      as_of: str | None = None) -> DataFrame:
    """The same per completed week; percentages recomputed from weekly sums (not
    means of daily percentages, see H5), no LI mean; SLA × 7/30."""
    rows = _completed_weeks(latest, as_of, None).withColumn("campaign_signature", C.campaign_signature("campaign_name"))
    return _trend(rows, "week_start", sla, targets, 7.0).drop("li_pct_mean")


# ---------------------------------------------------------------------------
# O16–O19 scorecards and ledger
# ---------------------------------------------------------------------------

SCORE_SUMS = ["records", "calls", "conversions", "kpi2_logins", "hlrv", "twoxrv", "d_plus", "d_neutral",
              "d_minus", "na", "am", "dnc", "dx", "wn", "t", "sa", "sd", "sf", "sp", "ev", "es", "ed", "ef", "eo",
              "ec", "d_total"]


def _score_cols(df: DataFrame) -> DataFrame:
    c = F.col
    net = F.greatest(c("records") - c("hlrv") - c("twoxrv"), F.lit(1))
    rec1 = F.when(c("records") == 0, F.lit(1)).otherwise(c("records"))
    calls1 = F.when(c("calls") == 0, F.lit(1)).otherwise(c("calls"))

    def clip01(e):
        return F.least(F.greatest(e, F.lit(0.0)), F.lit(1.0))

    def nz_pct(num, den):
        return F.when(den != 0, dbl(num) / dbl(den) * 100.0).otherwise(F.lit(0.0))

    deliveries = c("d_plus") + c("d_neutral") + c("d_minus")
    return (df.withColumn("net_records", net)
            .withColumn("gross_completion_pct", clip01(dbl("calls") / dbl(rec1)) * 100.0)
            .withColumn("net_completion_pct", clip01(dbl("calls") / dbl(net)) * 100.0)
            .withColumn("deliveries", deliveries)
            .withColumn("issues", c("am") + c("dnc") + c("dx") + c("wn") + c("t"))
            .withColumn("deliveries_pct", dbl(deliveries) / dbl(calls1) * 100.0)
            .withColumn("logins_per_record_pct", dbl("kpi2_logins") / dbl(rec1) * 100.0)
            .withColumn("conversions_per_login_pct", nz_pct(c("conversions"), c("kpi2_logins")))
            .withColumn("email_delivered_pct", nz_pct(c("ed"), c("ed") + c("ef")))
            .withColumn("email_open_pct", nz_pct(c("eo"), c("ed")))
            .withColumn("sms_delivered_pct", nz_pct(c("sd"), c("sd") + c("sp") + c("sf"))))


def pitch_scorecard(base: DataFrame) -> DataFrame:
    """O16 (+O17 bands): per core signature."""
    g = base.groupBy("core_signature").agg(*[F.sum(s).cast("bigint").alias(s) for s in SCORE_SUMS])
    return color_bands(_score_cols(g))


def color_bands(df: DataFrame) -> DataFrame:
    """Deliveries 20/15/10; delivery rate 90/85; engagement 10/5."""
    d = F.col("deliveries_pct")
    e = F.col("logins_per_record_pct")
    r = F.col("email_delivered_pct")
    return (df.withColumn("deliveries_band", F.when(d >= 20, "green").when(d >= 15, "yellow")
                          .when(d >= 10, "orange").otherwise("red"))
            .withColumn("delivery_rate_band", F.when(r >= 90, "green").when(r >= 85, "yellow").otherwise("red"))
            .withColumn("engagement_band", F.when(e >= 10, "green").when(e >= 5, "yellow").otherwise("red")))


def daily_campaign_detail(base: DataFrame) -> DataFrame:
    """The row-level scorecard plus NA %, issues % and email clicked."""
    x = _score_cols(base.select("campaign_name", "ops_date", "core_signature", *SCORE_SUMS))
    rec1 = F.when(F.col("records") == 0, F.lit(1)).otherwise(F.col("records"))
    return (x.withColumn("na_pct", dbl("na") / dbl(rec1) * 100.0)
            .withColumn("issues_pct", dbl("issues") / dbl(rec1) * 100.0)
            .withColumn("email_clicked_pct", F.when(F.col("eo") != 0, dbl("ec") / dbl("eo") * 100.0).otherwise(0.0)))


def true_cost_ledger(ops: DataFrame, bench: DataFrame) -> DataFrame:
    """O19 + J8: per campaign, client, brand, date and signature: sums, CAC
    (x/0 → 0), conv %, contact rate D/(D+NA+issues); left join to the
    benchmark of the *same half, previous year* on the five signature keys."""
    keys = ["campaign_name", "ops_client", "ops_brand", "ops_date", "country", "extracted_lifecycle",
            "extracted_segment", "extracted_engagement"]
    g = ops.groupBy(*keys).agg(
        F.sum("records").cast("bigint").alias("records"), F.sum("calls").cast("bigint").alias("calls"),
        F.sum("total_cost").cast(MONEY).alias("total_cost"), F.sum("conversions").cast("bigint").alias("conversions"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("d_total", "na", "am", "dnc", "dx", "wn", "t")])
    issues = F.col("am") + F.col("dnc") + F.col("dx") + F.col("wn") + F.col("t")
    tot = F.col("d_total") + F.col("na") + issues
    g = (g.withColumn("true_cac", F.when(F.col("conversions") != 0, dbl("total_cost") / dbl("conversions")).otherwise(0.0))
         .withColumn("conv_pct", F.when(F.col("records") != 0, dbl("conversions") / dbl("records") * 100.0).otherwise(0.0))
         .withColumn("contact_rate", F.when(tot != 0, dbl("d_total") / dbl(tot) * 100.0).otherwise(0.0))
         .withColumn("target_benchmark_half", F.concat(F.when(F.month("ops_date") <= 6, F.lit("H1 ")).otherwise(F.lit("H2 ")),
                                                       (F.year("ops_date") - 1).cast("string"))))
    b = bench.select(F.col("brand").alias("ops_brand"), "country", "extracted_lifecycle", "extracted_segment",
                     "extracted_engagement", F.col("benchmark_period").alias("target_benchmark_half"),
                     F.col("avg_daily_true_cac").alias("benchmark_cac"))
    j = g.join(b, ["ops_brand", "country", "extracted_lifecycle", "extracted_segment", "extracted_engagement",
                   "target_benchmark_half"], "left")
    j = j.withColumn("benchmark_cac", F.coalesce("benchmark_cac", F.lit(0.0)))
    return j.withColumn("cac_delta", F.col("true_cac") - F.col("benchmark_cac")).drop("target_benchmark_half")


# ---------------------------------------------------------------------------
# O20–O25 morning report, recaps, distributions
# ---------------------------------------------------------------------------

VARIANCE_METRICS = [("records", "New Data", False), ("logins", "Logins", False),
                    ("conversions", "Conversions", False), ("total_cost", "Total Cost", True)]


def _variance(v: Column, b: Column) -> Column:
    diff = (v - b) / b
    return F.when(b == 0, F.when(v == 0, F.lit(0.0)).otherwise(F.lit(1.0))) \
        .when(F.abs(diff) < 0.01, F.lit(0.0)).otherwise(diff)


def morning_variance(ops: DataFrame, as_of: str | None = None) -> DataFrame:
    """NLI only; per client × lifecycle over the 56 days ending ``as_of``
    (missing days count as 0): yesterday vs the mean of the same weekday in the
    4 prior weeks; last 7 days vs the 8-week weekly average; cost inverted in
    the heat score, clipped to ±0.5, flagged at ≤ −0.15."""
    ref = _as_of(ops, as_of)
    age = F.datediff(ref, F.col("ops_date"))
    x = ops.where((F.col("extracted_engagement") == "NLI") & (age >= 0) & (age <= 55)
                  & (F.upper(F.trim("extracted_lifecycle")) != "UNKNOWN") & F.col("extracted_lifecycle").isNotNull())
    x = x.select(F.col("ops_client").alias("client"), F.col("extracted_lifecycle").alias("lifecycle"), age.alias("_age"),
                 dbl("records").alias("records"), dbl("kpi2_logins").alias("logins"),
                 dbl("conversions").alias("conversions"), F.col("total_cost").cast(MONEY).alias("total_cost"))
    aggs = []
    for m, _, _ in VARIANCE_METRICS:
        v = F.col(m)
        aggs += [F.sum(F.when(F.col("_age") == 0, v)).alias(f"{m}__y"),
                 F.sum(F.when(F.col("_age").isin(7, 14, 21, 28), v)).alias(f"{m}__dow"),
                 F.sum(F.when(F.col("_age") < 7, v)).alias(f"{m}__l7"),
                 F.sum(v).alias(f"{m}__all")]
    g = x.groupBy("client", "lifecycle").agg(*aggs)
    rows = []
    for m, label, is_cost in VARIANCE_METRICS:
        y = dbl(F.coalesce(f"{m}__y", F.lit(0)))
        dow = dbl(F.coalesce(f"{m}__dow", F.lit(0))) / 4.0
        l7 = dbl(F.coalesce(f"{m}__l7", F.lit(0)))
        allv = dbl(F.coalesce(f"{m}__all", F.lit(0)))
        w8 = allv / 8.0
        var_dow = _variance(y, dow)
        var_w8 = _variance(l7, w8)
        hm = -var_dow if is_cost else var_dow
        hm = F.when(F.abs(hm) < 0.01, F.lit(0.0)).otherwise(hm)
        rows.append(F.struct(F.lit(label).alias("metric"), y.alias("yesterday"), (allv / 56.0).alias("daily_avg"),
                             dow.alias("dow_avg"), var_dow.alias("var_dow"), l7.alias("last_7"), w8.alias("w8_avg"),
                             var_w8.alias("var_w8"), F.least(F.greatest(hm, F.lit(-0.5)), F.lit(0.5)).alias("heat"),
                             (hm <= -0.15).alias("flag")))
    activity = None
    for m, _, _ in VARIANCE_METRICS:
        a = F.abs(dbl(F.coalesce(f"{m}__all", F.lit(0))))
        activity = a if activity is None else activity + a
    g = g.where(activity > 0)
    return g.select("client", "lifecycle", F.explode(F.array(*rows)).alias("r")).select("client", "lifecycle", "r.*")


def sla_pacing(ops: DataFrame, sla: DataFrame, as_of: str | None = None) -> DataFrame:
    """NLI month-to-date records vs (monthly minimum / 30 × day of month)."""
    ref = _as_of(ops, as_of)
    limits = sla.where(F.col("monthly_minimum_records") > 0).groupBy(F.col("client_name").alias("client")) \
        .agg(F.sum("monthly_minimum_records").cast("bigint").alias("sla_limit"))
    mtd = ops.where((F.col("extracted_engagement") == "NLI") & (F.trunc("ops_date", "month") == F.trunc(ref, "month"))
                    & (F.col("ops_date") <= ref)) \
        .groupBy(F.col("ops_client").alias("client")).agg(F.sum("records").cast("bigint").alias("mtd_records"))
    x = F.broadcast(limits).join(mtd, "client", "left").withColumn("mtd_records", F.coalesce("mtd_records", F.lit(0)))
    prorated = dbl("sla_limit") / 30.0 * F.dayofmonth(ref)
    x = x.withColumn("prorated_sla", prorated)
    x = x.withColumn("pacing", F.when(F.col("prorated_sla") > 0, dbl("mtd_records") / F.col("prorated_sla")).otherwise(1.0))
    return x.withColumn("status", F.when(F.col("pacing") < 1.0, "under").otherwise("over"))


def trend_flags(ops: DataFrame, as_of: str | None = None) -> DataFrame:
    """Per metric, the 30-day and 7-day daily averages (missing days as 0)
    of the NLI series ending ``as_of``; UP when 7-day ≥ 30-day."""
    ref = _as_of(ops, as_of)
    age = F.datediff(ref, F.col("ops_date"))
    x = ops.where((F.col("extracted_engagement") == "NLI") & (age >= 0) & (age < 30))
    first_age = F.max(age)
    g = x.agg(first_age.alias("_span"),
              *[F.sum(c).alias(f"{c}__30") for c in ("records", "kpi2_logins", "conversions", "total_cost")],
              *[F.sum(F.when(age < 7, F.col(c))).alias(f"{c}__7") for c in ("records", "kpi2_logins", "conversions", "total_cost")])
    rows = []
    for c, label in [("records", "New Data"), ("kpi2_logins", "Logins"), ("conversions", "Conversions"),
                     ("total_cost", "Total Cost")]:
        days = F.col("_span") + 1
        a30 = dbl(F.coalesce(f"{c}__30", F.lit(0))) / dbl(days)
        a7 = dbl(F.coalesce(f"{c}__7", F.lit(0))) / dbl(F.least(days, F.lit(7)))
        rows.append(F.struct(F.lit(label).alias("metric"), a30.alias("avg_30"), a7.alias("avg_7"),
                             F.when(a7 >= a30, "UP").otherwise("DOWN").alias("trend")))
    return g.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# Client alias normalisation (O23): alias → canonical client name.
CLIENT_ALIASES = {"Northwind": "Northwind Gaming", "Harbor": "Harbor Play", "Orchid": "Orchid Media"}


def normalise_client(c) -> Column:
    m = F.create_map(*[F.lit(x) for kv in CLIENT_ALIASES.items() for x in kv])
    return F.coalesce(F.element_at(m, F.col(c) if isinstance(c, str) else c), F.col(c) if isinstance(c, str) else c)


def recap(snapshots: DataFrame) -> DataFrame:
    """Four sums by client, by month and the grand total (one rollup)."""
    x = snapshots.withColumn("month", F.date_format("ops_date", "yyyy-MM"))
    r = x.rollup("ops_client", "month").agg(
        F.sum("records").cast("bigint").alias("total_records"), F.sum("kpi2_logins").cast("bigint").alias("total_logins"),
        F.sum("conversions").cast("bigint").alias("total_conversions"), F.sum("calls").cast("bigint").alias("total_calls"),
        F.grouping_id().alias("_gid"))
    by_client = r.where("_gid = 1").select(F.lit("client").alias("view"), F.col("ops_client").alias("key"),
                                           "total_records", "total_logins", "total_conversions", "total_calls")
    grand = r.where("_gid = 3").select(F.lit("client").alias("view"), F.lit("GRAND TOTAL").alias("key"),
                                       "total_records", "total_logins", "total_conversions", "total_calls")
    by_month = x.groupBy("month").agg(
        F.sum("records").cast("bigint").alias("total_records"), F.sum("kpi2_logins").cast("bigint").alias("total_logins"),
        F.sum("conversions").cast("bigint").alias("total_conversions"), F.sum("calls").cast("bigint").alias("total_calls"))
    by_month = by_month.select(F.lit("month").alias("view"), F.col("month").alias("key"), "total_records",
                               "total_logins", "total_conversions", "total_calls")
    return by_client.unionByName(grand).unionByName(by_month)


def outcome_distributions(ops: DataFrame) -> DataFrame:
    """Slice totals as (chart, outcome, value) rows; issues here exclude AM."""
    t = ops.agg(*[F.sum(c).cast("bigint").alias(c) for c in ("d_plus", "d_minus", "d_total", "na", "wn", "dnc", "dx", "t")])
    c = F.col
    rows = [("overall", "Deliveries", c("d_plus") + c("d_minus") + c("d_total")), ("overall", "No Answer", c("na")),
            ("overall", "Issues", c("wn") + c("dnc") + c("dx") + c("t")),
            ("deliveries", "D+", c("d_plus")), ("deliveries", "D", c("d_total")), ("deliveries", "D-", c("d_minus")),
            ("issues", "WN", c("wn")), ("issues", "DNC", c("dnc")), ("issues", "DX", c("dx")), ("issues", "T", c("t"))]
    arr = F.array(*[F.struct(F.lit(a).alias("chart"), F.lit(b).alias("outcome"), F.coalesce(e, F.lit(0)).cast("bigint").alias("value"))
                    for a, b, e in rows])
    out = t.select(F.explode(arr).alias("r")).select("r.*")
    return out.where((F.col("chart") != "issues") | (F.col("value") > 0))


def signature_targets(base: DataFrame, targets: DataFrame, view_key: str = "ops_client") -> DataFrame:
    """Per view (here: per client), targets in % for its signature when the
    view holds exactly one campaign signature, else null."""
    v = base.groupBy(view_key).agg(F.countDistinct("campaign_signature").alias("signatures"),
                                   F.min("campaign_signature").alias("campaign_signature"))
    t = targets.select("campaign_signature", (F.col("target_conv_pct") * 100.0).alias("target_conv_pct"),
                       (F.col("target_li_pct") * 100.0).alias("target_li_pct"), "target_cac_usd")
    t = t.groupBy("campaign_signature").agg(F.min("target_conv_pct").alias("target_conv_pct"),
                                            F.min("target_li_pct").alias("target_li_pct"),
                                            F.min("target_cac_usd").alias("target_cac_usd"))
    j = v.join(t, "campaign_signature", "left")
    single = F.col("signatures") == 1
    return j.select(view_key, "signatures", F.when(single, F.col("campaign_signature")).alias("campaign_signature"),
                    *[F.when(single, F.col(c)).alias(c) for c in ("target_conv_pct", "target_li_pct", "target_cac_usd")])


def campaign_monthly_counts(cm: DataFrame) -> DataFrame:
    """S3 check view: rows and records per brand and month of the campaign file."""
    return cm.groupBy("brand", "report_month").agg(F.count(F.lit(1)).alias("rows"),
                                                   F.sum("records").cast("bigint").alias("records"))

