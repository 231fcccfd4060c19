"""Adapters from the driver's star-schema tables to the canonical facts.

``player_lines``    line grain of ``player_activity`` (keeps the dates for K13)
``player_activity`` one row per (id, brand, report_month) — the PlayerRecord fact
``ops_daily``       one row per campaign × day — the operations fact
``ops_snapshots``   append-only point-in-time copies of ``ops_daily``
``contact_events``  journey events for the specified-only funnel (R5–R7)

The same mappings are written once more as SQL in ``plans/oracle.py``; the two
must stay in step.

Join order is chosen for scale: customers are joined to their (tiny, fixed-size)
nation/region dimension by broadcast, then to orders, then to line items and
parts; every large join is an equi-join on a key Spark can hash-partition, and
AQE may turn a side into a broadcast when its measured size allows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import campaign as C
from ..functions.core import MONEY, month_from_index, round_money
from . import dims

BASE_MONTH_INDEX = 2024 * 12  # report months are folded onto 2024-01 … 2025-12
FOLD_MONTHS = 24


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _d(x: str):
    return F.lit(Decimal(x))


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries and their regions: nation (25 rows) and region (5 rows) are fixed-size dimensions."""
    nation, region = (read_table(spark, sf_dir, t) for t in ("nation", "region"))
    return F.broadcast(nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
                       .select("n_nationkey", "n_name", "r_name"))


def _joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order, customer, geography and part."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    geo = _geo(spark, sf_dir)
    cust_geo = cust.join(geo, cust.c_nationkey == geo.n_nationkey)
    ord_cust = orders.join(cust_geo, orders.o_custkey == cust_geo.c_custkey)
    return li.join(ord_cust, li.l_orderkey == ord_cust.o_orderkey).join(part, li.l_partkey == part.p_partkey)


def _hundredths(c: str, digits: int):
    """A decimal of two places as a count of hundredths (a long: sums and products of longs are exact
    and take a fraction of a wide decimal's time and memory)."""
    return (F.col(c).cast(f"decimal({digits},2)") * 100).cast("bigint")


def _cents(product: str):
    """Cents, half up like ``round_money``, of a long product of two numbers of hundredths."""
    return F.expr(f"({product} + IF({product} < 0, -50, 50)) div 100")


def _money(cents: str):
    return (F.col(cents).cast("decimal(20,0)") * _d("0.01")).cast(MONEY)


def _hundreds(lines: DataFrame) -> DataFrame:
    """Line items with price, discount and tax as hundredths."""
    return (lines.withColumn("_price", _hundredths("l_extendedprice", 12))
            .withColumn("_disc", _hundredths("l_discount", 4)).withColumn("_tax", _hundredths("l_tax", 4)))


def _fold():
    """The report month's place among the ``FOLD_MONTHS``."""
    return F.pmod(F.year("o_orderdate") * 12 + F.month("o_orderdate"), F.lit(FOLD_MONTHS)).alias("_fold")


def _line_cents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``_joined_lines`` with the measures of ``PLAYER_MEASURES`` in cents, and ``_fold``."""
    return _with_measures(_hundreds(_joined_lines(spark, sf_dir)).withColumn("_fold", _fold()))


def _with_measures(rows: DataFrame) -> DataFrame:
    """Rows of ``_hundreds`` with the measures of ``PLAYER_MEASURES`` in cents."""
    rows = rows.withColumn("revenue", _cents("(_price * (_disc - 4))"))
    rows = rows.withColumn("ngr", _cents("(revenue * (100 - _tax))")).withColumn("bonus_total", _cents("(_price * _disc)"))
    zero = F.lit(0).cast("bigint")
    is_f, is_o = F.col("l_linestatus") == "F", F.col("l_linestatus") == "O"
    price = F.col("_price")
    return rows.select(
        "*", price.alias("bet"), _cents("(_price * _tax)").alias("tax_total"),
        *[F.when(at, F.col(m)).otherwise(zero).alias(f"{n}_{vertical}") for vertical, at in (("casino", is_f), ("sports", is_o))
          for m, n in (("_price", "bet"), ("revenue", "revenue"), ("ngr", "ngr"), ("bonus_total", "bonus"))],
        F.when(F.col("l_returnflag") == "A", 1).otherwise(0).cast("bigint").alias("deposit_count"),
        F.when(F.col("l_returnflag") == "A", price).otherwise(zero).alias("deposits"),
        F.when(F.col("l_returnflag") == "R", price).otherwise(zero).alias("withdrawals"))


def _player_columns() -> list:
    """The keys of ``player_activity`` from the joined tables' columns."""
    return [F.col("o_custkey").cast("string").alias("id"), F.col("r_name").alias("client"), F.col("p_type").alias("brand"),
            F.col("n_name").alias("country"), F.col("c_mktsegment").alias("wb_tag"), F.col("c_mktsegment").alias("segment"),
            month_from_index(F.lit(BASE_MONTH_INDEX) + F.col("_fold")).alias("report_month")]


def player_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    react_days = (F.col("l_orderkey") % 45 - 3).cast("int")
    react_date = F.to_date("o_orderdate")
    lines = _line_cents(spark, sf_dir).select(
        "*", *[k.alias(f"_k_{n}") for n, k in zip(_KEY_ORDER, _player_columns())])
    return lines.select(
        *[F.col(f"_k_{n}").alias(n) for n in _KEY_ORDER[:-1]],
        *[_money(m).alias(m) for m in PLAYER_MEASURES[:9]], "deposit_count",
        *[_money(m).alias(m) for m in PLAYER_MEASURES[9:]],
        F.col("_k_report_month").alias("report_month"),
        react_date.alias("reactivation_date"),
        F.date_sub(react_date, react_days).alias("campaign_start_date"),
        react_days.alias("reactivation_days"),
    )


PLAYER_MEASURES = [
    "bet", "revenue", "ngr", "bet_casino", "revenue_casino", "ngr_casino", "bet_sports",
    "revenue_sports", "ngr_sports", "deposits", "withdrawals", "bonus_total", "bonus_casino",
    "bonus_sports", "tax_total",
]
#: Lines that one task sums into the fact.
LINES_A_TASK = 400_000
#: Lines that one task joins with their orders.
LINES_A_JOIN = 500_000
PLAYER_KEYS = ["id", "brand", "report_month", "client", "country", "wb_tag", "segment"]
_KEY_ORDER = ["id", "client", "brand", "country", "wb_tag", "segment", "report_month"]


def player_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PlayerRecord fact: one row per player × brand × report month.

    client/country/segment are attributes of the player, so grouping on them
    does not split groups.  Lines are dealt by group as they are, ten narrow columns, in as many
    parts as ``LINES_A_TASK`` asks for, and are summed where they then lie, in cents as longs and by
    the tables' own keys: so a task's memory follows neither the size nor the texts of the tables,
    and the names of places come last.  They meet their orders in as many parts as ``LINES_A_JOIN`` asks for.
    """
    li = read_table(spark, sf_dir, "lineitem")
    n = li.count()  # reads no column
    parts, joined = (max(spark.sparkContext.defaultParallelism, -(-n // most)) for most in (LINES_A_TASK, LINES_A_JOIN))
    li = _hundreds(li).select("l_orderkey", "l_partkey", "_price", "_disc", "_tax", "l_returnflag", "l_linestatus")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", _fold())
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    ord_cust = orders.join(cust, orders.o_custkey == cust.c_custkey)
    li, ord_cust = li.repartition(joined, "l_orderkey"), ord_cust.repartition(joined, "o_orderkey")
    lines = li.join(ord_cust, li.l_orderkey == ord_cust.o_orderkey).join(part, li.l_partkey == part.p_partkey)
    group = ["o_custkey", "p_type", "_fold", "c_nationkey", "c_mktsegment"]
    dealt = lines.select(*group, "_price", "_disc", "_tax", "l_returnflag", "l_linestatus").repartition(parts, "o_custkey", "p_type", "_fold")
    sums = _with_measures(dealt).groupBy(*group).agg(*[F.sum(m).alias(m) for m in [*PLAYER_MEASURES, "deposit_count"]])
    sums = sums.join(_geo(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
    keys = dict(zip(_KEY_ORDER, _player_columns()))
    return sums.select(*[keys[k].alias(k) for k in PLAYER_KEYS], *[_money(m).alias(m) for m in PLAYER_MEASURES], "deposit_count")


def aggregate_player_activity(lines: DataFrame) -> DataFrame:
    """``player_activity`` from stored lines."""
    aggs = [F.sum(m).cast(MONEY).alias(m) for m in PLAYER_MEASURES]
    aggs.append(F.sum("deposit_count").cast("bigint").alias("deposit_count"))
    return lines.groupBy(*PLAYER_KEYS).agg(*aggs)


# ---------------------------------------------------------------------------
# Operations fact
# ---------------------------------------------------------------------------
# Generator vocabularies for synthetic campaign names.  They deliberately include
# WBD, blanks, an unmapped tag (ZZ), the NA segment token and the ONT region.
GEN_TAGS = ["LM", "RJ", "LT", "YU", "BHL", "KO", "ZZ", ""]
GEN_COUNTRIES = ["DK", "TR", "CL", "BR", "GB", "JP", "DE", "SE", "ONT", "MX", ""]
GEN_LANGS = ["DA", "TR", "ES", "PT", "EN", "JA"]
GEN_PRODUCTS = ["CAS", "SPO", "LIVE", "ALL", ""]
GEN_SEGMENTS = ["HIGH", "MID", "LOW", "VIP", "NA", "COH1", ""]
GEN_LIFECYCLES = ["WB", "RND", "CS", "ROC", "FD", "OTD", "CHU", "ACQ", "WBD", ""]
GEN_SUBS = ["J1", "J2", "BULK", ""]
GEN_ENGAGEMENTS = ["NLI", "LI", "NLI", "LI", ""]


def _pick(values, idx):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def raw_campaign_name(custkey, orderkey, ops_date):
    k, o = F.col(custkey), F.col(orderkey)
    sep = F.when(k % 5 == 0, F.lit("_")).otherwise(F.lit("-"))
    body = F.concat_ws("-",
                       _pick(GEN_TAGS, k % 8), _pick(GEN_COUNTRIES, k % 11), _pick(GEN_LANGS, o % 6),
                       _pick(GEN_PRODUCTS, o % 5), _pick(GEN_SEGMENTS, k % 7),
                       _pick(GEN_LIFECYCLES, k % 10), _pick(GEN_SUBS, o % 4),
                       _pick(GEN_ENGAGEMENTS, F.floor(o / 3) % 5))
    body = F.replace(body, F.lit("-"), sep)
    cdate = F.date_sub(F.col(ops_date), (o % 9).cast("int"))
    style = o % 4
    suffix = (F.when(style == 0, F.concat(F.lit("-"), F.date_format(cdate, "yyyy-MM-dd")))
              .when(style == 1, F.concat(F.lit("_"), F.date_format(cdate, "yyyy_MM_dd")))
              .when(style == 2, F.concat(F.lit("-"), F.upper(F.date_format(cdate, "ddMMMyyyy"))))
              .otherwise(F.lit("")))
    return F.concat(body, suffix)


OPS_COUNTERS = [
    "records", "calls", "conversions", "kpi2_logins", "d_total", "d_plus", "d_minus",
    "d_neutral", "tech_issues", "t", "am", "dnc", "na", "dx", "wn", "hlrv", "twoxrv", "sa",
    "sd", "sf", "sp", "ev", "es", "ed", "eo", "ec", "ef", "optouts_all", "optout_call",
    "optout_sms", "optout_email",
]
OPS_COSTS = ["cost_caller", "cost_sip", "cost_sms", "cost_email"]


def _ops_line_counters():
    q = F.col("l_quantity").cast("bigint")
    pk, sk, ln = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")

    def flag(c):
        return F.when(c, 1).otherwise(0)

    return {
        "records": q,
        "calls": q + 3,
        "conversions": flag(F.col("l_returnflag") == "R"),
        "kpi2_logins": flag(F.col("l_linestatus") == "O"),
        "d_plus": pk % 3,
        "d_minus": sk % 2,
        "d_neutral": ln % 4,
        "tech_issues": pk % 2,
        "am": sk % 3,
        "dnc": flag(ln == 1),
        "na": q % 5,
        "dx": flag(pk % 4 == 0),
        "wn": flag(sk % 7 == 0),
        "hlrv": flag(pk % 11 == 0),
        "twoxrv": flag(pk % 13 == 0),
        "sa": q % 3,
        "sd": q % 4,
        "sf": flag(sk % 5 == 0),
        "sp": flag(sk % 6 == 0),
        "ev": q % 6,
        "es": q % 7,
        "ed": q % 5,
        "eo": q % 3,
        "ec": flag(q % 4 == 0),
        "ef": flag(q % 9 == 0),
        "optouts_all": flag(pk % 17 == 0),
        "optout_call": flag(pk % 51 == 0),
        "optout_sms": flag(pk % 34 == 0),
        "optout_email": flag(pk % 68 == 0),
    }


def ops_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operations fact (S4 output shape): one row per campaign × day."""
    return finish_ops_rows(ops_raw_daily(spark, sf_dir))


def ops_raw_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw daily deliveries (campaign, day, counters) before parsing — the rows a
    daily export file carries."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # Lines are dealt by order as they are (eight narrow columns instead of thirty counters) and
    # counted per order where they lie, before the join, which needs no further shuffle: the
    # campaign name is built once per order, not once per line.
    counters = _ops_line_counters()
    per_order = li.repartition("l_orderkey").groupBy("l_orderkey").agg(
        *[F.sum(expr).cast("bigint").alias(name) for name, expr in counters.items()],
        F.sum(_hundredths("l_extendedprice", 12)).alias("_cents"))
    rows = per_order.join(orders, per_order.l_orderkey == orders.o_orderkey)
    rows = rows.withColumn("ops_date", F.to_date("o_orderdate"))
    rows = rows.withColumn("campaign", raw_campaign_name("o_custkey", "o_orderkey", "ops_date"))
    daily = rows.groupBy("campaign", "ops_date").agg(*[F.sum(name).cast("bigint").alias(name) for name in [*counters, "_cents"]])
    price = (F.col("_cents").cast("decimal(20,0)") * _d("0.01")).cast("decimal(22,2)")
    return daily.select("campaign", "ops_date", *counters, price.alias("_price"))


def finish_ops_rows(daily: DataFrame) -> DataFrame:
    """C2–C6, C13, C14 and J4 on rows holding ``campaign``, ``ops_date`` and counters."""
    daily = (daily
             .withColumn("t", F.col("tech_issues"))
             .withColumn("d_total", F.col("d_neutral"))
             .withColumn("cost_caller", round_money(F.col("_price") * _d("0.001")))
             .withColumn("cost_sip", round_money(F.col("calls") * _d("0.02")))
             .withColumn("cost_sms", round_money(F.col("sd") * _d("0.05")))
             .withColumn("cost_email", round_money(F.col("es") * _d("0.01")))
             .drop("_price"))
    parsed = C.parse_campaign(daily, "campaign", "ops_date")
    mapping = dims.client_mapping(daily.sparkSession)
    parsed = parsed.join(F.broadcast(mapping.select(
        F.col("brand_code").alias("tag"), "brand_name", "client_name")), "tag", "left")
    total_cost = (F.col("cost_caller") + F.col("cost_sip") + F.col("cost_sms") + F.col("cost_email")).cast(MONEY)
    return parsed.select(
        F.concat(F.col("campaign"), F.lit("_"), F.date_format("ops_date", "yyyy-MM-dd")).alias("campaign_name"),
        F.coalesce("client_name", F.lit("UNKNOWN")).alias("ops_client"),
        F.coalesce("brand_name", "tag").alias("ops_brand"),
        "ops_date",
        *OPS_COUNTERS,
        total_cost.alias("total_cost"),
        F.when(F.col("conversions") > 0, total_cost.cast("double") / F.col("conversions"))
         .otherwise(F.lit(0.0)).alias("true_cac"),
        *OPS_COSTS,
        F.when(F.col("calls") > 0, F.col("d_plus") / F.col("calls")).otherwise(F.lit(0.0)).alias("d_ratio"),
        F.when(F.col("records") > 0, F.col("kpi2_logins") / F.col("records")).otherwise(F.lit(0.0)).alias("li_pct"),
        "extracted_engagement", "extracted_lifecycle", "extracted_segment", "extracted_product",
        "extracted_language", "extracted_sublifecycle", "country", "campaign_data_age_days",
        "tag", *[c for c in ("delivery",) if c in parsed.columns],  # when and in which file it came (streams)
    )


def ops_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point-in-time log: each campaign-day is delivered 1–3 times; earlier
    deliveries carry fewer records.  ``snapshot_timestamp`` orders them."""
    return snapshots_of(ops_daily(spark, sf_dir))


def snapshots_of(base: DataFrame) -> DataFrame:
    versions = (F.col("records") % 3).cast("int")
    snaps = base.withColumn("_v", F.explode(F.sequence(F.lit(0), versions)))
    lag = versions - F.col("_v")
    return (snaps
            .withColumn("records", (F.col("records") - lag).cast("bigint"))
            # Zone-less delivery time (the day after, 00:00 / 06:00 / 12:00), like the feed's own timestamps.
            .withColumn("snapshot_timestamp",
                        F.make_timestamp_ntz(F.year(F.date_add("ops_date", 1)), F.month(F.date_add("ops_date", 1)),
                                             F.dayofmonth(F.date_add("ops_date", 1)), F.col("_v") * 6,
                                             F.lit(0), F.lit(0)))
            .drop("_v"))


def campaign_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CampaignRecord rows (monthly campaign file shape) derived from ``ops_daily``:
    one row per brand × campaign type (engagement) × month."""
    ops = ops_daily(spark, sf_dir)
    return (ops.groupBy(F.col("ops_brand").alias("brand"),
                        F.col("extracted_engagement").alias("campaign_type"),
                        F.date_format("ops_date", "yyyy-MM").alias("report_month"))
            .agg(F.sum("records").cast("bigint").alias("records"),
                 F.sum("conversions").cast("bigint").alias("kpi1_conversions"),
                 F.sum("kpi2_logins").cast("bigint").alias("kpi2_logins"),
                 F.sum("calls").cast("bigint").alias("calls"),
                 F.sum("es").cast("bigint").alias("emails_sent"),
                 F.sum("sd").cast("bigint").alias("sms_sent")))


EVENT_TO_JOURNEY = {"view": "call", "click": "login", "signup": "register", "purchase": "deposit"}


def contact_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Journey events (specified-only table) from the ``events`` stream table."""
    ev = read_table(spark, sf_dir, "events")
    mapping = F.create_map(*[F.lit(x) for kv in EVENT_TO_JOURNEY.items() for x in kv])
    return ev.select(
        F.concat(F.lit("box"), (F.col("user_id") % 5).cast("string")).alias("box_id"),
        F.col("user_id").cast("long").alias("contact_id"),
        F.col("user_id").cast("string").alias("account_number"),
        (F.col("user_id") % 7).cast("int").alias("campaign_id"),
        (F.col("user_id") % 3).cast("int").alias("brand_id"),
        F.element_at(mapping, F.col("event_type")).alias("event_type"),
        F.col("ts").alias("event_at"),
        F.col("value").alias("value"),
        F.col("props").alias("extra_data"),
        F.col("event_id"),
    ).where(F.col("event_type").isNotNull())
