"""Query registry: name → ``fn(spark, sf_dir) -> DataFrame``.

Keys are the operator IDs of the blueprint inventory.  Every query reads the
driver's tables through the adapters, so its work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from ..functions import campaign as C
from ..operators import crm as K
from ..operators import financial as FIN
from ..operators import ops as O
from ..operators import periods as P
from ..operators import quality as Q
from ..sources import dims
from ..streaming import journey as J
from ..operators.financial import as_report
from ..session import lean_steps
from ..sinks import remove_path
from ..sources import testdata as TD

QueryFn = Callable[[SparkSession, str], DataFrame]


def _pa(spark, sf_dir):
    return TD.player_activity(spark, sf_dir)


def _stored(df):
    """``df`` written once to a scratch folder and read back, for queries that read it several times."""
    path = _scratch(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _stored_cohorts(spark, sf_dir):
    """What cohorts read of the fact, stored: its rows are counted and read several times."""
    return _stored(_pa(spark, sf_dir).select("id", "brand", "report_month", "revenue"))


def _summary(spark, sf_dir):
    return FIN.monthly_brand_summary(_stored(_pa(spark, sf_dir)))


def _lean_summary(spark, sf_dir):
    """The summary for views that do not show the whale share."""
    return FIN.monthly_brand_summary(_stored(_pa(spark, sf_dir)), whales=False)


def _f8(spark, sf_dir):
    return as_report(FIN.time_series(_lean_summary(spark, sf_dir), "brand"))


FIN_QUERIES: dict[str, QueryFn] = {
    "f1_monthly_financials": lambda s, d: as_report(FIN.monthly_financials(_pa(s, d))),
    "f2_whale_share": lambda s, d: FIN.whale_share(_pa(s, d), by_brand=True),
    "f2b_whale_share_combined": lambda s, d: FIN.whale_share(_pa(s, d), by_brand=False),
    "f3_cohort_counts": lambda s, d: as_report(FIN.cohort_counts(_stored_cohorts(s, d))),
    "f4_month_padding": lambda s, d: as_report(
        FIN.monthly_brand_summary(_stored(_pa(s, d)), include_combined=False, whales=False)
        .select("brand", "month", "total_players", "ggr", "new_players")),
    "f5_monthly_brand_summary": lambda s, d: as_report(_summary(s, d)),
    "f6_combined_summary": lambda s, d: as_report(_summary(s, d).where("brand = 'Combined'")),
    "f7_both_business_summary": lambda s, d: as_report(FIN.both_business_summary(_lean_summary(s, d))),
    "f8_time_series": _f8,
    "f11_quarterly": lambda s, d: as_report(FIN.quarterly(_lean_summary(s, d), "brand")),
    "f12_segmentation": lambda s, d: as_report(FIN.segmentation(_pa(s, d))),
    "f13_program_summary": lambda s, d: as_report(FIN.program_summary(_pa(s, d))),
    "f14_geographic_summary": lambda s, d: as_report(FIN.geographic_summary(_pa(s, d))),
    "f15_segment_roi": lambda s, d: as_report(FIN.segment_roi(_pa(s, d))),
    "f17_gross_to_net_bridge": lambda s, d: as_report(FIN.gross_to_net_bridge(_lean_summary(s, d))),
    "f17b_vertical_split": lambda s, d: as_report(FIN.vertical_split(_lean_summary(s, d))),
    "f18_executive_matrix": lambda s, d: as_report(FIN.executive_matrix(_summary(s, d))),
    "f19_demographics_matrix": lambda s, d: as_report(FIN.demographics_matrix(_lean_summary(s, d))),
    "f20_revenue_composition": lambda s, d: as_report(FIN.revenue_composition(_lean_summary(s, d))),
    "f9_ytd": lambda s, d: as_report(FIN.time_series(_lean_summary(s, d), "brand").select(
        "brand", "month", *[f"{m}_ytd" for m in FIN.TS_METRICS])),
    "f10_eoy_projections": lambda s, d: as_report(FIN.time_series(_lean_summary(s, d), "brand").select(
        "brand", "month", *[f"eoy_{e}_{m}" for e in ("momentum", "seasonal")
                            for m in ("ggr", "turnover", "revenue_share_deduction")])),
    "f21_diagnostic_narrative": lambda s, d: FIN.diagnostic_narrative(_summary(s, d)),
    "f23_comparative_table": lambda s, d: as_report(FIN.comparative_table(_lean_summary(s, d))),
    "f22_ingest_diagnostics": lambda s, d: FIN.ingest_diagnostics(_pa(s, d)),
    "f24_kpi_deltas": lambda s, d: as_report(FIN.kpi_deltas(_lean_summary(s, d))),
}


def _profiles(spark, sf_dir):
    return K.smart_profiles(_pa(spark, sf_dir))


OVERLAP_BRANDS = ("PROMO", "STANDARD")

CRM_QUERIES: dict[str, QueryFn] = {
    "k1_player_master_list": lambda s, d: as_report(K.player_master_list(_pa(s, d))),
    "k3_rfm_summary": lambda s, d: as_report(K.rfm_summary(_pa(s, d))),
    "k4_smart_profiles": lambda s, d: as_report(_profiles(s, d)),
    "k5_vip_tier_summary": lambda s, d: as_report(K.tier_summary(_pa(s, d))),
    "k5b_vip_tier_by_brand": lambda s, d: as_report(K.tier_summary_by_brand(_pa(s, d))),
    "k6_cross_brand_overlap": lambda s, d: as_report(K.overlap_stats(_pa(s, d), *OVERLAP_BRANDS)),
    "k6b_multi_brand_overlap": lambda s, d: as_report(K.multi_brand_overlap(_pa(s, d))),
    "k7_ltv_curves": lambda s, d: as_report(K.ltv_curves(_stored_cohorts(s, d))),
    "k8_cohort_retention_matrix": lambda s, d: as_report(K.cohort_retention_matrix(_stored_cohorts(s, d))),
    "k9_retention_heatmap": lambda s, d: as_report(K.retention_heatmap(_stored_cohorts(s, d))),
    "k10_pareto_curve": lambda s, d: as_report(K.pareto_curve(_pa(s, d))),
    "k11_pareto_tiers": lambda s, d: as_report(K.pareto_tiers(_pa(s, d))),
    "k12_product_affinity": lambda s, d: as_report(K.product_affinity(_pa(s, d))),
    "k13_reactivation_velocity": lambda s, d: as_report(K.reactivation_velocity(TD.player_lines(s, d))),
    "k14_vip_churn_radar": lambda s, d: as_report(K.vip_churn_radar(_pa(s, d))),
    "k15_crown_jewels": lambda s, d: as_report(K.crown_jewels(_profiles(s, d))),
    "k16_bonus_abusers": lambda s, d: as_report(K.bonus_abusers(_profiles(s, d))),
    "k17_promo_exploitation": lambda s, d: as_report(K.promo_exploitation(_profiles(s, d))),
    "k18_payment_friction": lambda s, d: as_report(K.payment_friction(_profiles(s, d))),
    "k19_churn_targets": lambda s, d: as_report(K.churn_targets(_profiles(s, d))),
    "k20_profile_counts": lambda s, d: as_report(K.profile_counts(_profiles(s, d))),
    "k20b_profile_extract": lambda s, d: as_report(K.profile_extract(_profiles(s, d), K.COLD_CROWN)),
}


def _ops(spark, sf_dir):
    return TD.ops_daily(spark, sf_dir)


def _base(spark, sf_dir):
    return O.ops_base(_ops(spark, sf_dir))


def _bench(spark, sf_dir):
    return O.historical_benchmarks(_ops(spark, sf_dir))


def _snaps(spark, sf_dir):
    return O.snapshots_base(TD.ops_snapshots(spark, sf_dir))


def _latest_snaps(spark, sf_dir):
    return O.latest_snapshots(_snaps(spark, sf_dir))


# C18 example merge: two brand codes folded into one (a bounded rename table).
BRAND_MERGES = [("LARGE", "SMALL"), ("ECONOMY", "PROMO")]

P1_SPEC = P.FilterSpec(client="Northwind Gaming", engagement="NLI", campaign="dk", start="1997-01-01",
                       end="1999-12-31")

OPS_QUERIES: dict[str, QueryFn] = {
    "c1_campaign_parse": lambda s, d: as_report(O.campaign_parts(_ops(s, d))),
    "c8_campaign_signatures": lambda s, d: _base(s, d).select(
        "campaign_name", "core_signature", "campaign_signature", "strategy_signature", "ops_lifecycle"),
    "c12_short_name_totals": lambda s, d: O.short_name_totals(_ops(s, d)),
    "f16_campaign_summary": lambda s, d: as_report(FIN.campaign_summary(TD.campaign_monthly(s, d))),
    "o1_ops_base": lambda s, d: as_report(_base(s, d).select(
        "campaign_name", "ops_client", "ops_brand", "ops_date", "records", "total_cost", "core_signature",
        "campaign_signature", "strategy_signature", "ops_lifecycle")),
    "o2_snapshots_base": lambda s, d: _snaps(s, d).select("campaign_name", "ops_date", "records", "strategy_signature"),
    "o3_daily_pulse": lambda s, d: O.daily_pulse(_ops(s, d)),
    "o4_pulse_windows": lambda s, d: as_report(O.pulse_windows(O.daily_pulse(_ops(s, d)))),
    "o5_historical_benchmarks": lambda s, d: as_report(_bench(s, d)),
    "o6_half_over_half": lambda s, d: as_report(O.half_over_half(_ops(s, d))),
    "o7_sla_fulfilment": lambda s, d: as_report(O.sla_fulfilment(_ops(s, d), _snaps(s, d))),
    "o8_sla_breaches": lambda s, d: as_report(O.sla_breaches(_ops(s, d), dims.contractual_volumes(s))),
    "o9_volume_90d": lambda s, d: as_report(O.volume_90d(_ops(s, d))),
    "o10_cac_header": lambda s, d: as_report(O.cac_header(_ops(s, d), _bench(s, d))),
    "o11_weekly_conversions": lambda s, d: as_report(O.weekly_conversions(_ops(s, d))),
    "o12_weekly_logins_cpc": lambda s, d: as_report(O.weekly_logins_cpc(_ops(s, d))),
    "o13_latest_snapshots": lambda s, d: _latest_snaps(s, d).select(
        "campaign_name", "ops_client", "ops_date", "records", "calls", "conversions",
        F.date_format("snapshot_timestamp", "yyyy-MM-dd HH:mm:ss").alias("snapshot_at")),
    "o14_daily_efficiency": lambda s, d: as_report(O.daily_efficiency(
        _latest_snaps(s, d), dims.contractual_volumes(s), dims.granular_benchmarks(_ops(s, d)))),
    "o15_weekly_efficiency": lambda s, d: as_report(O.weekly_efficiency(
        _latest_snaps(s, d), dims.contractual_volumes(s), dims.granular_benchmarks(_ops(s, d)))),
    "o16_pitch_scorecard": lambda s, d: as_report(O.pitch_scorecard(_base(s, d))),
    "o17_color_bands": lambda s, d: O.pitch_scorecard(_base(s, d)).select(
        "core_signature", "deliveries_band", "delivery_rate_band", "engagement_band"),
    "o18_daily_campaign_detail": lambda s, d: as_report(O.daily_campaign_detail(_base(s, d))),
    "o19_true_cost_ledger": lambda s, d: as_report(O.true_cost_ledger(_ops(s, d), _bench(s, d))),
    "o20_morning_variance": lambda s, d: as_report(O.morning_variance(_ops(s, d))),
    "o21_sla_pacing": lambda s, d: as_report(O.sla_pacing(_ops(s, d), dims.contractual_volumes(s))),
    "o22_trend_flags": lambda s, d: as_report(O.trend_flags(_ops(s, d))),
    "o23_client_alias_recap": lambda s, d: _ops(s, d).groupBy(O.normalise_client("ops_client").alias("client"))
        .agg(F.sum("records").cast("bigint").alias("records")),
    "o24_recap": lambda s, d: O.recap(_snaps(s, d)),
    "o25_outcome_distributions": lambda s, d: O.outcome_distributions(_ops(s, d)),
    "o26_signature_targets": lambda s, d: as_report(O.signature_targets(
        _base(s, d), dims.granular_benchmarks(_ops(s, d)))),
    "q1_registry_gaps": lambda s, d: Q.registry_gaps(_pa(s, d)),
    "q2_compliance_grid": lambda s, d: Q.compliance_grid(_pa(s, d)),
    "q3_unmapped_tags": lambda s, d: Q.unmapped_tags(_ops(s, d), dims.client_mapping(s)),
    "q4_client_health": lambda s, d: as_report(Q.client_health(
        dims.client_mapping(s), dims.contractual_volumes(s), _ops(s, d), _pa(s, d))),
    "q5_ops_completeness": lambda s, d: as_report(Q.ops_completeness(_ops(s, d), _pa(s, d))),
    "q7_daily_drilldown": lambda s, d: Q.daily_drilldown(_ops(s, d)),
    "q8_date_gaps": lambda s, d: Q.date_gaps(_ops(s, d)),
    "q9_sync_check": lambda s, d: Q.sync_check(_ops(s, d), _latest_snaps(s, d)),
    "q10_post_load_check": lambda s, d: Q.post_load_check(_ops(s, d)),
    "p1_global_filter": lambda s, d: P.filter_ops(_ops(s, d), P1_SPEC).select(
        "campaign_name", "ops_client", "ops_date", "records", "conversions"),
    "p2_filter_domains": lambda s, d: P.filter_domains(_ops(s, d), _pa(s, d)),
    "p3_date_bounds": lambda s, d: P.date_bounds(_ops(s, d), _pa(s, d)),
    "p4_period_presets": lambda s, d: as_report(P.period_presets(_ops(s, d))),
    "p5_completed_halves": lambda s, d: P.completed_halves(_ops(s, d)),
    "p6_completed_weeks": lambda s, d: P.completed_weeks(_ops(s, d)),
    "p7_client_visibility": lambda s, d: P.client_visibility(_ops(s, d), ["Northwind Gaming", "Orchid Media"],
                                                             "ops_client").groupBy("ops_client")
        .agg(F.sum("records").cast("bigint").alias("records")),
    "c18_brand_merge": lambda s, d: as_report(C.apply_renames(_pa(s, d), "brand", s.createDataFrame(
        BRAND_MERGES, "old string, new string")).groupBy("brand").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("revenue").cast("decimal(18,2)").alias("ggr"))),
    "c19_reparse_unknown": lambda s, d: C.reparse_unknown(
        _ops(s, d).withColumn("campaign", O.raw_campaign(None)), "campaign").select(
        "campaign_name", "extracted_lifecycle", "extracted_engagement"),
    "p8_search_page": lambda s, d: P.search_page(_ops(s, d).select("campaign_name", "ops_date", "records"),
                                                 "campaign_name", "nli", ["campaign_name", "ops_date"], page=2),
}


def _scratch(spark, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    import uuid
    from ..session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


#: Sources that deliver a day in the R1 query.
R1_SOURCES = 5


def r1_deliveries(raw):
    """Raw daily rows as deliveries of several sources: days of even number come twice, first with
    other numbers and with a campaign that the second delivery drops."""
    def row(at: str, suffix: str, more: int):
        return F.struct(F.lit(at).alias("delivery"), F.concat("campaign", F.lit(suffix)).alias("campaign"),
                        (F.col("records") + more).alias("records"))
    twice = F.array(row("1", "", 1), row("1", "-DROPPED", 0), row("2", "", 0))
    rows = raw.withColumn("source", F.concat(F.lit("box"), F.pmod(F.xxhash64("campaign"), F.lit(R1_SOURCES)).cast("string")))
    # a source's days lie in several files, and files hold days of several months; rows are dealt before they are repeated
    rows = rows.repartition("source", F.pmod(F.xxhash64("ops_date"), F.lit(2)))
    rows = rows.withColumn("_d", F.explode(F.when(F.dayofmonth("ops_date") % 2 == 0, twice).otherwise(F.array(row("1", "", 0)))))
    columns = [c for c in raw.columns if c not in ("campaign", "records")]
    return rows.select(*columns, "source", "_d.delivery", "_d.campaign", "_d.records")


def _r1_stream_ingest(spark, sf_dir):
    """Raw daily deliveries of five sources written as files (derived from the tables),
    ingested by the file-source stream into the live table."""
    from ..streaming import ops_stream as S
    root = _scratch(spark, "r1")
    with lean_steps(spark):
        # Written between its shuffles, so that the first ones are gone when the last is made.
        TD.ops_raw_daily(spark, sf_dir).write.parquet(f"{root}/raw")
        r1_deliveries(spark.read.parquet(f"{root}/raw")).write.partitionBy(S.SOURCE_FOLDER, S.DELIVERY_FOLDER).parquet(f"{root}/incoming")
    remove_path(spark, f"{root}/raw")
    q = S.start_ops_ingest(spark, f"{root}/incoming", f"{root}/out", f"{root}/chk", max_files_per_trigger=10)
    S.run_available(q)
    live = spark.read.parquet(f"{root}/out/ops_live")
    return live.select("campaign_name", "ops_client", "ops_brand", "ops_date", "records", "conversions",
                       F.col("total_cost").cast("double").alias("total_cost"), "extracted_lifecycle",
                       "extracted_engagement", "country",
                       F.col("campaign_data_age_days").cast("bigint").alias("campaign_data_age_days"))


def _r4_event_pulse(spark, sf_dir):
    """The events as a file stream, aggregated in update mode and upserted into the pulse table."""
    from ..streaming import ops_stream as S
    root = _scratch(spark, "r4")
    t = S.run_pulse(S.event_pulse_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet"), f"{root}/pulse", f"{root}/chk")
    return t.select("day", F.col("engagement").alias("event_type"), "rows",
                    F.round("total_value", 6).alias("total_value"))


#: What a re-delivered event adds to its id.
REDELIVERED = 1_000_000_000_000


def _events(spark, sf_dir):
    return TD.contact_events(spark, sf_dir)


def _r5_journey_dedup(spark, sf_dir):
    """A feed in which every event of an even id is delivered a second time under a new id."""
    events = _events(spark, sf_dir)
    again = events.where(F.col("event_id") % 2 == 0).withColumn("event_id", F.col("event_id") + REDELIVERED)
    feed = events.unionByName(again)
    return J.dedup_batch(feed).select(*J.DEDUP_KEYS, F.col("event_id").cast("bigint").alias("event_id"), "value")


def _r5_journey_dedup_stream(spark, sf_dir):
    """R5, streamed: the feed up to a day is drained and the query ends; then the last ten days
    before that come again under new ids, together with the rest of the feed, and the query starts
    anew from its checkpoint.  Only kept state can tell the repeated events."""
    root = _scratch(spark, "r5")
    events = _events(spark, sf_dir)
    # one row: ten days before the newest event
    cut = events.agg(F.max("event_at") - F.expr("interval 10 days")).first()[0]
    again = events.where((F.col("event_at") <= F.lit(cut)) & (F.col("event_at") > F.lit(cut) - F.expr("interval 10 days")))
    parts = [events.where(F.col("event_at") <= F.lit(cut)),
             events.where(F.col("event_at") > F.lit(cut)).unionByName(again.withColumn("event_id", F.col("event_id") + REDELIVERED))]
    for i, part in enumerate(parts):
        part.write.parquet(f"{root}/feed/{i}")
        J.start_dedup(J.read_event_stream(spark, f"{root}/feed", events.schema), f"{root}/log", f"{root}/chk").awaitTermination()
    return spark.read.parquet(f"{root}/log").select(*J.DEDUP_KEYS, F.col("event_id").cast("bigint").alias("event_id"), "value")


def _s1_financial_files(spark, sf_dir):
    """The monthly fact exported as detailed-format files
    (``brand/brand_yyyy_mm.csv``), re-read in one pass and summed."""
    from ..sources import files as FL
    root = _scratch(spark, "s1")
    by_brand = FL.export_detailed(_pa(spark, sf_dir), root)
    paths = sorted(p for ps in by_brand.values() for p in ps)
    loaded = FL.load_financial_directory(spark, paths, dims.client_mapping(spark), "detailed")
    return as_report(loaded.groupBy("brand", "report_month").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("revenue").cast("decimal(18,2)").alias("ggr"),
        F.sum("bet").cast("decimal(18,2)").alias("turnover"), F.sum("bonus_total").cast("decimal(18,2)").alias("bonus"),
        F.sum("deposit_count").cast("bigint").alias("deposit_count")))


#: Formats that the S1 queries give the brands, in the order of their names.
ROUTED_FORMATS = ["detailed", "basic", "sheet_cohort", "Standard"]


def _routed_registry(spark, pa):
    """A registry of the fact's brands (one row each) with a format for every one."""
    names = sorted(r.brand for r in pa.select("brand").where("brand is not null").distinct().collect())
    return spark.createDataFrame([(n, n, f"Client {i % 3}", ROUTED_FORMATS[i % len(ROUTED_FORMATS)]) for i, n in enumerate(names)],
                                 "brand_code string, brand_name string, client_name string, financial_format string")


def _s1b_routed_formats(spark, sf_dir):
    """S1 over three layouts: every brand's months exported in its registry format, the directory
    routed per file and loaded in one plan."""
    from ..sources import routing
    pa = _stored(_pa(spark, sf_dir))
    registry = _routed_registry(spark, pa)
    good, _ = routing.route_financial_files(spark, routing.export_by_format(pa, registry, _scratch(spark, "s1b")), registry)
    return as_report(good.groupBy("client", "brand", "report_month", "format").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("segment").alias("segments"), F.countDistinct("country").alias("countries"),
        *[F.sum(c).cast("decimal(18,2)").alias(a) for c, a in (("revenue", "ggr"), ("bet", "turnover"), ("ngr", "ngr"), ("deposits", "deposits"))]))


def _s11_quarantine(spark, sf_dir):
    """The same directory with spoilt lines; good rows and reason-tagged rejected lines are
    written beside each other, and both are counted."""
    from ..sources import routing
    pa = _stored(_pa(spark, sf_dir))
    registry = _routed_registry(spark, pa)
    root = _scratch(spark, "s11")
    paths = routing.export_by_format(pa, registry, f"{root}/files", damage=True)
    routing.load_with_quarantine(spark, paths, registry, f"{root}/good", f"{root}/rejected")
    good = spark.read.parquet(f"{root}/good").select(F.lower("brand").alias("brand_key"), "report_month", F.lit("good").alias("reason"))
    rejected = spark.read.parquet(f"{root}/rejected").select("brand_key", "report_month", "reason")
    return good.unionByName(rejected).groupBy("brand_key", "report_month", "reason").agg(F.count(F.lit(1)).alias("rows"))


def _s3_campaign_files(spark, sf_dir):
    """S3 + F16: the monthly campaign rows exported as ``brand_yyyy_mm.csv``
    files, re-read (header aliasing, int coercion, title-cased brand, month from
    the file name) and summarized."""
    from ..sources import files as FL
    root = _scratch(spark, "s3")
    paths = FL.export_campaign_monthly(TD.campaign_monthly(spark, sf_dir), root)
    return as_report(FIN.campaign_summary(FL.load_campaign_files(spark, paths)))


def _s4_ops_files(spark, sf_dir):
    """The operations fact exported as monthly raw files
    with a Date column, re-loaded by the file loader."""
    from ..sources import files as FL
    root = _scratch(spark, "s4")
    paths = FL.export_ops(_ops(spark, sf_dir), root)
    loaded = FL.load_ops_files(spark, paths, dims.client_mapping(spark))
    return as_report(loaded.select("campaign_name", "ops_client", "ops_brand", "ops_date", "records", "calls",
                                   "conversions", "total_cost", "true_cac", "extracted_lifecycle",
                                   "extracted_engagement", "country", "campaign_data_age_days"))


def _s2_duplicate_policy(spark, sf_dir):
    """A re-delivery of every month against a registry that
    already holds 2024: without overwrite, the registered (brand, month) rows
    are rejected; what is accepted is counted per brand and month."""
    from .. import sinks
    from ..sources import files as FL
    pa = _pa(spark, sf_dir)
    registry = sinks.registry_table(pa.where(F.col("report_month") < "2025-01"))
    accepted = FL.apply_duplicate_policy(pa, registry, allow_overwrite=False)
    return accepted.groupBy("brand", "report_month").agg(F.count(F.lit(1)).alias("rows"))


def _w5_upsert_by_key(spark, sf_dir):
    """The delivery log upserted by campaign, later deliveries first and some of them twice;
    what is left is the latest delivery of each."""
    from .. import tables
    root = _scratch(spark, "w5")
    snaps = _stored(_snaps(spark, sf_dir))
    hour = F.hour("snapshot_timestamp")
    for loaded in (snaps.where(hour.isin(12, 0)), snaps.where(hour.isin(12, 6)), snaps.where(hour == 0)):
        tables.upsert(spark, loaded, root, "ops", ["campaign_name"], "snapshot_timestamp")
    return tables.read_table(spark, root, "ops").select(
        "campaign_name", "ops_client", "ops_date", "records", "calls", "conversions",
        F.date_format("snapshot_timestamp", "yyyy-MM-dd HH:mm:ss").alias("snapshot_at"))


#: The client that the W4b query loads anew, and the renames of the C18 cascade query.
HEALED_CLIENT = "Client 1"
CLIENT_RENAMES = {"Northwind Gaming": "Boreal Gaming", "ASIA": "Boreal Gaming", "EUROPE": "Europa"}


def _w4b_replace_client(spark, sf_dir):
    """A table by client in which one client's numbers are wrong; its rows are replaced from its
    files, the other clients' files stay."""
    from .. import tables
    from ..sources import routing
    root = _scratch(spark, "w4b")
    pa = _stored(_pa(spark, sf_dir))
    registry = _routed_registry(spark, pa).withColumn("financial_format", F.lit("detailed"))
    named = pa.drop("client").join(registry.selectExpr("brand_name brand", "client_name client"), "brand")
    columns = ["id", "client", "brand", "report_month", "bet", "revenue"]
    wrong = F.when(F.col("client") == HEALED_CLIENT, F.col("revenue") + 1).otherwise(F.col("revenue")).cast("decimal(18,2)")
    tables.create(spark, root, {"player_activity": (named.withColumn("revenue", wrong).select(*columns), "client")})
    files = routing.export_by_format(named.where(F.col("client") == HEALED_CLIENT), registry, f"{root}/files")
    good, _ = routing.route_financial_files(spark, files, registry)
    tables.replace_parts(spark, good.select(*columns), root, "player_activity", "client", [HEALED_CLIENT])
    return as_report(tables.read_table(spark, root, "player_activity").groupBy("client", "brand").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("revenue").cast("decimal(18,2)").alias("ggr"), F.sum("bet").cast("decimal(18,2)").alias("turnover")))


def _c18b_rename_cascade(spark, sf_dir):
    """Clients renamed and merged in the dimension, the financial and the operations table by one commit."""
    from .. import tables
    root = _scratch(spark, "c18b")
    pa = _pa(spark, sf_dir).select("id", "client", "brand", "report_month", "revenue")
    ops = _ops(spark, sf_dir).select("campaign_name", "ops_client", "ops_date", "records")
    tables.create(spark, root, {"client_mapping": (dims.client_mapping(spark), "client_name"), "player_activity": (pa, "client"), "ops_daily": (ops, "ops_client")})
    columns = {"client_mapping": "client_name", "player_activity": "client", "ops_daily": "ops_client"}
    tables.rename_everywhere(spark, root, {t: (c, c) for t, c in columns.items()}, CLIENT_RENAMES)
    out = None
    for table, column in columns.items():
        counts = tables.read_table(spark, root, table).groupBy(F.col(column).alias("client")).agg(F.count(F.lit(1)).alias("rows"))
        counts = counts.select(F.lit(table).alias("table_name"), "client", "rows")
        out = counts if out is None else out.unionByName(counts)
    return out


#: Month range of the report queries.
REPORT_MONTHS = ("2024-07", "2025-06")


def _report(name: str, tab: str) -> QueryFn:
    def run(spark, sf_dir):
        """A registered report over the fact stored by month, computed and written to the report store."""
        from .. import reports, sinks
        root = _scratch(spark, "reports")
        sinks.replace(_pa(spark, sf_dir).hint("rebalance", "report_month"), f"{root}/fact", ["report_month"])
        params = dict(zip(("start_month", "end_month"), REPORT_MONTHS))
        return spark.read.parquet(reports.store_report(spark, name, f"{root}/fact", f"{root}/store", params)[tab])
    return run


#: Registers of the sketches in the query: so many that its counts are exact at test sizes.
QUERY_LG_REGISTERS = 18


def _f13b_sketch_players(spark, sf_dir):
    """Distinct players by brand and quarter from monthly sketches alone."""
    from .. import reports
    root = _scratch(spark, "sketches")
    reports.write_player_sketches(_pa(spark, sf_dir), root, QUERY_LG_REGISTERS)
    quarter = F.concat(F.substring("report_month", 1, 4), F.lit("-Q"), F.ceil(F.substring("report_month", 6, 2).cast("int") / 3).cast("string"))
    return reports.distinct_players(reports.read_player_sketches(spark, root), ["brand", quarter.alias("quarter")])


def _totals(df):
    return as_report(df.groupBy("client", "brand", "report_month").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("revenue").cast("decimal(18,2)").alias("ggr"), F.sum("bet").cast("decimal(18,2)").alias("turnover")))


FACT_COLUMNS = ["id", "client", "brand", "report_month", "revenue", "bet"]


def _w1_append_fact(spark, sf_dir):
    """Months appended to the fact table by two loads; then one year's months, first loaded
    with other numbers, are replaced, and the rest stays."""
    from .. import sinks
    root = _scratch(spark, "w1")
    pa = _pa(spark, sf_dir).select(*FACT_COLUMNS)
    early = F.col("report_month") < "2025-01"
    for part in (pa.where(early).withColumn("revenue", (F.col("revenue") * 2).cast("decimal(18,2)")), pa.where(~early)):
        sinks.append(part.hint("rebalance", "report_month"), root, ["report_month"])
    sinks.replace_partitions(pa.where(early).hint("rebalance", "report_month"), root, ["report_month"])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pa.schema)
    return _totals(spark.read.schema(schema).parquet(root))


def _w7_csv_extract(spark, sf_dir):
    """The monthly totals written as CSV with a header and read back by name."""
    from .. import sinks
    root = _scratch(spark, "w7")
    totals = _totals(_pa(spark, sf_dir))
    sinks.write_csv_extract(totals, root)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in totals.schema)
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(root)


def _w8_multitab_report(spark, sf_dir):
    """The brands tab of the multi-tab report, one folder a brand, months as labels, shares as fractions."""
    from .. import sinks
    out = sinks.write_multitab_report({"brands": as_report(FIN.segmentation(_pa(spark, sf_dir)))}, _scratch(spark, "w8"))
    back = spark.read.parquet(out["brands"])
    return back.select("brand", "month", "month_label", "wb_tag", "total_players", "ggr")


def _s7_range_scan(spark, sf_dir):
    """The stored fact read with a projection and a month range, which is a partition filter."""
    from .. import sinks
    from ..sources import files as FL
    root = _scratch(spark, "s7")
    sinks.replace(_pa(spark, sf_dir).select(*FACT_COLUMNS).hint("rebalance", "report_month"), root, ["report_month"])
    months = F.col("report_month").cast("string").between(*REPORT_MONTHS)
    some = FL.scan(spark, root, ["brand", "report_month", "revenue"], months)
    return as_report(some.groupBy("brand", F.col("report_month").cast("string").alias("report_month")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("revenue").cast("decimal(18,2)").alias("ggr")))


#: P1 on the financial fact.
P1_FINANCIAL = P.FilterSpec(client="ASIA", brand="PROMO", months=("2024-05", "2025-02"))

STREAM_QUERIES: dict[str, QueryFn] = {
    "w1_append_replace_fact": _w1_append_fact,
    "w7_csv_extract": _w7_csv_extract,
    "s7_range_scan": _s7_range_scan,
    "w8_multitab_report": _w8_multitab_report,
    "p1b_financial_filter": lambda s, d: as_report(P.filter_financial(_pa(s, d), P1_FINANCIAL).select(
        "id", "client", "brand", "report_month", "revenue", "bet")),
    "rep_full_financial_export": _report("full_financial_export", "brands"),
    "rep_player_master_list": _report("player_master_list", "players"),
    "rep_cohort_matrix": _report("cohort_matrix", "cohorts"),
    "rep_vip_churn_radar": _report("vip_churn_radar", "players"),
    "f13b_sketch_players": _f13b_sketch_players,
    "w5_upsert_by_key": _w5_upsert_by_key,
    "w4b_replace_client": _w4b_replace_client,
    "c18b_rename_cascade": _c18b_rename_cascade,
    "s2_duplicate_policy": _s2_duplicate_policy,
    "s1_financial_files": _s1_financial_files,
    "s1b_routed_formats": _s1b_routed_formats,
    "s11_quarantine": _s11_quarantine,
    "s3_campaign_files": _s3_campaign_files,
    "s4_ops_files": _s4_ops_files,
    "r1_stream_ops_ingest": _r1_stream_ingest,
    "r4_stream_event_pulse": _r4_event_pulse,
    "r5_journey_dedup": _r5_journey_dedup,
    "r5b_journey_dedup_stream": _r5_journey_dedup_stream,
    "r6_journey_funnel": lambda s, d: as_report(J.funnel(_events(s, d), _pa(s, d))),
    "r7_time_to_convert": lambda s, d: J.time_to_convert(_events(s, d)),
    "r7b_time_to_convert_histogram": lambda s, d: J.time_to_convert_histogram(_events(s, d)),
}


def all_queries() -> dict[str, QueryFn]:
    out: dict[str, QueryFn] = {}
    for block in (FIN_QUERIES, CRM_QUERIES, OPS_QUERIES, STREAM_QUERIES):
        out.update(block)
    return {**out, **{name: fn for name, (fn, _, _) in SPEAKING_QUERIES.items()}}


def all_oracles() -> dict[str, str]:
    from . import oracle_crm, oracle_fin, oracle_ops, oracle_stream
    out: dict[str, str] = {}
    for mod in (oracle_fin, oracle_crm, oracle_ops, oracle_stream):
        out.update(mod.ORACLES)
    for report, query in REPORT_QUERIES.items():
        out[report] = _in_report_months(out[query])
    for name, (_, query, fact) in SPEAKING_QUERIES.items():
        out[name] = _over(out[query], fact) if fact else out[query]
    return out


#: Reports and the queries that give the same rows over all months.
REPORT_QUERIES = {"rep_full_financial_export": "f5_monthly_brand_summary", "rep_player_master_list": "k1_player_master_list",
                  "rep_cohort_matrix": "k8_cohort_retention_matrix", "rep_vip_churn_radar": "k14_vip_churn_radar"}


def _over(sql: str, fact: str) -> str:
    """A query's SQL over another fact, a SELECT on ``player_activity_all``."""
    from .sqlkit import PLAYER_ACTIVITY
    head = f"WITH {PLAYER_ACTIVITY}"
    assert sql.startswith(head)
    whole = head.replace("player_activity AS (", "player_activity_all AS (")
    return f"{whole},\nplayer_activity AS ({fact}){sql[len(head):]}"


def _in_report_months(sql: str) -> str:
    return _over(sql, "SELECT * FROM player_activity_all WHERE report_month BETWEEN '{}' AND '{}'".format(*REPORT_MONTHS))


#: A fact with holes: a brand that misses months in the middle, one that ends early.
WITHOUT = "(brand = 'PROMO' AND substr(report_month, 6, 2) IN ('03', '04', '09')) OR (brand = 'ECONOMY' AND report_month >= '2025-08')"
#: Many small deposits for every second player.
SMALL_DEPOSITS = "CASE WHEN CAST(id AS BIGINT) % 2 = 0 THEN CAST(deposit_count * 10 AS DECIMAL(18,2)) ELSE deposits END"
GAP_FACT = f"SELECT * FROM player_activity_all WHERE NOT ({WITHOUT})"
FRICTION_FACT = f"SELECT * EXCLUDE (deposits), {SMALL_DEPOSITS} AS deposits FROM player_activity_all"


def _gappy(spark, sf_dir):
    return _pa(spark, sf_dir).where(f"NOT ({WITHOUT})")


def _reparse_damaged(spark, sf_dir):
    """C19 on rows whose fields were lost: every third day the parsed fields are UNKNOWN and are
    read again from the name."""
    ops = _ops(spark, sf_dir)
    lost = F.dayofmonth("ops_date") % 3 == 0
    for c in ("extracted_lifecycle", "extracted_engagement"):
        ops = ops.withColumn(c, F.when(lost, F.lit("UNKNOWN")).otherwise(F.col(c)))
    return C.reparse_unknown(ops.withColumn("campaign", O.raw_campaign(None)), "campaign").select(
        "campaign_name", "extracted_lifecycle", "extracted_engagement")


#: Queries over data that shows what the given tables cannot, each with the one it repeats.
SPEAKING_QUERIES: dict[str, tuple[QueryFn, str, str | None]] = {
    "f4b_month_padding_gaps": (lambda s, d: as_report(FIN.monthly_brand_summary(_stored(_gappy(s, d)), include_combined=False, whales=False).select(
        "brand", "month", "total_players", "ggr", "new_players")), "f4_month_padding", GAP_FACT),
    "q1b_registry_gaps": (lambda s, d: Q.registry_gaps(_gappy(s, d)), "q1_registry_gaps", GAP_FACT),
    "q2b_compliance_grid": (lambda s, d: Q.compliance_grid(_gappy(s, d)), "q2_compliance_grid", GAP_FACT),
    "q5b_ops_completeness": (lambda s, d: as_report(Q.ops_completeness(_ops(s, d), _gappy(s, d))), "q5_ops_completeness", GAP_FACT),
    "k18b_payment_friction": (lambda s, d: as_report(K.payment_friction(K.smart_profiles(
        _pa(s, d).withColumn("deposits", F.expr(SMALL_DEPOSITS))))), "k18_payment_friction", FRICTION_FACT),
    "c19b_reparse_damaged": (_reparse_damaged, "c19_reparse_unknown", None),
}
