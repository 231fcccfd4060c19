import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import ops as O
from ledgerline.operators import quality as Q
from ledgerline.sources import testdata as TD

from conftest import SF_SMALL


def _pulse(spark, rows):
    return spark.createDataFrame(rows, "ops_date date, extracted_engagement string, total_records long, "
                                       "total_conversions long, total_logins long")


def test_pulse_windows_mean_of_daily_capped_pct(spark):
    end = dt.date(2026, 3, 31)
    rows = []
    for i in range(95):
        d = end - dt.timedelta(days=i)
        if i == 3:
            rows.append((d, "NLI", 0, 5, 0))        # records 0 → pct 0
        elif i == 4:
            rows.append((d, "NLI", 10, 20, 1))      # conversions > records → capped at 100
        else:
            rows.append((d, "NLI", 100, 10, 5))
    w = {r.window_days: r for r in O.pulse_windows(_pulse(spark, rows)).collect()}
    seven = w[7]
    assert seven.volume_current == 100 * 5 + 0 + 10
    assert abs(seven.conv_pct_current - round((10 * 5 + 0 + 100) / 7, 6)) < 1e-9
    assert seven.volume_prior == 700
    assert w[90].volume_prior == 100 * 5  # only 5 days remain beyond day 90


def test_variance_rules(spark):
    v = spark.createDataFrame([(0.0, 0.0), (5.0, 0.0), (100.5, 100.0), (140.0, 100.0)], "v double, b double")
    got = [r[0] for r in v.select(O._variance(F.col("v"), F.col("b"))).collect()]
    assert got == [0.0, 1.0, 0.0, 0.4]


def test_completeness_status(spark):
    days = ([dt.date(2025, 1, d) for d in range(1, 32)] + [dt.date(2025, 2, d) for d in range(1, 27)]
            + [dt.date(2025, 3, d) for d in range(1, 22)] + [dt.date(2025, 4, d) for d in range(1, 10)])
    ops = spark.createDataFrame([(d, 1, 1, 1, 1) for d in days],
                                "ops_date date, records long, kpi2_logins long, conversions long, calls long")
    got = {r.month: r.ops_status for r in Q.ops_completeness(ops, as_of="2025-04-10").collect()}
    assert got["2025-01"] == "Complete"
    assert got["2025-02"] == "Warning (26/28 days)"
    assert got["2025-03"] == "Partial (21/31 days)"
    assert got["2025-04"] == "Complete"  # current month: expected day − 1 = 9


def test_date_gaps_find_inner_holes(spark):
    ops = spark.createDataFrame([(dt.date(2025, 1, d),) for d in (1, 2, 5, 6)], "ops_date date")
    assert sorted(r.ops_date.day for r in Q.date_gaps(ops).collect()) == [3, 4]


def test_ops_fact_invariants(spark):
    ops = TD.ops_daily(spark, SF_SMALL)
    pulse = O.daily_pulse(ops)
    total = ops.where(F.col("extracted_engagement").isNotNull()).agg(F.sum("records")).first()[0]
    assert pulse.agg(F.sum("total_records")).first()[0] == total
    # the key is unique per row
    assert ops.select("campaign_name").distinct().count() == ops.count()


def test_short_name_aggregator(spark):
    ops = spark.createDataFrame([
        ("LM-WBD-DK-NLI-New_2026-03-01", 5), ("LM-WB-DK-NLI-2026-03-02_2026-03-02", 7),
        ("lm-DK-LI-RND_2026-03-01", 100), ("YU-JP-CAS-RND-MAR_2026-03-01", 3), ("X_2026-03-01", 1)],
        "campaign_name string, records long")
    got = {r.short_name: r.total for r in O.short_name_totals(ops).collect()}
    assert got == {"LM-DK-WB": 12, "YU-JP-RND": 3}


def test_latest_snapshot_per_key(spark):
    snaps = spark.createDataFrame([
        ("c1", dt.date(2025, 1, 1), 10, dt.datetime(2025, 1, 2, 0)),
        ("c1", dt.date(2025, 1, 1), 12, dt.datetime(2025, 1, 9, 0)),
        ("c2", dt.date(2025, 1, 1), 5, dt.datetime(2025, 1, 2, 0))],
        "campaign_name string, ops_date date, records long, snapshot_timestamp timestamp")
    got = {r.campaign_name: r.records for r in O.latest_snapshots(snaps).collect()}
    assert got == {"c1": 12, "c2": 5}


def test_strict_gap_check(spark):
    from conftest import pa_frame
    import pytest
    pa = pa_frame(spark, [("a", "X", "2025-01", 1.0), ("a", "X", "2025-03", 1.0), ("b", "Y", "2025-02", 1.0)])
    gaps = sorted((r.brand, r.report_month) for r in Q.registry_gaps(pa).collect())
    assert gaps == [("X", "2025-02"), ("Y", "2025-01"), ("Y", "2025-03")]
    with pytest.raises(ValueError):
        Q.assert_no_gaps(pa)


def _ops_rows(spark, rows):
    """(client, lifecycle, engagement, ops_date, records, conversions, logins) → ops-shaped frame."""
    from ledgerline.functions.core import MONEY
    cols = ["d_plus", "d_minus", "d_neutral", "na", "t", "dnc", "dx", "wn", "am", "es", "ed", "eo", "ec", "ef",
            "sd", "sf", "sp", "calls"]
    df = spark.createDataFrame(rows, "ops_client string, extracted_lifecycle string, extracted_engagement string, "
                                     "ops_date date, records long, conversions long, kpi2_logins long")
    for c in cols:
        df = df.withColumn(c, F.lit(0).cast("bigint"))
    return (df.withColumn("total_cost", F.lit(0).cast(MONEY))
            .withColumn("campaign_name", F.concat_ws("-", "ops_client", "extracted_lifecycle", F.col("ops_date").cast("string"))))


def test_half_over_half_scaling_truncates(spark):
    rows = [("C", "WB", "NLI", dt.date(2025, 1, 1) + dt.timedelta(days=i), 10, 1, 2) for i in range(3)]      # H1: 3 days
    rows += [("C", "WB", "NLI", dt.date(2025, 7, 1) + dt.timedelta(days=i), 7, 1, 1) for i in range(2)]      # H2: 2 days
    got = {r.metric: r for r in O.half_over_half(_ops_rows(spark, rows)).collect()}
    rec = got["Records"]
    assert rec.current_half == "H2 2025" and rec.prior_half == "H1 2025"
    assert rec.current == 14.0 and rec.prior == 20.0            # int(30 × 2/3) = 20
    assert abs(rec.change - (14 - 20) / 20 * 100) < 1e-9 and rec.change_unit == "pct"


def test_volume_90d_bulk_note_and_total(spark):
    end = dt.date(2025, 4, 30)
    rows = [("A", "WB", "NLI", end - dt.timedelta(days=i), 9, 0, 0) for i in range(90)] + [("A", "WB", "NLI", end, 1, 0, 0)]
    rows += [("B", "RND", "NLI", end - dt.timedelta(days=i), 1, 0, 0) for i in range(1, 10)]
    got = {r.client: r for r in O.volume_90d(_ops_rows(spark, rows)).collect()}
    assert got["A"].avg_90d == 811 / 90 and got["A"].latest_day == 10.0 and got["A"].note == ""
    assert got["B"].latest_day == 0.0 and got["B"].note == "Bulk campaigns"     # −100 %
    assert got["Total"].avg_90d == (811 + 9) / 90


def test_sla_breach_and_pacing(spark):
    sla = spark.createDataFrame([("C", "WB", 300), ("C", "RND", 30)],
                                "client_name string, lifecycle string, monthly_minimum_records int")
    rows = [("C", "WB", "NLI", dt.date(2025, 3, d), 5, 0, 0) for d in range(1, 11)]           # 10 days, 50 records
    rows += [("C", "RND", "NLI", dt.date(2025, 3, d), 2, 0, 0) for d in range(1, 11)]         # 20 records
    br = {r.lifecycle: r for r in O.sla_breaches(_ops_rows(spark, rows), sla).collect()}
    assert br["WB"].pro_rated_target == 100.0 and br["WB"].breach            # 300 / 30 × 10
    assert br["RND"].pro_rated_target == 10.0 and not br["RND"].breach
    pace = O.sla_pacing(_ops_rows(spark, rows), sla).collect()[0]
    assert pace.mtd_records == 70 and abs(pace.pacing - 70 / (330 / 30 * 10)) < 1e-12 and pace.status == "under"


def test_daily_efficiency_lines(spark):
    """One client with one signature gets its targets; its SLA line is brand ALL only."""
    day = dt.date(2025, 1, 3)
    rows = [("A", "x-DK", day, 10, 5, 1, 20, 0.5), ("A", "x-DK", dt.date(2025, 1, 4), 30, 0, 0, 3, None),
            ("B", "y-DK", day, 0, 1, 1, 1, 0.1), ("B", "z-DK", day, 4, 1, 1, 1, 0.3)]
    latest = spark.createDataFrame(rows, "ops_client string, campaign_name string, ops_date date, records long, calls long, "
                                         "conversions long, kpi2_logins long, li_pct double")
    sla = spark.createDataFrame([("A", "ALL", "WB", 60), ("A", "Q", "WB", 999), ("B", "Q", "WB", 5)],
                                "client_name string, brand_code string, lifecycle string, monthly_minimum_records int")
    targets = spark.createDataFrame([("x-DK", 0.25, 0.5)], "campaign_signature string, target_conv_pct double, target_li_pct double")
    got = {(r.client, r.ops_date.day): r for r in O.daily_efficiency(latest, sla, targets).collect()}
    a, b, both = got["A", 3], got["B", 3], got["All", 3]
    assert (a.records, a.calls, a.conv_pct, a.login_pct, a.mean_volume, a.sla_minimum, a.target_conv_pct, a.target_li_pct) \
        == (10, 5, 10.0, 100.0, 20.0, 2.0, 25.0, 50.0)
    assert (b.records, b.li_pct_mean, b.sla_minimum, b.target_conv_pct) == (4, 20.0, None, None)
    assert (both.records, both.li_pct_mean, both.sla_minimum, both.mean_volume) == (14, 30.0, None, 22.0)
    assert got["A", 4].li_pct_mean is None
