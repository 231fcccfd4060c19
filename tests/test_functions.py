import datetime as dt

from pyspark.sql import functions as F

from ledgerline.functions import campaign as C
from ledgerline.functions import core


def _parse(spark, names, ops_date="2026-03-30"):
    df = spark.createDataFrame([(n, dt.date.fromisoformat(ops_date)) for n in names], "campaign string, ops_date date")
    return {r.campaign: r for r in C.parse_campaign(df, "campaign", "ops_date").collect()}


def test_full_convention_name(spark):
    r = _parse(spark, ["LM-DK-DA-CAS-HIGH-WB-J1-NLI-2026-03-24"])["LM-DK-DA-CAS-HIGH-WB-J1-NLI-2026-03-24"]
    assert r.tag == "LM"
    assert (r.extracted_lifecycle, r.extracted_segment, r.extracted_engagement) == ("WB", "HIGH", "NLI")
    assert (r.extracted_product, r.extracted_sublifecycle) == ("CAS", "J1")
    assert r.country == "DK" and r.extracted_language == "DA"
    assert r.campaign_data_age_days == 6


def test_wbd_underscore_and_blank_tokens(spark):
    p = _parse(spark, ["lm_wbd_dk_nli_new", "BHL--TR-RND", "XX", "", "ZZ-ONT-NA-LI"])
    a = p["lm_wbd_dk_nli_new"]
    assert a.tag == "LM" and a.extracted_lifecycle == "WB" and a.country == "DK"
    assert a.extracted_engagement == "NLI"
    b = p["BHL--TR-RND"]
    assert b.tag == "BHL" and b.country == "TR" and b.extracted_lifecycle == "RND"
    assert b.extracted_language == "TR"
    x = p["XX"]
    assert x.tag == "XX" and x.country == "Global" and x.extracted_lifecycle == "UNKNOWN"
    e = p[""]
    assert e.tag == "UNKNOWN" and e.country == "Global"
    z = p["ZZ-ONT-NA-LI"]
    # NA is a segment word, never a country; ONT is a 3-letter region → EN
    assert z.country == "ONT" and z.extracted_segment == "NA" and z.extracted_language == "EN"
    assert z.campaign_data_age_days is None


def test_signatures(spark):
    df = spark.createDataFrame([("A_B_2026_03_24",), ("A-B-24MAR2026",), ("A-B-2026-03",), ("A-B",),
                                ("X-Y_2026-03-24",)], "campaign_name string")
    out = {r.campaign_name: r for r in df.select(
        "campaign_name", C.core_signature("campaign_name").alias("core"),
        C.campaign_signature("campaign_name").alias("sig")).collect()}
    assert out["A_B_2026_03_24"].core == "A_B"
    assert out["A-B-24MAR2026"].core == "A-B"
    assert out["A-B-2026-03"].core == "A-B"
    assert out["A-B"].core == "A-B"
    # Cut at the last '_' only when the raw name holds one
    assert out["A_B_2026_03_24"].sig == "A_B_2026_03"
    assert out["X-Y_2026-03-24"].sig == "X-Y"
    assert out["A-B-2026-03"].sig == "A-B-2026-03"


def test_display_lifecycle(spark):
    df = spark.createDataFrame([("LM-WB-RND",), ("LM-WB",), ("LMRND",)], "s string")
    got = [r[0] for r in df.select(C.display_lifecycle("s")).collect()]
    assert got == ["RND", "WB", "UNKNOWN"]


def test_safe_pct_zero_denominators(spark):
    df = spark.createDataFrame([(5.0, 0.0), (0.0, 0.0), (1.0, 4.0), (None, 2.0)], "n double, d double")
    got = [r[0] for r in df.select(core.safe_pct("n", "d")).collect()]
    assert got == [0.0, 0.0, 25.0, 0.0]


def test_completed_weeks_cutoff(spark):
    """Ported weekly-date case: string dates parsed to dates, then ≤ cutoff keeps 2 of 3."""
    df = spark.createDataFrame([("2026-03-24",), ("2026-03-25",), ("2026-03-26",)], "d string")
    kept = df.where(F.to_date("d") <= F.to_date(F.lit("2026-03-25"))).count()
    assert kept == 2


def test_week_start_and_last_thursday(spark):
    days = [dt.date(2026, 3, 1) + dt.timedelta(days=i) for i in range(21)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for r in df.select("d", core.week_start_friday("d").alias("ws"), core.last_thursday("d").alias("lt")).collect():
        assert r.ws.weekday() == 4 and 0 <= (r.d - r.ws).days < 7
        assert r.lt.weekday() == 3 and 0 <= (r.d - r.lt).days < 7


def test_month_helpers(spark):
    df = spark.createDataFrame([("2025-08",), ("2024-12",)], "m string")
    got = df.select(core.month_from_index(core.month_index("m") + 1).alias("n"), core.pretty_month("m").alias("p"),
                    core.quarter_label("m").alias("q")).collect()
    assert [(r.n, r.p, r.q) for r in got] == [("2025-09", "August 2025", "2025Q3"), ("2025-01", "December 2024", "2024Q4")]


def test_half_labels(spark):
    df = spark.createDataFrame([(dt.date(2025, 6, 30),), (dt.date(2025, 7, 1),)], "d date")
    got = [r[0] for r in df.select(core.half_label("d")).collect()]
    assert got == ["H1 2025", "H2 2025"]
