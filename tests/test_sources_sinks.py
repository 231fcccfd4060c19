import datetime as dt
import os

from pyspark.sql import functions as F

from ledgerline import sinks
from ledgerline.sources import dims, files
from ledgerline.sources import testdata as TD

from conftest import SF_SMALL


def _write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(text.encode(encoding))


def test_detailed_csv_edge_cases(spark, tmpdir_path):
    hdr = list(files.DETAILED_HEADERS) + ["Bonus Cost (Total)  €"]
    rows = [
        ["p1", "", "WB", "100.50", "10.25", "9", "DK", "50", "5", "4", "50.5", "5.25", "5", "2", "30", "0", "1", "1",
         "0.5", "03/03/2025", "01/03/2025", "2"],
        ["", "Lumen Vale", "WB", "1", "1", "1", "DK", "0", "0", "0", "0", "0", "0", "0", "0", "0", "0", "0", "0", "", "", "0"],
        ["p3", "Other", "RND", "abc", "-2", "-2", "SE", "0", "0", "0", "0", "0", "0", "1", "5", "0", "0", "0", "0",
         "31/02/2025", "01/02/2025", "0"],
    ]
    text = "﻿" + ",".join(f'"{h}"' for h in hdr) + "\n" + "\n".join(",".join(r) for r in rows) + "\n"
    path = f"{tmpdir_path}/lm/lm_2025_03.csv"
    _write(path, text)
    mapping = dims.client_mapping(spark)
    df = files.load_financial_files(spark, [path], mapping, "detailed", "LM")
    got = {r.id: r for r in df.collect()}
    assert set(got) == {"p1", "p3"}                       # blank id dropped
    p1 = got["p1"]
    assert p1.brand == "Lumen Vale" and p1.client == "Northwind Gaming"   # blank brand → target brand
    assert float(p1.bet) == 100.5 and float(p1.bonus_total) == 2.0 and p1.report_month == "2025-03"
    assert p1.reactivation_days == 2
    p3 = got["p3"]
    assert float(p3.bet) == 0.0                            # text in a numeric cell → 0
    assert p3.reactivation_date is None and p3.reactivation_days is None   # 31/02/2025 → null


def test_latin1_fallback_and_basic_format(spark, tmpdir_path):
    hdr = ",".join(files.BASIC_HEADERS)
    body = "p1,Café Bet,WB,10,8,2\n"
    path = f"{tmpdir_path}/lt/lt_2025_04.csv"
    _write(path, hdr + "\n" + body, encoding="iso-8859-1")
    assert files.files_needing_latin1(spark, [path]).count() == 1
    df = files.load_financial_files(spark, [path], dims.client_mapping(spark), "basic", "LT")
    r = df.collect()[0]
    assert r.country == "Global" and float(r.ngr) == float(r.revenue) == 2.0 and r.report_month == "2025-04"
    assert files.load_financial_files(spark, [path], dims.client_mapping(spark), "unknown-format", "LT") is None


def test_filename_parsing(spark):
    names = ["quartz_2025_08.csv", "2026-02 cobalt.xlsx", "Acme Winback - Jan '26 report.xls", "nothing.csv"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    b, m = files.brand_month_from_filename(F.col("n"), month_name_brand="acme")
    got = [(r.b, r.m) for r in df.select(b.alias("b"), m.alias("m")).collect()]
    assert got == [("quartz", "2025-08"), ("cobalt", "2026-02"), ("acme", "2026-01"), (None, None)]
    d = spark.createDataFrame([("ops_2026_02_14.csv",), ("ops 2026-02.csv",)], "n string")
    assert [r[0] for r in d.select(files.date_from_filename(F.col("n"))).collect()] == [
        dt.date(2026, 2, 14), dt.date(2026, 2, 1)]


def test_ops_file_load_and_records_fallback(spark, tmpdir_path):
    p1 = f"{tmpdir_path}/ops/daily_2026_03_25.csv"
    _write(p1, '"Campaign Name",New Data,Calls,KPI1-Conv.,Cost SIP\nLM-DK-WB-NLI-2026-03-20,10,5,2,1.5\n')
    p2 = f"{tmpdir_path}/ops2/daily_2026_03_26.csv"
    _write(p2, "Campaign Name,# Records,Calls\nRJ-TR-RND-LI,7,3\n")
    a = files.load_ops_files(spark, [p1], dims.client_mapping(spark)).collect()[0]
    assert a.records == 10 and a.ops_client == "Northwind Gaming" and a.campaign_data_age_days == 5
    assert a.true_cac == 0.75 and str(a.ops_date) == "2026-03-25"
    b = files.load_ops_files(spark, [p2], dims.client_mapping(spark)).collect()[0]
    assert b.records == 7 and b.campaign_data_age_days == -1     # '# Records' when 'New Data' is absent


def test_duplicate_policy(spark):
    new = spark.createDataFrame([("X", "2025-01", 1), ("X", "2025-02", 2)], "brand string, report_month string, v int")
    have = spark.createDataFrame([("X", "2025-01")], "brand string, report_month string")
    assert files.apply_duplicate_policy(new, have, False).count() == 1
    assert files.apply_duplicate_policy(new, have, True).count() == 2


def test_dynamic_partition_replace_and_upsert(spark, tmpdir_path):
    path = f"{tmpdir_path}/fact"
    a = spark.createDataFrame([("2025-01", 1), ("2025-02", 2)], "m string, v int")
    sinks.replace(a, path, ["m"])
    sinks.replace_partitions(spark.createDataFrame([("2025-02", 20)], "m string, v int"), path, ["m"])
    got = sorted((r.m, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("2025-01", 1), ("2025-02", 20)]
    up = f"{tmpdir_path}/dim"
    sinks.upsert(spark, spark.createDataFrame([("c1", 1, "a")], "k string, ver int, x string"), up, ["k"], "ver")
    sinks.upsert(spark, spark.createDataFrame([("c1", 2, "b"), ("c2", 1, "z")], "k string, ver int, x string"),
                 up, ["k"], "ver")
    cur = sinks.current_version(spark, up)
    assert sorted((r.k, r.x) for r in spark.read.parquet(cur).collect()) == [("c1", "b"), ("c2", "z")]


def test_materialized_facts_round_trip(spark, tmpdir_path):
    facts = sinks.materialize_facts(spark, SF_SMALL, tmpdir_path)
    direct = TD.player_activity(spark, SF_SMALL)
    assert facts["player_activity"].count() == direct.count()
    assert facts["player_activity"].exceptAll(direct.select(*facts["player_activity"].columns)).count() == 0
    assert facts["ops_snapshots"].count() >= facts["ops_daily"].count()


def test_merge_daily_sources(spark, tmpdir_path):
    p1 = f"{tmpdir_path}/box1.csv"
    p2 = f"{tmpdir_path}/box2.csv"
    _write(p1, "Export box 1\nCampaign Name,New Data\nA-1,3\n,\n")
    _write(p2, "Export box 2\nCampaign Name,Calls\nB-1,4\n")
    m = files.merge_daily_sources(spark, [p1, p2])
    got = sorted((r["Campaign Name"], r["New Data"], r["Calls"]) for r in m.collect())
    assert got == [("A-1", "3", None), ("B-1", None, "4")]


def test_campaign_file_load_s3(spark, tmpdir_path):
    p = f"{tmpdir_path}/camp/lumen_2025_05.csv"
    _write(p, "brand,Campaign,Records,KPI 1 - Conversions,KPI 2 - Logins,Calls,ES,SS\n"
              "  lumen vale ,LI,10,1,5,3,x,2\n")
    r = files.load_campaign_files(spark, [p]).collect()[0]
    assert r.brand == "Lumen Vale" and r.report_month == "2025-05"      # case-insensitive header, initcap(trim)
    assert (r.records, r.kpi1_conversions, r.kpi2_logins, r.emails_sent) == (10, 1, 5, 0)   # bad number → 0


def test_sheet_cohort_adapter_t4(spark):
    raw = spark.createDataFrame([
        ("p1", "ROC - Feb 2025", "100", "90", "40", "3"), ("p2", "ONT-React", "10", "9", "4", "1"),
        ("p3", "React", "1", "1", "1", "0"), (None, "React", "5", "5", "5", "5")],
        "`Player Id` string, sheet_name string, `Total GGR €` string, `Total NGR €` string, `Deposits €` string, "
        "`Deposits #` string").withColumn("_file", F.lit("x.parquet")).withColumn("report_month", F.lit("2025-02"))
    got = {r.id: r for r in files.adapt_sheet_cohort(raw, "Yuzu Spins", "Harbor Play").collect()}
    assert set(got) == {"p1", "p2", "p3"}
    assert got["p1"].country == "CA-ROC" and got["p1"].segment == "ROC" and got["p1"].wb_tag == "ROC - Feb 2025"
    assert got["p2"].country == "CA-ONT" and float(got["p1"].deposits) == 40.0 and float(got["p1"].bet) == 0.0
    assert got["p3"].segment == "React" and got["p3"].country == "Global"


def test_report_sinks_w8_w9(spark, tmpdir_path):
    from ledgerline.operators import financial as FIN
    pa = TD.player_activity(spark, SF_SMALL)
    summ = FIN.monthly_brand_summary(pa)
    out = sinks.write_multitab_report({"brands": FIN.as_report(summ), "segments": FIN.as_report(FIN.segmentation(pa))},
                                      f"{tmpdir_path}/report")
    back = spark.read.parquet(out["brands"])
    assert back.count() == summ.count() and "month_label" in back.columns
    lbl = back.select("month", "month_label").first()
    assert lbl.month_label.endswith(lbl.month[:4])
    reg = sinks.registry_table(pa)
    assert reg.count() == pa.select("brand", "report_month").distinct().count()


def test_pretty_month_and_heal_date(spark):
    from ledgerline.functions import campaign as C
    from ledgerline.functions import core
    r = spark.createDataFrame([("2025-08", "2025_03_01")], "m string, d string").select(
        core.pretty_month("m").alias("p"), F.to_date(C.heal_ops_date("d")).alias("d")).first()
    assert r.p == "August 2025" and str(r.d) == "2025-03-01"


def _write(path, text, encoding="utf-8"):
    import os
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as f:
        f.write(text)
    return path


def test_files_of_mixed_headers_encodings_and_equal_names(spark, tmpdir_path):
    from ledgerline.sources.files import read_csv_any_encoding
    files = [_write(f"{tmpdir_path}/x/day.csv", "Campaign Name,Calls,New Data\ncaf\u00e9,70,3\n", "latin-1"),
             _write(f"{tmpdir_path}/y/day.csv", "Campaign Name,New Data,Calls\nb,30,7\n"),
             _write(f"{tmpdir_path}/my day.csv", "Campaign Name,# Records,Calls\nc,5,1\n"),
             _write(f"{tmpdir_path}/empty.csv", "")]
    got = {r["Campaign Name"]: (r["New Data"], r["Calls"], r["# Records"]) for r in read_csv_any_encoding(spark, files).collect()}
    assert got == {"caf\u00e9": ("3", "70", None), "b": ("30", "7", None), "c": (None, "1", "5")}
    assert read_csv_any_encoding(spark, files[3:]).count() == 0


def test_upsert_tie_takes_the_new_row(spark):
    from ledgerline.sources.files import upsert_latest
    old = spark.createDataFrame([("k", 1, "old"), ("l", 5, "old")], "id string, v int, x string")
    new = spark.createDataFrame([("k", 1, "new"), ("l", 4, "new")], "id string, v int, x string")
    assert {r.id: r.x for r in upsert_latest(new, old, ["id"], "v").collect()} == {"k": "new", "l": "old"}


def test_merge_daily_sources_keeps_body_lines_equal_to_the_header(spark, tmpdir_path):
    from ledgerline.sources.files import merge_daily_sources
    p = _write(f"{tmpdir_path}/a.csv", "Title\nA,B\n1,2\nA,B\n3,4\n")
    assert sorted(r.A for r in merge_daily_sources(spark, [p]).collect()) == ["1", "3", "A"]


def test_campaign_files_of_brands_without_letters_and_equal_letters(spark, tmpdir_path):
    """Every brand has a file of its own and comes back: digits alone, equal letters, escapes, none."""
    brands = ["365", "A-B", "AB", "a/b %2F", "Ünal", " ", "", None]
    cm = spark.createDataFrame([(b, "LI", i, 1, 1, 1, 1, 1, "2025-03") for i, b in enumerate(brands)],
                               "brand string, campaign_type string, records long, kpi1_conversions long, kpi2_logins long, "
                               "calls long, emails_sent long, sms_sent long, report_month string")
    paths = files.export_campaign_monthly(cm, f"{tmpdir_path}/c")
    assert len(paths) == 6  # no brand, an empty and a blank one are the same file
    got = files.load_campaign_files(spark, paths).collect()
    assert sorted(r.records for r in got) == list(range(8)) and {r.report_month for r in got} == {"2025-03"}
    named = spark.createDataFrame([(p.rsplit("/", 1)[1],) for p in paths], "f string")
    key, month = files.brand_month_from_filename(F.col("f"))
    assert {r.k for r in named.select(key.alias("k"), month.alias("m")).collect()} == {"365", "a-b", "ab", "a/b %2f", "ünal", ""}


def test_routed_directory_and_quarantine(spark, tmpdir_path):
    from ledgerline.sources import routing
    mapping = spark.createDataFrame([("LM", "Lumen Vale", "North", "detailed"), ("LT", "Lattice Bet", "Harbor", "basic"),
                                     ("YZ", "Yuzu", "Harbor", "sheet_cohort"), ("KO", "Kobalt", "Orchid", "Standard")],
                                    "brand_code string, brand_name string, client_name string, financial_format string")
    d = tmpdir_path
    paths = [
        _write(f"{d}/a/lm_2025_02.csv", "Player Key,Brand,Segment,GGR (Total) €\n1,,VIP,10\n2,Own,VIP,5,spoilt\n ,x,y,1\n3\n4,Own,,x\n"),
        _write(f"{d}/b/2025-03 Lattice Bet.csv", "Player unique identifier,Brand,WB tag/flag,Bet,Win,Revenue\n7,zz,T,100,90,10\nnan,zz,T,1,1,1\n"),
        _write(f"{d}/c/lt_2025_04.csv", "Player unique identifier,Brand,Bet\n7,zz,1\n"),
        _write(f"{d}/d/yz_2025_02.csv", "Player Id,sheet_name,Total GGR €,Total NGR €,Deposits €,Deposits #\n9,ROC - Feb,3,2,1,4\n"),
        _write(f"{d}/e/ko_2025_02.csv", "Player Key,Brand\n1,k\n2,k\n"),
        _write(f"{d}/f/notes.csv", "Player Key,Brand\n1,k\n"),
        _write(f"{d}/g/lm_2025_05.csv", ""),
        _write(f"{d}/h/lm_2025_06.csv", "Player Key,Brand,Segment\ncafé,,Old\n", "latin-1")]
    good, bad = routing.route_financial_files(spark, paths, mapping)
    got = {(r.id, r.brand, r.client, r.report_month, r.segment, float(r.revenue), r.format) for r in good.collect()}
    assert got == {("1", "Lumen Vale", "North", "2025-02", "VIP", 10.0, "detailed"), ("4", "Own", "North", "2025-02", "Unknown", 0.0, "detailed"),
                   ("café", "Lumen Vale", "North", "2025-06", "Old", 0.0, "detailed"),
                   ("7", "Lattice Bet", "Harbor", "2025-03", "T", 10.0, "basic"), ("9", "Yuzu", "Harbor", "2025-02", "ROC", 3.0, "sheet_cohort")}
    rejected = sorted((r.file, r.reason) for r in bad.collect())
    assert rejected == sorted([("lm_2025_02.csv", "malformed line")] * 2 + [("lm_2025_02.csv", "no player id"), ("2025-03 Lattice Bet.csv", "no player id"),
                              ("lt_2025_04.csv", "missing headers"), ("ko_2025_02.csv", "unknown format"), ("ko_2025_02.csv", "unknown format"),
                              ("notes.csv", "file name")])
    assert {r.line for r in bad.where("reason = 'malformed line'").collect()} == {"2,Own,VIP,5,spoilt", "3"}
    assert good.count() + bad.count() == 13  # all lines but headers
    routing.load_with_quarantine(spark, paths, mapping, f"{d}/good", f"{d}/rejected")
    assert spark.read.parquet(f"{d}/good").count() == 5 and spark.read.parquet(f"{d}/rejected").count() == 8
    empty_good, empty_bad = routing.route_financial_files(spark, paths[6:7], mapping)
    assert empty_good.count() == 0 and empty_bad.count() == 0


def test_merge_daily_sources_of_many_files(spark, tmpdir_path):
    """Several layouts, a file of one line, empty files, and no line at all."""
    from ledgerline.sources.files import daily_layouts, merge_daily_sources
    paths = [_write(f"{tmpdir_path}/{i}.csv", f"Title {i}\nA,B\n{i},x\n,\nTitle {i},y\n") for i in range(12)]
    paths += [_write(f"{tmpdir_path}/z{i}.csv", f"Export\n﻿B,\"C,c\"\nq,\"{i},1\"\n") for i in range(3)]
    nothing = [_write(f"{tmpdir_path}/e.csv", ""), _write(f"{tmpdir_path}/t.csv", "Title only\n")]
    assert {h: len(p) for h, p in daily_layouts(spark, paths + nothing).items()} == {"A,B": 12, "﻿B,\"C,c\"": 3}
    got = sorted((r.A or "", r.B or "", r["C,c"] or "") for r in merge_daily_sources(spark, paths + nothing).collect())
    assert got == sorted([(str(i), "x", "") for i in range(12)] + [(f"Title {i}", "y", "") for i in range(12)] + [("", "q", f"{i},1") for i in range(3)])
    empty = merge_daily_sources(spark, nothing)
    assert empty.count() == 0 and empty.columns == []
