import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import ops as O
from ledgerline.streaming import journey as J
from ledgerline.streaming import ops_stream as S
from ledgerline.sources import testdata as TD

from conftest import SF_SMALL


def _raw(spark, rows):
    cols = [c.split()[0] for c in S.RAW_OPS_SCHEMA.split(", ")]
    full = []
    for camp, d, rec in rows:
        vals = {c: 0 for c in cols}
        vals.update(campaign=camp, ops_date=d, records=rec, _price=None)
        full.append(tuple(vals[c] for c in cols))
    return spark.createDataFrame(full, S.RAW_OPS_SCHEMA)


def test_stream_ingest_late_rows_and_restart(spark, tmpdir_path):
    src, out, chk = f"{tmpdir_path}/in", f"{tmpdir_path}/out", f"{tmpdir_path}/chk"
    _raw(spark, [("LM-DK-WB-NLI", dt.date(2026, 3, 1), 5), ("LM-DK-WB-NLI", dt.date(2026, 3, 20), 6)]) \
        .coalesce(1).write.parquet(f"{src}/b1")
    S.run_available(S.start_ops_ingest(spark, src, out, chk))
    live = spark.read.parquet(f"{out}/ops_live")
    assert live.count() == 2
    # second delivery: one late row (> 14 days before the newest accepted day; live and audit copy),
    # one re-delivery of 03-20 with new numbers, one new day
    _raw(spark, [("LM-DK-WB-NLI", dt.date(2026, 3, 2), 9), ("LM-DK-WB-NLI", dt.date(2026, 3, 20), 60),
                 ("LM-DK-WB-NLI", dt.date(2026, 3, 21), 7)]).coalesce(1).write.parquet(f"{src}/b2")
    S.run_available(S.start_ops_ingest(spark, src, out, chk))      # restart: only the new file is read
    live = {(str(r.ops_date), r.records) for r in spark.read.parquet(f"{out}/ops_live").collect()}
    assert live == {("2026-03-01", 5), ("2026-03-02", 9), ("2026-03-20", 60), ("2026-03-21", 7)}
    late = [(str(r.ops_date), r.records) for r in spark.read.parquet(f"{out}/ops_late").collect()]
    assert late == [("2026-03-02", 9)]
    assert spark.read.parquet(f"{out}/ops_snapshots").count() == 5   # every delivery logged once


def test_live_table_any_file_order(spark, tmpdir_path):
    """One file per trigger, days far apart and newest first: nothing is lost."""
    src, out = f"{tmpdir_path}/in", f"{tmpdir_path}/out"
    for n, day in enumerate([dt.date(2026, 3, 20), dt.date(2025, 1, 5), dt.date(2026, 3, 1)]):
        _raw(spark, [("AB-DK-WB-NLI", day, n), ("AB-SE-WB-NLI", day, n)]).coalesce(1).write.parquet(f"{src}/b{n}")
    S.run_available(S.start_ops_ingest(spark, src, out, f"{tmpdir_path}/chk", max_files_per_trigger=1))
    assert spark.read.parquet(f"{out}/ops_live").count() == 6


def test_duplicate_key_dropped_campaign_and_replay(spark, tmpdir_path):
    out = tmpdir_path
    day = dt.date(2026, 3, 20)
    fn = S.ops_sink_batch(f"{out}/live", f"{out}/snap", f"{out}/late")

    def batch(*rows):
        parts = [S.parse_stream(_raw(spark, [(c, day, n)])).withColumn(
            "delivery", F.struct(F.lit("box").alias("source"), F.lit(str(at)).alias("at"), F.lit(file).alias("file")))
            for c, n, at, file in rows]
        df = parts[0]
        for p in parts[1:]:
            df = df.unionByName(p)
        return df

    first = batch(("AB-DK-WB-NLI", 60, 2, "b"), ("AB-DK-WB-NLI", 6, 2, "a"), ("AB-SE-WB-NLI", 1, 2, "b"))
    fn(first, 0)
    fn(first, 0)  # a replayed batch
    assert sorted(r.records for r in spark.read.parquet(f"{out}/live").collect()) == [1, 60]
    assert spark.read.parquet(f"{out}/snap").count() == 3
    fn(batch(("AB-DK-WB-NLI", 7, 3, "c")), 1)  # the day comes again without the other campaign
    assert [r.records for r in spark.read.parquet(f"{out}/live").collect()] == [7]


def test_stream_pulse_equals_batch(spark, tmpdir_path):
    ops = TD.ops_daily(spark, SF_SMALL)
    ev = ops.select(F.col("ops_date").cast("timestamp").alias("event_ts"),
                    F.col("extracted_engagement").alias("engagement"), "records", "conversions", "kpi2_logins")
    ev.write.parquet(f"{tmpdir_path}/ev")
    stream = spark.readStream.schema(ev.schema).parquet(f"{tmpdir_path}/ev")
    t = S.run_pulse(S.pulse_stream(stream), f"{tmpdir_path}/pulse", f"{tmpdir_path}/chk")
    got = {(r.day, r.engagement): r.total_records for r in t.collect()}
    exp = {(r.ops_date, r.extracted_engagement): r.total_records for r in O.daily_pulse(ops).collect()}
    assert got == exp


def test_dedup_within_watermark(spark, tmpdir_path):
    ts = dt.datetime(2024, 1, 1, 10)
    rows = [("b", 1, "call", ts, 1.0), ("b", 1, "call", ts, 1.0), ("b", 1, "login", ts, 0.0)]
    df = spark.createDataFrame(rows, "box_id string, contact_id long, event_type string, event_at timestamp, value double")
    df.write.parquet(f"{tmpdir_path}/e")
    stream = J.dedup_stream(spark.readStream.schema(df.schema).parquet(f"{tmpdir_path}/e"))
    q = (stream.writeStream.format("parquet").option("path", f"{tmpdir_path}/out").option("checkpointLocation", f"{tmpdir_path}/chk")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.read.parquet(f"{tmpdir_path}/out").count() == 2
    assert J.dedup_batch(df).count() == 2


def test_exact_medians_match_statistics(spark):
    import random
    import statistics
    rng = random.Random(3)
    rows = [(k, rng.choice([0.25, 1.5, 1.75, rng.uniform(0, 50), 7.0])) for k in "abc" for _ in range(rng.randint(1, 200))]
    rows += [("one", 4.5), ("two", 1.0), ("two", 9.0)]
    got = {r["k"]: (r["contacts"], r["median"]) for r in J.exact_medians(
        spark.createDataFrame(rows, "k string, v double"), "k", "v").collect()}
    for k in {k for k, _ in rows}:
        values = [v for x, v in rows if x == k]
        assert got[k][0] == len(values)
        assert abs(got[k][1] - statistics.median(values)) < 1e-9


def test_dedup_keeps_the_smallest_event_id(spark):
    rows = [("box1", 1, "call", "2024-01-01 00:00:00", 9, 5.0), ("box1", 1, "call", "2024-01-01 00:00:00", 4, 7.0),
            ("box1", 1, "login", "2024-01-01 00:00:00", 6, None)]
    df = spark.createDataFrame(rows, "box_id string, contact_id long, event_type string, event_at string, event_id long, value double")
    got = {(r.event_type, r.event_id, r.value) for r in J.dedup_batch(df).collect()}
    assert got == {("call", 4, 7.0), ("login", 6, None)}


def _deliver(spark, root, source, at, rows, files=1):
    """One delivery: rows (campaign, day, records) below source=/delivery= folders."""
    folder = f"{root}/source={source}/delivery={at}" if source else f"{root}/{at}"
    _raw(spark, rows).repartition(files).write.mode("append").parquet(folder)


@pytest.mark.parametrize("per_trigger", [1, 8, 100])
def test_deliveries_any_trigger_size(spark, tmpdir_path, per_trigger):
    """Two sources of one day, one of them in several files, a newer delivery that drops a campaign,
    and an older one that comes last: the live table does not depend on the triggers."""
    src, out = f"{tmpdir_path}/in", f"{tmpdir_path}/out"
    day, other = dt.date(2025, 3, 1), dt.date(2025, 3, 2)
    _deliver(spark, src, "box1", "20250302", [(f"AB-DK-WB-C{i}", day, i) for i in range(6)], files=3)
    _deliver(spark, src, "box2", "20250302", [("AB-DK-WB-C1", day, 100), ("AB-SE-WB-NLI", day, 7), ("AB-SE-WB-NLI", other, 9)])
    _deliver(spark, src, "box2", "20250305", [("AB-DK-WB-C1", day, 101)])  # NLI is gone on day 1, day 2 stays
    S.run_available(S.start_ops_ingest(spark, src, out, f"{tmpdir_path}/chk", max_files_per_trigger=per_trigger))
    _deliver(spark, src, "box1", "20250301", [("AB-DK-WB-OLD", day, 1)])  # older than what is live
    S.run_available(S.start_ops_ingest(spark, src, out, f"{tmpdir_path}/chk", max_files_per_trigger=per_trigger))
    live = {(r.campaign_name[:-11], r._source, str(r.ops_date), r.records) for r in spark.read.parquet(f"{out}/ops_live").collect()}
    assert live == {(f"AB-DK-WB-C{i}", "box1", "2025-03-01", i) for i in range(6)} | {
        ("AB-DK-WB-C1", "box2", "2025-03-01", 101), ("AB-SE-WB-NLI", "box2", "2025-03-02", 9)}
    manifest = S.read_manifest(spark, f"{out}/ops_live_manifest")
    assert manifest.where("status = 'stale'").select("source", "at").collect() == [("box1", "20250301")]
    assert spark.read.parquet(f"{out}/ops_snapshots").count() == 11


@pytest.mark.parametrize("per_trigger", [1, 8])
def test_files_without_source_lose_nothing(spark, tmpdir_path, per_trigger):
    src, out, day = f"{tmpdir_path}/in", f"{tmpdir_path}/out", dt.date(2025, 3, 1)
    _deliver(spark, src, None, "b1", [("AB-DK-WB-NLI", day, 1)])
    _deliver(spark, src, None, "b2", [("AB-SE-WB-NLI", day, 2)])
    S.run_available(S.start_ops_ingest(spark, src, out, f"{tmpdir_path}/chk", max_files_per_trigger=per_trigger))
    assert sorted(r.records for r in spark.read.parquet(f"{out}/ops_live").collect()) == [1, 2]


@pytest.mark.parametrize("per_trigger", [1, 8])
@pytest.mark.parametrize("source", ["box", None])
def test_campaign_in_two_files_of_a_delivery(spark, tmpdir_path, monkeypatch, per_trigger, source):
    """of a campaign that comes in two files the last one's row is live, in whichever batch it comes;
    a month in too many files is gathered."""
    src, out, day = f"{tmpdir_path}/in", f"{tmpdir_path}/out", dt.date(2025, 3, 1)
    monkeypatch.setattr(S, "FILES_A_MONTH", 1)
    folder = f"{src}/source={source}/delivery=1" if source else f"{src}/delivery=1"
    for n, (name, rec) in enumerate([("b", 2), ("a", 1), ("c", 3)]):  # in order of time
        _raw(spark, [("AB-DK-WB-NLI", day, rec), (f"AB-SE-WB-{name}", day, rec)]).coalesce(1).write.parquet(f"{folder}/{name}")
    S.run_available(S.start_ops_ingest(spark, src, out, f"{tmpdir_path}/chk", max_files_per_trigger=per_trigger))
    live = {(r.campaign_name[:-11], r.records) for r in spark.read.parquet(f"{out}/ops_live").collect()}
    assert live == {("AB-DK-WB-NLI", 3), ("AB-SE-WB-a", 1), ("AB-SE-WB-b", 2), ("AB-SE-WB-c", 3)}
    assert spark.read.parquet(f"{out}/ops_snapshots").count() == 6
    assert not S._crowded(spark, f"{out}/ops_live", ["2025-03"]) or per_trigger == 8


def test_replayed_batch_and_rows_without_a_date(spark, tmpdir_path):
    """A batch that is run again, also after a later one has begun to write, leaves the same table."""
    out, day = tmpdir_path, dt.date(2025, 3, 1)
    fn = S.ops_sink_batch(f"{out}/live", f"{out}/snap", f"{out}/late")

    def batch(at, *rows):
        return S.parse_stream(_raw(spark, rows)).withColumn(
            "delivery", F.struct(F.lit("box").alias("source"), F.lit(at).alias("at"), F.lit(f"f{at}").alias("file")))

    fn(batch("1", ("AB-DK-WB-NLI", day, 1), ("AB-SE-WB-NLI", day, 2), ("AB-NO-WB-NLI", None, 5)), 0)
    second = batch("2", ("AB-DK-WB-NLI", day, 10))
    for _ in range(2):
        fn(second, 1)
        assert [(r.records, r._at) for r in spark.read.parquet(f"{out}/live").collect()] == [(10, "2")]
    assert spark.read.parquet(f"{out}/snap").count() == 4
    assert [tuple(r) for r in S.read_manifest(spark, f"{out}/live_manifest").orderBy("batch_id").select("status", "rows", "known_at").collect()] \
        == [("new", 2, None), ("newer", 1, "1")]


def test_pulse_state_is_evicted_and_late_rows_counted(spark, tmpdir_path):
    """Update mode: days behind the watermark leave the state but stay in the table, late rows are counted."""
    schema = "event_ts timestamp, engagement string, records long, conversions long, kpi2_logins long"
    src, out, chk = f"{tmpdir_path}/in", f"{tmpdir_path}/pulse", f"{tmpdir_path}/chk"

    def drain(n, *rows):
        spark.createDataFrame([(dt.datetime(2025, 1, d, 12), e, r, 0, 0) for d, e, r in rows], schema).coalesce(1).write.parquet(f"{src}/{n}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
        q = S.start_pulse(S.pulse_stream(stream, watermark="3 days"), out, chk)
        q.awaitTermination()
        return S.state_report(q)

    drain(1, (1, "CALL", 5), (1, "MAIL", 1), (2, "CALL", 6))
    second = drain(2, (20, "CALL", 7), (2, "CALL", 4))  # day 2 is updated, then falls behind
    assert sum(p["numRowsRemoved"] for p in second) == 3
    third = drain(3, (1, "CALL", 100), (20, "CALL", 3), (21, None, 2))  # day 1 is behind the watermark
    assert sum(p["numRowsDroppedByWatermark"] for p in third) == 1
    got = {(str(r.day), r.engagement): r.total_records for r in spark.read.parquet(out).collect()}
    assert got == {("2025-01-01", "CALL"): 5, ("2025-01-01", "MAIL"): 1, ("2025-01-02", "CALL"): 10,
                   ("2025-01-20", "CALL"): 10, ("2025-01-21", None): 2}
    assert third[-1]["numRowsTotal"] == 2


def test_dedup_survives_a_restart(spark, tmpdir_path):
    """Re-delivered events after a restart, some of them within one batch, others across batches."""
    schema = "box_id string, contact_id long, event_type string, event_at timestamp_ntz, event_id long, value double"

    def drain(n, *rows):
        spark.createDataFrame([("b", c, "call", dt.datetime(2024, 1, d, 10), i, 1.0) for c, d, i in rows], schema).coalesce(1).write.parquet(
            f"{tmpdir_path}/in/{n}")
        events = J.read_event_stream(spark, f"{tmpdir_path}/in", spark.read.schema(schema).parquet(f"{tmpdir_path}/in/{n}").schema)
        q = J.start_dedup(events, f"{tmpdir_path}/log", f"{tmpdir_path}/chk", watermark="5 days")
        q.awaitTermination()
        return S.state_report(q)

    drain(1, (1, 1, 1), (1, 1, 2), (2, 3, 3))
    drain(2, (1, 1, 4), (2, 3, 5), (3, 4, 6))
    last = drain(3, (9, 25, 7), (3, 4, 8))
    log = spark.read.parquet(f"{tmpdir_path}/log")
    assert sorted(r.contact_id for r in log.collect()) == [1, 2, 3, 9]
    assert last[-1]["numRowsTotal"] == 1  # keys behind the watermark have left the state
