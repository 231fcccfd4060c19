"""Steps that large tables share: what they read, shuffle and sum, and that their rows stay the same."""

import os
import time
from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline import reports, session, tables
from ledgerline.operators import crm, financial
from ledgerline.plans import registry as R
from ledgerline.plans.registry import all_queries
from ledgerline.sources import files, routing
from ledgerline.sources import testdata as TD
from ledgerline.streaming import ops_stream


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_sums_longs(spark):
    """The fact's aggregation holds cents as longs, not decimals wider than 18 digits."""
    text = plan(TD.player_activity(spark, SF_SMALL))
    assert "sum(revenue" in text and "decimal(28,2)" not in text


def test_cents_round_like_decimals(spark, tmpdir_path):
    prices, discounts, taxes = ["0.05", "1.50", "12.345", "99.99", "104949.5", None], ["0.00", "0.03", "0.04", "0.10"], ["0.00", "0.07", "0.50"]
    lines = [(1, 1, float(p) if p else None, float(d), float(t), "A", s) for p in prices for d in discounts for t in taxes for s in ("F", "O", None)]
    frames = {
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"),
        "orders": ([(1, 7, datetime(1997, 3, 5))], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        "customer": ([(7, 0, "AUTO")], "c_custkey long, c_nationkey long, c_mktsegment string"),
        "nation": ([(0, "X", 0)], "n_nationkey long, n_name string, n_regionkey long"),
        "region": ([(0, "Y")], "r_regionkey long, r_name string"), "part": ([(1, "PROMO")], "p_partkey long, p_type string")}
    for name, (data, schema) in frames.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmpdir_path}/{name}.parquet")

    def cents(x):
        return x.quantize(Decimal("0.01"), ROUND_HALF_UP)
    want = []
    for _, _, p, d, t, _, _ in lines:
        if p is not None:
            p, d, t = cents(Decimal(str(p))), Decimal(str(d)), Decimal(str(t))
            revenue = cents(p * (d - Decimal("0.04")))
            want.append((p, revenue, cents(revenue * (1 - t)), cents(p * d), cents(p * t)))
    columns = ["bet", "revenue", "ngr", "bonus_total", "tax_total"]
    got = TD.player_lines(spark, tmpdir_path).where("bet is not null").select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    fact = TD.player_activity(spark, tmpdir_path).select(*columns).collect()
    assert [tuple(r) for r in fact] == [tuple(map(sum, zip(*want)))]


@pytest.mark.parametrize("name", ["f5_monthly_brand_summary", "f6_combined_summary", "f7_both_business_summary", "f8_time_series",
                                  "k8_cohort_retention_matrix"])
def test_fact_is_made_once(spark, name):
    """What reads the fact several times reads it stored."""
    assert "l_orderkey" not in plan(all_queries()[name](spark, SF_SMALL))


@pytest.mark.parametrize("name", ["s1b_routed_formats", "s11_quarantine", "w4b_replace_client"])
def test_exports_read_a_stored_fact(spark, monkeypatch, name):
    """four exports and the registry do not each make the fact anew."""
    plans, export = [], routing.export_by_format
    monkeypatch.setattr(routing, "export_by_format", lambda pa, *a, **k: (plans.append(plan(pa)), export(pa, *a, **k))[1])
    all_queries()[name](spark, SF_SMALL)
    assert len(plans) == 1 and "l_orderkey" not in plans[0]


def test_filter_domains_read_each_fact_once(spark):
    """F10."""
    assert plan(all_queries()["p2_filter_domains"](spark, SF_SMALL)).count("PushedFilters: [IsNotNull(l_orderkey)") + \
        plan(all_queries()["p2_filter_domains"](spark, SF_SMALL)).count("FileScan parquet [l_orderkey") <= 4


def test_order_counters_take_one_narrow_shuffle(spark):
    """lines are dealt by order as they are; no counters are shuffled before the join."""
    text = plan(TD.ops_raw_daily(spark, SF_SMALL))
    assert "REPARTITION_BY_COL" in text and text.count("decimal(22,2)") <= 2
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning(l_orderkey" in line]
    assert len(exchanges) == 1


def test_upsert_shuffles_once(spark, tmpdir_path, monkeypatch):
    """the merge and the write by part share one shuffle, and the rows are those of the plain merge."""
    made, write = [], tables._write_by_part
    monkeypatch.setattr(tables, "_write_by_part", lambda df, *a: (made.append(plan(df)), write(df, *a))[1])
    first = spark.range(500).selectExpr("cast(id % 300 as string) k", "id v", "id * 2 x")
    second = spark.range(250, 450).selectExpr("cast(id as string) k", "cast(if(id % 2 = 0, 1000, 0) as long) v", "id x")
    for new in (first, second):
        tables.upsert(spark, new, tmpdir_path, "t", ["k"], "v")
    assert [p.count("Exchange") for p in made] == [1, 1]
    want = {}
    for k, v, x in [(str(i % 300), i, i * 2) for i in range(500)] + [(str(i), 1000 if i % 2 == 0 else 0, i) for i in range(250, 450)]:
        if k not in want or v >= want[k][0]:
            want[k] = (v, x)
    got = tables.read_table(spark, tmpdir_path, "t")
    assert got.columns == ["k", "v", "x"]
    assert {r.k: (r.v, r.x) for r in got.collect()} == want and got.count() == len(want)


def test_fact_tasks_follow_the_lines(spark, monkeypatch):
    """Lines are dealt by group in as many parts as they need, before they are summed, without names of places."""
    want = sorted(map(tuple, TD.player_activity(spark, SF_SMALL).collect()), key=str)
    monkeypatch.setattr(TD, "LINES_A_TASK", 100)
    fact = TD.player_activity(spark, SF_SMALL)
    parts = -(-TD.read_table(spark, SF_SMALL, "lineitem").count() // 100)
    dealt = [line for line in plan(fact).splitlines() if "Exchange" in line and f", {parts})" in line]
    assert len(dealt) == 1 and "n_name" not in dealt[0] and "REPARTITION_BY_NUM" in dealt[0]
    assert plan(fact).count("Exchange hashpartitioning(o_custkey") <= 2
    assert sorted(map(tuple, fact.collect()), key=str) == want


def test_cohort_parts_are_counted(spark):
    """parts of cohort rows are not joined by their bytes."""
    fact = TD.player_activity(spark, SF_SMALL)
    for df in (financial.cohort_counts(fact), crm.cohort_retention_matrix(fact)):
        assert "REPARTITION_BY_COL" not in plan(df)


def test_detailed_export_deals_numbers(spark, tmpdir_path, monkeypatch):
    """texts are not shuffled."""
    seen, export = [], files.export_named_csv
    monkeypatch.setattr(files, "export_named_csv", lambda df, *a, **k: (seen.append(dict(df.dtypes)), export(df, *a, **k))[1])
    files.export_detailed(TD.player_activity(spark, SF_SMALL), tmpdir_path)
    assert seen[0]["Deposit €"] == "decimal(18,2)" and seen[0]["Deposit #"] == "bigint"


def test_ingest_computes_a_batch_once(spark, monkeypatch):
    """what cuts a batch's lineage is written, not checkpointed, which computes it twice."""
    from pyspark.sql.classic.dataframe import DataFrame
    monkeypatch.setattr(DataFrame, "checkpoint", lambda self, *a, **k: pytest.fail("checkpoint"))
    assert all_queries()["r1_stream_ops_ingest"](spark, SF_SMALL).count()


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_ingest_leaves_no_shuffle_files(spark):
    """a step's shuffle files go when it ends, and so does the batch; settings stay the session's."""
    names = list(session.LEAN_STEPS)
    before, conf = _shuffle_files(spark), [spark.conf.get(n, None) for n in names]
    all_queries()["r1_stream_ops_ingest"](spark, SF_SMALL)
    deadline = time.time() + 20  # files are removed beside the next step
    while (left := _shuffle_files(spark) - before) and time.time() < deadline:
        time.sleep(0.5)
    assert not left and [spark.conf.get(n, None) for n in names] == conf


def _shuffled(node):
    """The columns of every shuffle of a plan."""
    if node.nodeName() == "AdaptiveSparkPlan":
        return _shuffled(node.initialPlan())
    below = [columns for i in range(node.children().size()) for columns in _shuffled(node.children().apply(i))]
    output = node.output()
    return below + ([[output.apply(i).name() for i in range(output.size())]] if node.nodeName() == "Exchange" else [])


def test_ingest_shuffles_whole_rows_once(spark, monkeypatch, tmpdir_path):
    """a batch's rows are shuffled before they are parsed and then written as they lie."""
    from pyspark.sql.classic.dataframe import DataFrame
    raw = TD.ops_raw_daily(spark, SF_SMALL).withColumn("delivery", F.struct(F.lit("box").alias("source"), F.lit("1").alias("at")))
    raw.write.parquet(f"{tmpdir_path}/raw")
    raw = spark.read.parquet(f"{tmpdir_path}/raw")
    seen, write = [], DataFrame.write
    monkeypatch.setattr(DataFrame, "write", property(lambda self: (seen.append(_shuffled(self._jdf.queryExecution().executedPlan())), write.fget(self))[1]))
    fn = ops_stream.ops_sink_batch(*[f"{tmpdir_path}/{n}" for n in ("live", "snap", "late")], parse=ops_stream.parse_stream)
    for epoch in range(2):
        seen.clear()
        fn(raw, epoch)
        wide = [columns for plans in seen for columns in plans if len(columns) > 12]
        assert len(seen) >= 5 and len(wide) == 1 and "dnc" in wide[0] and "extracted_lifecycle" not in wide[0]
    assert spark.read.parquet(f"{tmpdir_path}/live").count() == raw.count()
    assert spark.read.parquet(f"{tmpdir_path}/snap").count() == 2 * raw.count()
    assert not os.path.exists(f"{tmpdir_path}/live_batch")


def test_export_makes_the_summary_once(spark):
    """both tabs read the same kept summary."""
    fact = TD.player_activity(spark, SF_SMALL)
    tabs = reports.full_financial_export(fact, {})
    assert "InMemoryTableScan" in plan(tabs["both_business"])
    tabs["brands"].unpersist()


def test_order_join_follows_the_lines(spark, monkeypatch):
    """lines meet their orders in as many parts as they need, with no further shuffle for the join."""
    want = sorted(map(tuple, TD.player_activity(spark, SF_SMALL).collect()), key=str)
    monkeypatch.setattr(TD, "LINES_A_JOIN", 150)
    fact = TD.player_activity(spark, SF_SMALL)
    parts = -(-TD.read_table(spark, SF_SMALL, "lineitem").count() // 150)
    dealt = [line for line in plan(fact).splitlines() if "Exchange hashpartitioning(l_orderkey" in line or "Exchange hashpartitioning(o_orderkey" in line]
    assert len(dealt) == 2 and all(f", {parts})" in line and "REPARTITION_BY_NUM" in line for line in dealt)
    assert sorted(map(tuple, fact.collect()), key=str) == want


@pytest.mark.parametrize("steps", [financial.cohort_counts, crm.cohort_retention_matrix, crm.ltv_curves, crm.retention_heatmap])
def test_cohort_parts_follow_the_rows(spark, tmpdir_path, monkeypatch, steps):
    """a task's cohort rows are bounded by their number, not by the session's number of parts."""
    TD.player_activity(spark, SF_SMALL).write.parquet(f"{tmpdir_path}/fact")
    fact = spark.read.parquet(f"{tmpdir_path}/fact")
    want = sorted(map(tuple, steps(fact).collect()), key=str)
    monkeypatch.setattr(session, "COHORT_ROWS_A_TASK", 100)
    parts = -(-fact.count() // 100)
    assert parts > session.shuffle_partitions(spark)
    dealt = [line for line in plan(steps(fact)).splitlines() if "REPARTITION_BY_NUM" in line]
    assert dealt and all(f", {parts})" in line for line in dealt)
    assert sorted(map(tuple, steps(fact).collect()), key=str) == want


@pytest.mark.parametrize("name", ["f3_cohort_counts", "k7_ltv_curves", "k9_retention_heatmap"])
def test_cohorts_read_a_stored_fact(spark, name):
    """where rows are counted, the fact is not made anew for it."""
    assert "l_orderkey" not in plan(all_queries()[name](spark, SF_SMALL))
