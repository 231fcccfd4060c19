import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from ledgerline import reports, sinks
from ledgerline.operators import crm as K
from ledgerline.sources import testdata as TD


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("reports"))
    sinks.replace(TD.player_activity(spark, SF_SMALL), f"{root}/fact", ["report_month"])
    return root


def _plan(df):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_reports_prune_months(spark, stored):
    params = {"start_month": "2024-03", "end_month": "2024-08"}
    assert sorted(reports.REPORTS) == ["cohort_matrix", "full_financial_export", "player_master_list", "vip_churn_radar"]
    for name in reports.REPORTS:
        for tab in reports.compute(spark, name, f"{stored}/fact", params).values():
            filters = [line for line in _plan(tab).splitlines() if line.startswith("PartitionFilters")]
            assert filters and all("2024-03" in f and "2024-08" in f for f in filters), name
    fact = spark.read.parquet(f"{stored}/fact").withColumn("report_month", F.col("report_month").cast("string"))
    some = fact.where("report_month between '2024-03' and '2024-08'")
    got = reports.compute(spark, "cohort_matrix", f"{stored}/fact", params)["cohorts"]
    want = K.cohort_retention_matrix(some)
    assert rows(got, *want.columns) == rows(want, *want.columns)
    none = reports.compute(spark, "vip_churn_radar", f"{stored}/fact", {"start_month": "1990-01", "end_month": "1990-02"})
    assert none["players"].count() == 0
    with pytest.raises(KeyError):
        reports.compute(spark, "nothing", f"{stored}/fact")
    written = reports.store_report(spark, "player_master_list", f"{stored}/fact", f"{stored}/store", params)
    assert spark.read.parquet(written["players"]).count() == some.select("id", "brand").distinct().count()


def test_sketch_unions_stay_within_the_error_bound(spark, tmpdir_path):
    """Players that come back in many months: sums of months would be far off, unions are not."""
    pa = spark.range(60_000).select(
        (F.col("id") % 20_000).cast("string").alias("id"), F.format_string("2024-%02d", F.col("id") % 12 + 1).alias("report_month"),
        F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("brand"), F.lit("X").alias("country"), F.lit("S").alias("segment"), F.lit("W").alias("wb_tag"))
    reports.write_player_sketches(pa, tmpdir_path)
    sketches = reports.read_player_sketches(spark, tmpdir_path)
    bound = 4 * reports.standard_error()
    for by, start, end in (([], None, None), (["brand"], "2024-02", "2024-09"), (["country", "brand"], "2024-05", "2024-05")):
        exact = reports.in_months(pa, {"start_month": start, "end_month": end}).groupBy(*by).agg(F.countDistinct("id").alias("n"))
        want = {tuple(r)[:-1]: r.n for r in exact.collect()}
        df = reports.distinct_players(sketches, by, start, end)
        got = {tuple(r)[:-1]: r.players for r in df.collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - n) <= bound * n for k, n in want.items())
        assert "id" not in _plan(df).split("ReadSchema")[1].split("\n")[0]  # the fact is not read again
    # a month that is loaded again replaces its own sketches
    reports.write_player_sketches(pa.where("report_month = '2024-05' and brand = 'A'"), tmpdir_path)
    again = reports.read_player_sketches(spark, tmpdir_path)
    assert again.where("report_month = '2024-05'").count() == 1 and again.select("report_month").distinct().count() == 12
