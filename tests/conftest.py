import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import build_session
    s = build_session("local[4]", 8, app_name="ledgerline-tests",
                      extra={"spark.ui.showConsoleProgress": "false"})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="ledgerline-test-")


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def pa_frame(spark, data):
    """PlayerRecord fixture rows: (id, brand, report_month, revenue[, bet, ngr])."""
    from pyspark.sql import functions as F
    from ledgerline.functions.core import MONEY
    from ledgerline.sources.testdata import PLAYER_MEASURES
    full = []
    for r in data:
        rid, brand, month, rev = r[:4]
        bet = r[4] if len(r) > 4 else abs(rev) * 10
        ngr = r[5] if len(r) > 5 else rev
        full.append((rid, brand, month, "C1", "XX", "WB", "WB", float(bet), float(rev), float(ngr)))
    df = spark.createDataFrame(full, "id string, brand string, report_month string, client string, country string, "
                                     "wb_tag string, segment string, bet double, revenue double, ngr double")
    for m in PLAYER_MEASURES:
        if m not in df.columns:
            df = df.withColumn(m, F.lit(0.0))
    for m in PLAYER_MEASURES:
        df = df.withColumn(m, F.col(m).cast(MONEY))
    return df.withColumn("deposit_count", F.lit(0).cast("bigint"))
