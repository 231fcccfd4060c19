"""Benchmark: headline operators at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Step 1 (``ingest_facts``) runs the adapters once and writes the canonical facts
as partitioned parquet — the materialization the reference's ETL performs.
Step 2 times each headline operator over those facts (full evaluation into the
``noop`` sink, so nothing is collected).  Each query: one warm-up run, then
the median of ``$BENCH_REPEAT`` timed runs.

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))


def main() -> None:
    from ledgerline.operators import crm as K
    from ledgerline.operators import financial as FIN
    from ledgerline.operators import ops as O
    from ledgerline.session import build_session
    from ledgerline.sinks import materialize_facts
    from ledgerline.sources import dims

    spark = build_session(f"local[{CPUS}]", shuffle_partitions=max(8, 2 * CPUS),
                          extra={"spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    work = tempfile.mkdtemp(prefix="ledgerline-bench-")

    t0 = time.perf_counter()
    facts = materialize_facts(spark, SF_DIR, work)
    ingest = time.perf_counter() - t0

    pa, lines, ops, snaps = facts["player_activity"], facts["player_lines"], facts["ops_daily"], facts["ops_snapshots"]
    base = O.ops_base(ops)
    bench_tbl = O.historical_benchmarks(ops)

    headline = {
        "f5_monthly_brand_summary": lambda: FIN.monthly_brand_summary(pa),
        "f3_cohort_counts": lambda: FIN.cohort_counts(pa),
        "f8_time_series": lambda: FIN.time_series(FIN.monthly_brand_summary(pa)),
        "k4_smart_profiles": lambda: K.smart_profiles(pa),
        "k8_cohort_retention_matrix": lambda: K.cohort_retention_matrix(pa),
        "k10_pareto_curve": lambda: K.pareto_curve(pa),
        "k13_reactivation_velocity": lambda: K.reactivation_velocity(lines),
        "k14_vip_churn_radar": lambda: K.vip_churn_radar(pa),
        "o4_pulse_windows": lambda: O.pulse_windows(O.daily_pulse(ops)),
        "o5_historical_benchmarks": lambda: bench_tbl,
        "o16_pitch_scorecard": lambda: O.pitch_scorecard(base),
        "o19_true_cost_ledger": lambda: O.true_cost_ledger(ops, bench_tbl),
        "o20_morning_variance": lambda: O.morning_variance(ops),
        "o13_latest_snapshots": lambda: O.latest_snapshots(snaps),
        "c12_short_name_totals": lambda: O.short_name_totals(ops),
        "o8_sla_breaches": lambda: O.sla_breaches(ops, dims.contractual_volumes(spark)),
    }
    only = os.environ.get("BENCH_ONLY")
    if only:
        headline = {k: v for k, v in headline.items() if re.search(only, k)}

    def run(fn):
        t = time.perf_counter()
        fn().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    times = {}
    for name, fn in headline.items():
        run(fn)  # warm-up
        times[name] = round(statistics.median(run(fn) for _ in range(REPEAT)), 3)

    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    out = {
        "metric": "headline_queries_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {"ingest_facts": round(ingest, 3), **times},
        "total_with_ingest": round(ingest + sum(times.values()), 3),
        "sf": float(sf.group(1)) if sf else SF_DIR,
        "cpus": CPUS,
        "repeat": REPEAT,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
