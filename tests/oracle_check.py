"""Run registered queries and their DuckDB oracles side by side.

Usage: ``python tests/oracle_check.py [sf_dir] [name ...]``

Mirrors the driver's correctness gate: row count, column names and an
order-insensitive comparison of every value (floats compared exactly; a
tolerance-based diagnosis is printed on mismatch).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(v))
    if isinstance(v, decimal.Decimal):
        return (1, repr(float(v)))
    if isinstance(v, bool):
        return (2, str(v))
    if isinstance(v, int):
        return (3, str(v))
    if isinstance(v, dt.datetime):
        return (4, v.isoformat())
    if isinstance(v, dt.date):
        return (4, v.isoformat())
    if isinstance(v, (list, tuple)):
        return (5, repr([_norm(x) for x in v]))
    return (6, str(v))


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, (float, decimal.Decimal)) and isinstance(b, (float, decimal.Decimal)):
        a, b = float(a), float(b)
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return _norm(a) == _norm(b)


def compare(spark, name, qfn, sql, sf_dir, con, verbose=True):
    t0 = time.time()
    sdf = qfn(spark, sf_dir)
    scols = sorted(sdf.columns)
    srows = [tuple(r[c] for c in scols) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    dcols = sorted(rel.columns)
    idx = [rel.columns.index(c) for c in dcols]
    drows = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    t2 = time.time()
    ok_cols = scols == dcols
    ok_n = len(srows) == len(drows)
    ss = sorted(tuple(_norm(v) for v in r) for r in srows)
    ds = sorted(tuple(_norm(v) for v in r) for r in drows)
    ok_vals = ss == ds
    status = "OK" if (ok_cols and ok_n and ok_vals) else "FAIL"
    msg = f"{status} {name}: rows spark={len(srows)} duck={len(drows)} spark={t1 - t0:.1f}s duck={t2 - t1:.1f}s"
    if verbose:
        print(msg, flush=True)
    if not ok_cols:
        print("   cols only spark:", sorted(set(scols) - set(dcols)), " only duck:", sorted(set(dcols) - set(scols)))
    elif not ok_vals and ok_n:
        sr = sorted(srows, key=lambda r: tuple(_norm(v) for v in r))
        dr = sorted(drows, key=lambda r: tuple(_norm(v) for v in r))
        shown = 0
        bad_cols = set()
        for a, b in zip(sr, dr):
            for c, x, y in zip(scols, a, b):
                if not _close(x, y):
                    bad_cols.add(c)
                    if shown < 6:
                        print(f"   {c}: spark={x!r} duck={y!r}")
                        shown += 1
        exact_bad = set()
        for a, b in zip(sr, dr):
            for c, x, y in zip(scols, a, b):
                if _norm(x) != _norm(y):
                    exact_bad.add(c)
        print("   cols differing (tolerant):", sorted(bad_cols), " exact:", sorted(exact_bad)[:12])
    return status == "OK"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from ledgerline.plans.registry import all_oracles, all_queries
    from ledgerline.session import build_session
    spark = build_session("local[8]", 8)
    qs, os_ = all_queries(), all_oracles()
    con = duck(sf_dir)
    todo = names or [n for n in qs if n in os_]
    fails = []
    for n in todo:
        try:
            if not compare(spark, n, qs[n], os_[n], sf_dir, con):
                fails.append(n)
        except Exception as e:  # report and continue
            print(f"ERROR {n}: {type(e).__name__}: {str(e)[:800]}", flush=True)
            fails.append(n)
    missing = [n for n in qs if n not in os_]
    print(f"\n{len(todo) - len(fails)}/{len(todo)} OK; failing: {fails}; no oracle: {missing}")
    return 0 if not fails else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
