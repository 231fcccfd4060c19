"""DuckDB oracle SQL for the financial block (F*)."""

from __future__ import annotations

from ..operators import financial as FIN
from .sqlkit import (count_if, div, month_from_index, month_index, msum, pct, rev_share,
                     with_player_activity)

MONEY = "DECIMAL(18,2)"
_SUMS = ",\n  ".join(f"{msum(src)} AS {name}" for name, src in FIN.SUM_MEASURES.items())

FIN_CTE = f"""fin AS (
  SELECT brand, report_month AS month,
  {count_if('revenue < 0')} AS negative_yield_players,
  {count_if('revenue > 0')} AS profitable_players,
  {count_if('revenue = 0')} AS flat,
  CAST(COUNT(id) AS BIGINT) AS total_players,
  {_SUMS},
  CAST(COALESCE(SUM(deposit_count), 0) AS BIGINT) AS deposit_count
  FROM player_activity WHERE brand IS NOT NULL AND report_month IS NOT NULL
  GROUP BY brand, report_month
)"""


def whale_cte(by_brand: bool, name: str = "whale") -> str:
    keys = "brand, month" if by_brand else "month"
    notnull = "brand IS NOT NULL AND report_month IS NOT NULL" if by_brand else "report_month IS NOT NULL"
    return f"""{name}_prof AS (
  SELECT {keys}, revenue,
    ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY revenue DESC, id) AS rn,
    COUNT(*) OVER (PARTITION BY {keys}) AS n
  FROM (SELECT *, report_month AS month FROM player_activity WHERE {notnull} AND revenue > 0)
),
{name}_top AS (SELECT {keys}, SUM(revenue) AS top FROM {name}_prof WHERE rn <= GREATEST(1, n // 10) GROUP BY {keys}),
{name}_tot AS (SELECT {keys}, {msum('revenue')} AS ggr FROM (SELECT *, report_month AS month FROM player_activity WHERE {notnull}) GROUP BY {keys}),
{name} AS (
  SELECT {", ".join(f"t.{k.strip()}" for k in keys.split(","))},
    CASE WHEN t.ggr <> 0 THEN CAST(COALESCE(w.top, 0) AS DOUBLE) / CAST(t.ggr AS DOUBLE) * CAST(100 AS DOUBLE)
         ELSE CAST(0 AS DOUBLE) END AS top_10_pct_ggr_share
  FROM {name}_tot t LEFT JOIN {name}_top w USING ({keys})
)"""


COHORT_CTE = f"""bim AS (
  SELECT brand, report_month AS month, id, {msum('revenue')} AS rev
  FROM player_activity WHERE brand IS NOT NULL AND report_month IS NOT NULL AND id IS NOT NULL
  GROUP BY brand, report_month, id
),
mrank AS (SELECT brand, month, DENSE_RANK() OVER (PARTITION BY brand ORDER BY month) AS mrank
          FROM (SELECT DISTINCT brand, month FROM bim)),
bimx AS (SELECT b.*, m.mrank, LAG(m.mrank) OVER (PARTITION BY b.brand, b.id ORDER BY b.month) AS prev
         FROM bim b JOIN mrank m USING (brand, month)),
coh AS (
  SELECT brand, month,
    {count_if('prev IS NULL')} AS new_players,
    {count_if('prev IS NOT NULL')} AS returning_players,
    {count_if('prev < mrank - 1')} AS reactivated_players,
    CAST(SUM(CASE WHEN prev IS NULL THEN rev ELSE 0 END) AS {MONEY}) AS new_player_ggr,
    CAST(SUM(CASE WHEN prev IS NOT NULL THEN rev ELSE 0 END) AS {MONEY}) AS returning_player_ggr,
    CAST({count_if('prev IS NULL')} + {count_if('prev < mrank - 1')} AS BIGINT) AS conversions
  FROM bimx GROUP BY brand, month
)"""

_MONEY_COLS = ["ggr", "ngr", "total_handle", "turnover_casino", "ggr_casino", "ngr_casino",
               "turnover_sports", "ggr_sports", "ngr_sports", "deposits", "withdrawals", "net_deposits",
               "bonus_total", "bonus_casino", "bonus_sports", "tax_total", "new_player_ggr",
               "returning_player_ggr", "revenue_share_deduction"]


def out_col(c: str) -> str:
    if c in _MONEY_COLS:
        return f"CAST({c} AS DOUBLE) AS {c}"
    return c


def _ratio_cols() -> str:
    return (f"{pct('profitable_players', 'total_players')} AS profitable_pct,\n"
            f"  {pct('ggr', 'total_handle')} AS hold_pct,\n"
            f"  {div('ggr', 'total_players')} AS ggr_per_player,\n"
            f"  {pct('returning_players', 'total_players')} AS retention_pct,\n"
            f"  {div('total_handle', 'total_players')} AS turnover_per_player")


_PAD_NUMERIC = [c for c in FIN.SUMMARY_COLS if c not in ("month", "brand", "profitable_pct", "hold_pct",
                                                         "ggr_per_player", "turnover_per_player",
                                                         "retention_pct", "revenue_share_deduction")]


def summary_ctes(include_combined: bool = True) -> str:
    pad_cols = []
    for c in _PAD_NUMERIC:
        if c == "top_10_pct_ggr_share":
            pad_cols.append(f"COALESCE(s.{c}, CAST(0 AS DOUBLE)) AS {c}")
        elif c in _MONEY_COLS:
            pad_cols.append(f"COALESCE(s.{c}, CAST(0 AS {MONEY})) AS {c}")
        else:
            pad_cols.append(f"COALESCE(s.{c}, CAST(0 AS BIGINT)) AS {c}")
    pad_sel = ",\n    ".join(pad_cols)
    add_sums = ",\n    ".join(
        (f"CAST(SUM({c}) AS BIGINT) AS {c}" if c in FIN.COUNT_COLS else f"CAST(SUM({c}) AS {MONEY}) AS {c}")
        for c in FIN.ADDITIVE_COLS)
    cols = ", ".join(FIN.SUMMARY_COLS)
    ctes = f"""{FIN_CTE},
{whale_cte(True)},
{COHORT_CTE},
summ AS (
  SELECT f.*, CAST(f.deposits - f.withdrawals AS {MONEY}) AS net_deposits, w.top_10_pct_ggr_share,
    c.new_players, c.returning_players, c.reactivated_players, c.conversions, c.new_player_ggr, c.returning_player_ggr
  FROM fin f LEFT JOIN whale w USING (brand, month) LEFT JOIN coh c USING (brand, month)
),
ents AS (SELECT brand, MIN({month_index('month')}) AS lo, MAX({month_index('month')}) AS hi FROM summ GROUP BY brand),
spine AS (
  SELECT brand, {month_from_index('mi')} AS month
  FROM (SELECT brand, unnest(generate_series(g.glo, g.ghi)) AS mi
        FROM ents, (SELECT MIN(lo) AS glo, MAX(hi) AS ghi FROM ents) g)
),
padded AS (
  SELECT sp.brand, sp.month,
    {pad_sel}
  FROM spine sp LEFT JOIN summ s ON s.brand = sp.brand AND s.month = sp.month
),
brand_summary AS (
  SELECT {cols} FROM (
    SELECT *, {_ratio_cols()},
      {rev_share('ggr')} AS revenue_share_deduction
    FROM padded)
)"""
    if include_combined:
        ctes += f""",
{whale_cte(False, 'cwhale')},
comb_sums AS (
  SELECT month, 'Combined' AS brand,
    {add_sums}
  FROM brand_summary GROUP BY month
),
comb AS (
  SELECT {cols} FROM (
    SELECT c.*, {_ratio_cols()}, COALESCE(w.top_10_pct_ggr_share, CAST(0 AS DOUBLE)) AS top_10_pct_ggr_share
    FROM comb_sums c LEFT JOIN cwhale w USING (month))
),
full_summary AS (SELECT * FROM brand_summary UNION ALL SELECT * FROM comb)"""
    return ctes


def _summary_select(src: str = "full_summary") -> str:
    return "SELECT " + ", ".join(out_col(c) for c in FIN.SUMMARY_COLS) + f" FROM {src}"


F1 = with_player_activity(f""", {FIN_CTE}
SELECT brand, month, negative_yield_players, profitable_players, flat, total_players,
  {", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in FIN.SUM_MEASURES)},
  deposit_count, CAST(CAST(deposits - withdrawals AS {MONEY}) AS DOUBLE) AS net_deposits,
  {pct('profitable_players', 'total_players')} AS profitable_pct,
  {div('ggr', 'total_players')} AS ggr_per_player,
  {pct('ggr', 'total_handle')} AS hold_pct
FROM fin""")

F2 = with_player_activity(f""", {whale_cte(True)}
SELECT brand, month, top_10_pct_ggr_share FROM whale""")

F2_COMBINED = with_player_activity(f""", {whale_cte(False)}
SELECT month, top_10_pct_ggr_share FROM whale""")

F3 = with_player_activity(f""", {COHORT_CTE}
SELECT brand, month, new_players, returning_players, reactivated_players,
  CAST(new_player_ggr AS DOUBLE) AS new_player_ggr, CAST(returning_player_ggr AS DOUBLE) AS returning_player_ggr,
  conversions FROM coh""")

F5 = with_player_activity(f""", {summary_ctes(True)}
{_summary_select()}""")

F6 = with_player_activity(f""", {summary_ctes(True)}
{_summary_select('comb')}""")

F4 = with_player_activity(f""", {summary_ctes(False)}
SELECT brand, month, total_players, CAST(ggr AS DOUBLE) AS ggr, new_players FROM padded""")

_BB_MONEY = ["ggr", "ngr", "turnover_casino", "ggr_casino", "ngr_casino", "turnover_sports", "ggr_sports",
             "ngr_sports", "new_player_ggr", "returning_player_ggr", "deposits", "withdrawals", "bonus_total",
             "bonus_casino", "bonus_sports", "tax_total"]
_BB_COUNT = ["new_players", "returning_players", "reactivated_players", "conversions", "profitable_players",
             "negative_yield_players", "deposit_count"]

BB_CTE = f"""bb0 AS (
  SELECT month, CAST(SUM(total_handle) AS {MONEY}) AS turnover,
    {", ".join(f"CAST(SUM({c}) AS {MONEY}) AS {c}" for c in _BB_MONEY)},
    {", ".join(f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in _BB_COUNT)}
  FROM brand_summary GROUP BY month
),
bb1 AS (
  SELECT *, CAST(deposits - withdrawals AS {MONEY}) AS net_deposits, {pct('ggr', 'turnover')} AS margin,
    {rev_share('ggr')} AS revenue_share_deduction,
    CAST(new_players + returning_players AS BIGINT) AS total_players
  FROM bb0
),
bb AS (
  SELECT *, CAST(ggr - revenue_share_deduction AS {MONEY}) AS net_income,
    {pct('new_players', 'total_players')} AS new_players_pct,
    {pct('returning_players', 'total_players')} AS returning_players_pct,
    {div('ggr', 'total_players')} AS ggr_per_player,
    {div('CAST(ggr - revenue_share_deduction AS DECIMAL(18,2))', 'total_players')} AS income_per_player,
    {div('turnover', 'total_players')} AS turnover_per_player
  FROM bb1
)"""

_BB_OUT_MONEY = set(_BB_MONEY) | {"turnover", "net_deposits", "revenue_share_deduction", "net_income"}
F7 = with_player_activity(f""", {summary_ctes(False)}, {BB_CTE}
SELECT {", ".join((f"CAST({c} AS DOUBLE) AS {c}" if c in _BB_OUT_MONEY else c) for c in FIN.BOTH_BUSINESS_COLS)}
FROM bb""")


def _ts_sql(src_cte: str, entity: str) -> str:
    """F8–F10 over a padded summary CTE having entity, month and TS metrics.

    Money metrics stay DECIMAL (exact window sums) until the final projection."""
    ms = list(FIN.TS_METRICS)
    w = f"OVER (PARTITION BY {entity} ORDER BY month)"

    def typed(expr, m):
        return f"CAST({expr} AS {'BIGINT' if m in FIN.COUNT_COLS else 'DOUBLE'})"

    cols = [entity, "month"] + [typed(f"_{m}", m) + f" AS {m}" for m in ms]
    for m in ms:
        prev = f"LAG(_{m}, 1) {w}"
        cols.append(typed(f"_{m} - {prev}", m) + f" AS {m}_mom_delta")
        cols.append(f"{pct(f'_{m} - {prev}', prev)} AS {m}_mom_pct")
    for m in ms:
        prev = f"LAG(_{m}, 12) {w}"
        cols.append(typed(f"_{m} - {prev}", m) + f" AS {m}_yoy_delta")
        cols.append(f"{pct(f'_{m} - {prev}', prev)} AS {m}_yoy_pct")
    for m in ms:
        cols.append(typed(f"_{m}_ytd", m) + f" AS {m}_ytd")
    frame = f"OVER (PARTITION BY {entity} ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
    mon = "CAST(substr(month, 6, 2) AS INTEGER)"
    for p in ["ggr", "turnover"]:
        cols.append(f"CAST(_{p}_ytd AS DOUBLE) + CAST(SUM(_{p}) {frame} AS DOUBLE) / COUNT(_{p}) {frame} * (12 - {mon}) "
                    f"AS eoy_momentum_{p}")
        prev_ytd = f"LAG(_{p}_ytd, 12) {w}"
        prev_tot = f"LAG(_{p}_yt, 12) {w}"
        cols.append(f"CASE WHEN {prev_ytd} IS NOT NULL AND {prev_ytd} <> 0 THEN CAST(_{p}_ytd AS DOUBLE) * "
                    f"(CAST({prev_tot} AS DOUBLE) / CAST({prev_ytd} AS DOUBLE)) "
                    f"ELSE CAST(_{p}_ytd AS DOUBLE) / {mon} * 12 END AS eoy_seasonal_{p}")
    wy = f"OVER (PARTITION BY {entity}, substr(month, 1, 4) ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    base_cols = ", ".join(f"{m} AS _{m}" for m in ms)
    ytd_cols = ", ".join(f"SUM(_{m}) {wy} AS _{m}_ytd" for m in ms)
    body = ",\n  ".join(cols)
    return f"""ts0 AS (
  SELECT {entity}, month, {base_cols} FROM {src_cte}
),
ts1 AS (
  SELECT *, {ytd_cols},
    SUM(_ggr) OVER (PARTITION BY {entity}, substr(month, 1, 4)) AS _ggr_yt,
    SUM(_turnover) OVER (PARTITION BY {entity}, substr(month, 1, 4)) AS _turnover_yt
  FROM ts0
),
ts2 AS (
  SELECT {body} FROM ts1
),
ts AS (
  SELECT *, eoy_momentum_ggr * CAST(0.15 AS DOUBLE) AS eoy_momentum_revenue_share_deduction,
    eoy_seasonal_ggr * CAST(0.15 AS DOUBLE) AS eoy_seasonal_revenue_share_deduction
  FROM ts2
)"""


_TS_SRC = "tsrc AS (SELECT brand, month, total_handle AS turnover, * EXCLUDE (brand, month) FROM full_summary)"

F8 = with_player_activity(f""", {summary_ctes(True)}, {_TS_SRC}, {_ts_sql('tsrc', 'brand')}
SELECT * FROM ts""")


def _q_sql(src: str, entity: str) -> str:
    ms = FIN.TS_METRICS
    q = "substr(month, 1, 4) || 'Q' || CAST((CAST(substr(month, 6, 2) AS INTEGER) - 1) // 3 + 1 AS VARCHAR)"
    w = f"OVER (PARTITION BY {entity} ORDER BY quarter)"

    def typed(expr, m):
        return f"CAST({expr} AS {'BIGINT' if m in FIN.COUNT_COLS else 'DOUBLE'})"

    cols = [entity, "quarter"] + [typed(m, m) + f" AS {m}" for m in ms]
    for m in ms:
        prev = f"LAG({m}, 1) {w}"
        cols.append(typed(f"{m} - {prev}", m) + f" AS {m}_qoq_delta")
        cols.append(f"{pct(f'{m} - {prev}', prev)} AS {m}_qoq_pct")
    sums = ", ".join(
        (f"CAST(SUM({m}) AS BIGINT) AS {m}" if m in FIN.COUNT_COLS else f"CAST(SUM({m}) AS DECIMAL(38,2)) AS {m}")
        for m in ms)
    return f"""qa AS (SELECT {entity}, {q} AS quarter, {sums} FROM {src} GROUP BY {entity}, quarter)
SELECT {", ".join(cols)} FROM qa"""


F11 = with_player_activity(f""", {summary_ctes(True)}, {_TS_SRC}, {_q_sql('tsrc', 'brand')}""")

F12 = with_player_activity(f"""
SELECT brand, report_month AS month, wb_tag, CAST(COUNT(id) AS BIGINT) AS total_players,
  CAST({msum('revenue')} AS DOUBLE) AS ggr
FROM player_activity WHERE brand IS NOT NULL AND report_month IS NOT NULL AND wb_tag IS NOT NULL
GROUP BY brand, report_month, wb_tag""")

F13 = with_player_activity(f"""
SELECT brand, month, program, CAST(ggr AS DOUBLE) AS ggr, CAST(turnover AS DOUBLE) AS turnover, total_players,
  {pct('ggr', 'turnover')} AS margin
FROM (SELECT brand, report_month AS month, wb_tag AS program, {msum('revenue')} AS ggr, {msum('bet')} AS turnover,
        CAST(COUNT(DISTINCT id) AS BIGINT) AS total_players
      FROM player_activity WHERE brand IS NOT NULL AND report_month IS NOT NULL AND wb_tag IS NOT NULL
      GROUP BY brand, report_month, wb_tag)""")

F14 = with_player_activity(f"""
SELECT CASE WHEN country = 'Global' THEN 'Unknown' ELSE country END AS country, total_players,
  CAST(turnover AS DOUBLE) AS turnover, CAST(ggr AS DOUBLE) AS ggr, CAST(ngr AS DOUBLE) AS ngr,
  CAST(deposits AS DOUBLE) AS deposits, {pct('ggr', 'turnover')} AS margin
FROM (SELECT country, CAST(COUNT(DISTINCT id) AS BIGINT) AS total_players, {msum('bet')} AS turnover,
        {msum('revenue')} AS ggr, {msum('ngr')} AS ngr, {msum('deposits')} AS deposits
      FROM player_activity WHERE country IS NOT NULL GROUP BY country)""")

F15 = with_player_activity(f"""
SELECT segment, total_players, CAST(total_turnover AS DOUBLE) AS total_turnover, CAST(total_ggr AS DOUBLE) AS total_ggr,
  CAST(total_ngr AS DOUBLE) AS total_ngr, CAST(total_bonus AS DOUBLE) AS total_bonus,
  {div('total_ngr', 'total_players')} AS avg_ngr_per_player,
  CASE WHEN total_turnover > 0 THEN CAST(total_ggr AS DOUBLE) / CAST(total_turnover AS DOUBLE) * CAST(100 AS DOUBLE)
       ELSE CAST(0 AS DOUBLE) END AS margin_pct,
  CAST({rev_share('total_ngr')} AS DOUBLE) AS rev_share_15,
  CAST(CAST(total_ngr - {rev_share('total_ngr')} AS DECIMAL(18,2)) AS DOUBLE) AS actual_earning
FROM (SELECT COALESCE(segment, wb_tag) AS segment, CAST(COUNT(DISTINCT id) AS BIGINT) AS total_players,
        {msum('bet')} AS total_turnover, {msum('revenue')} AS total_ggr, {msum('ngr')} AS total_ngr,
        {msum('bonus_total')} AS total_bonus
      FROM player_activity WHERE COALESCE(segment, wb_tag) IS NOT NULL GROUP BY COALESCE(segment, wb_tag))""")

F17 = with_player_activity(f""", {summary_ctes(True)},
latest AS (SELECT brand, MAX(month) AS month FROM full_summary WHERE total_players > 0 GROUP BY brand),
l AS (SELECT s.* FROM full_summary s JOIN latest USING (brand, month))
SELECT brand, month, step, amount FROM (
  SELECT brand, month, 'GGR' AS step, CAST(ggr AS DOUBLE) AS amount FROM l
  UNION ALL SELECT brand, month, 'Bonus', -CAST(bonus_total AS DOUBLE) FROM l
  UNION ALL SELECT brand, month, 'Tax', -CAST(tax_total AS DOUBLE) FROM l
  UNION ALL SELECT brand, month, 'NGR', CAST(ngr AS DOUBLE) FROM l)""")

F20 = with_player_activity(f""", {summary_ctes(True)}
SELECT brand, month,
  CAST(GREATEST(new_player_ggr, 0) AS DOUBLE) AS new_profit, CAST(LEAST(new_player_ggr, 0) AS DOUBLE) AS new_loss,
  CAST(GREATEST(returning_player_ggr, 0) AS DOUBLE) AS returning_profit,
  CAST(LEAST(returning_player_ggr, 0) AS DOUBLE) AS returning_loss
FROM full_summary""")

F22 = with_player_activity("""
SELECT 'brand' AS level, brand AS key, CAST(COUNT(*) AS BIGINT) AS rows FROM player_activity GROUP BY brand
UNION ALL
SELECT 'month', report_month, CAST(COUNT(*) AS BIGINT) FROM player_activity GROUP BY report_month""")

F24 = with_player_activity(f""", {summary_ctes(True)},
r AS (SELECT brand, month, {", ".join(f"{m}, {m} - LAG({m}) OVER (PARTITION BY brand ORDER BY month) AS {m}_delta" for m in FIN.KPI_CARDS)},
  {", ".join(FIN.KPI_RATIOS)} FROM full_summary),
last AS (SELECT brand, MAX(month) AS month FROM full_summary WHERE brand <> 'Combined' OR total_players > 0 GROUP BY brand)
SELECT brand, month, CAST(ggr AS DOUBLE) AS ggr, CAST(ggr_delta AS DOUBLE) AS ggr_delta,
  CAST(total_handle AS DOUBLE) AS total_handle, CAST(total_handle_delta AS DOUBLE) AS total_handle_delta,
  CAST(total_players AS BIGINT) AS total_players, CAST(total_players_delta AS BIGINT) AS total_players_delta,
  hold_pct, retention_pct, profitable_pct, turnover_per_player
FROM r JOIN last USING (brand, month)""")

# the seven rows of the matrix: metric, value, and the time-series metric whose changes it shows
_EXEC = [("turnover", "total_handle", "turnover"), ("ggr", "ggr", "ggr"), ("margin_pct", "hold_pct", None),
         ("revenue_15", "revenue_share_deduction", "revenue_share_deduction"), ("conversions", "conversions", "conversions"),
         ("turnover_per_player", "turnover_per_player", None), ("whale_risk_pct", "top_10_pct_ggr_share", None)]


def _exec_row(metric: str, value: str, change: str | None) -> str:
    pcts = ", ".join(f"{f'ts.{change}_{x}_pct' if change else 'CAST(NULL AS DOUBLE)'} AS {x}_pct" for x in ("mom", "yoy"))
    return f"SELECT brand, month, '{metric}' AS metric, CAST(l.{value} AS DOUBLE) AS value, {pcts} FROM l LEFT JOIN ts USING (brand, month)"


F18 = with_player_activity(f""", {summary_ctes(True)}, {_TS_SRC}, {_ts_sql('tsrc', 'brand')},
latest AS (SELECT brand, MAX(month) AS month FROM full_summary WHERE total_players > 0 GROUP BY brand),
l AS (SELECT s.* FROM full_summary s JOIN latest USING (brand, month))
{" UNION ALL ".join(_exec_row(*r) for r in _EXEC)}""")

_DEMO = ["total_players", "conversions", "new_players", "reactivated_players", "returning_players", "profitable_players",
         "negative_yield_players", "net_deposits", "deposits", "withdrawals", "bonus_total"]
F19 = with_player_activity(f""", {summary_ctes(True)},
latest AS (SELECT brand, MAX(month) AS month FROM full_summary WHERE total_players > 0 GROUP BY brand),
k AS (SELECT s.* FROM full_summary s JOIN latest USING (brand, month))
{" UNION ALL ".join(f"SELECT brand, month, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM k" for m in _DEMO)}""")

F16 = None  # defined in oracle_ops (needs the operations adapter)

ORACLES = {
    "f1_monthly_financials": F1,
    "f2_whale_share": F2,
    "f2b_whale_share_combined": F2_COMBINED,
    "f3_cohort_counts": F3,
    "f4_month_padding": F4,
    "f5_monthly_brand_summary": F5,
    "f6_combined_summary": F6,
    "f7_both_business_summary": F7,
    "f8_time_series": F8,
    "f11_quarterly": F11,
    "f12_segmentation": F12,
    "f13_program_summary": F13,
    "f14_geographic_summary": F14,
    "f15_segment_roi": F15,
    "f17_gross_to_net_bridge": F17,
    "f18_executive_matrix": F18,
    "f19_demographics_matrix": F19,
    "f20_revenue_composition": F20,
    "f22_ingest_diagnostics": F22,
    "f24_kpi_deltas": F24,
}

# ---------------------------------------------------------------------------
# F9 / F10 (projections of the time series) and F23 (comparative table)
# ---------------------------------------------------------------------------

F9 = with_player_activity(f""", {summary_ctes(True)}, {_TS_SRC}, {_ts_sql('tsrc', 'brand')}
SELECT brand, month, {", ".join(f"{m}_ytd" for m in FIN.TS_METRICS)} FROM ts""")

_EOY = [f"eoy_{e}_{m}" for e in ("momentum", "seasonal") for m in ("ggr", "turnover", "revenue_share_deduction")]
F10 = with_player_activity(f""", {summary_ctes(True)}, {_TS_SRC}, {_ts_sql('tsrc', 'brand')}
SELECT brand, month, {", ".join(_EOY)} FROM ts""")


def _qq_cte(src: str, entity: str) -> str:
    ms = FIN.TS_METRICS
    q = "substr(month, 1, 4) || 'Q' || CAST((CAST(substr(month, 6, 2) AS INTEGER) - 1) // 3 + 1 AS VARCHAR)"
    w = f"OVER (PARTITION BY {entity} ORDER BY quarter)"
    sums = ", ".join(
        (f"CAST(SUM({m}) AS BIGINT) AS {m}" if m in FIN.COUNT_COLS else f"CAST(SUM({m}) AS DECIMAL(38,2)) AS {m}")
        for m in ms)
    cols = [entity, "quarter"]
    for m in ms:
        prev = f"LAG({m}, 1) {w}"
        cols.append(f"CAST({m} - {prev} AS DOUBLE) AS {m}_qoq_delta")
        cols.append(f"{pct(f'{m} - {prev}', prev)} AS {m}_qoq_pct")
    return (f"qa AS (SELECT {entity}, {q} AS quarter, {sums} FROM {src} GROUP BY {entity}, quarter),\n"
            f"qq AS (SELECT {', '.join(cols)} FROM qa)")


def _f23() -> str:
    money = ["turnover", "ggr", "revenue_share_deduction"]
    players = ["total_players", "new_players", "returning_players", "reactivated_players", "conversions",
               "profitable_players", "negative_yield_players"]
    sel = []
    for m in money + players:
        sel.append(f"SELECT brand, month, '{m}' AS metric, CAST({m} AS DOUBLE) AS value, CAST({m}_mom_delta AS DOUBLE) AS mom_delta, "
                   f"CAST({m}_mom_pct AS DOUBLE) AS mom_pct, CAST({m}_yoy_delta AS DOUBLE) AS yoy_delta, "
                   f"CAST({m}_yoy_pct AS DOUBLE) AS yoy_pct, CAST({m}_ytd AS DOUBLE) AS ytd, "
                   f"CAST({m}_qoq_delta AS DOUBLE) AS qoq_delta, CAST({m}_qoq_pct AS DOUBLE) AS qoq_pct FROM k")
    for col in _EOY:
        sel.append(f"SELECT brand, month, '{col}', CAST({col} AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), "
                   f"CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), "
                   f"CAST(NULL AS DOUBLE) FROM k")
    q = "substr(ts.month, 1, 4) || 'Q' || CAST((CAST(substr(ts.month, 6, 2) AS INTEGER) - 1) // 3 + 1 AS VARCHAR)"
    qcols = ", ".join(f"qq.{m}_qoq_delta, qq.{m}_qoq_pct" for m in FIN.TS_METRICS)
    return with_player_activity(f""", {summary_ctes(True)}, {_TS_SRC}, {_ts_sql('tsrc', 'brand')}, {_qq_cte('tsrc', 'brand')},
latest AS (SELECT brand, MAX(month) AS month FROM full_summary WHERE total_players > 0 GROUP BY brand),
k AS (SELECT ts.*, {qcols} FROM ts JOIN latest USING (brand, month)
      LEFT JOIN qq ON qq.brand = ts.brand AND qq.quarter = {q})
{" UNION ALL ".join(sel)}""")


F23 = _f23()

ORACLES.update({"f9_ytd": F9, "f10_eoy_projections": F10, "f23_comparative_table": F23})


def _f21() -> str:
    t = FIN.NARRATIVE

    def q(v):
        return "'" + v.replace("'", "''") + "'"

    def fixed(x, d):
        return f"CAST(CAST(ROUND(CAST(CAST({x} AS DOUBLE) AS DECIMAL(38,10)), {d}) AS DECIMAL(38,{d})) AS VARCHAR)"

    def grouped(x):
        return f"format('{{:,}}', CAST(ROUND(CAST(CAST({x} AS DOUBLE) AS DECIMAL(38,10)), 0) AS BIGINT))"

    mom = "COALESCE(ggr_mom_pct, CAST(0 AS DOUBLE))"
    delta = "COALESCE(CAST(ggr_mom_delta AS DOUBLE), CAST(0 AS DOUBLE))"
    signed = (f"CASE WHEN ROUND(CAST({delta} AS DECIMAL(38,10)), 0) >= 0 THEN '+' ELSE '' END || {grouped(delta)}")
    s1 = (f"CASE WHEN {mom} >= 0 THEN {q(t['grew'][0])} || {fixed(mom, 1)} || {q(t['grew'][1])} || {signed} || {q(t['grew'][2])} "
          f"ELSE {q(t['declined'][0])} || {fixed(mom, 1)} || {q(t['declined'][1])} || {grouped(delta)} || {q(t['declined'][2])} END")

    def sent(k, v, d):
        return f"{q(t[k][0])} || {fixed(v, d)} || {q(t[k][1])}"

    s2 = (f"CASE WHEN margin >= 5.0 THEN {sent('margin_ok', 'margin', 2)} WHEN margin >= 2.5 THEN {sent('margin_mid', 'margin', 2)} "
          f"ELSE {sent('margin_low', 'margin', 2)} END")
    w = "top_10_pct_ggr_share"
    s3 = (f"CASE WHEN {w} >= 70 THEN {sent('whale_high', w, 1)} WHEN {w} >= 50 THEN {sent('whale_mid', w, 1)} "
          f"ELSE {sent('whale_low', w, 1)} END")
    return with_player_activity(f""", {summary_ctes(True)}, {_TS_SRC}, {_ts_sql('tsrc', 'brand')},
latest AS (SELECT brand, MAX(month) AS month FROM full_summary WHERE total_players > 0 GROUP BY brand),
l AS (SELECT s.brand, s.month, {pct('s.ggr', 's.total_handle')} AS margin, s.top_10_pct_ggr_share
      FROM full_summary s JOIN latest USING (brand, month)),
x AS (SELECT l.*, ts.ggr_mom_pct, ts.ggr_mom_delta FROM l LEFT JOIN ts USING (brand, month))
SELECT brand, month, concat_ws(chr(10) || chr(10), {s1}, {s2}, {s3}) AS narrative FROM x""")


F21 = _f21()
ORACLES["f21_diagnostic_narrative"] = F21

F17B = with_player_activity(f""", {summary_ctes(True)}
SELECT brand, month, CAST(ggr_casino AS DOUBLE) AS ggr_casino, CAST(ggr_sports AS DOUBLE) AS ggr_sports,
  CAST(ngr_casino AS DOUBLE) AS ngr_casino, CAST(ngr_sports AS DOUBLE) AS ngr_sports FROM full_summary""")
ORACLES["f17b_vertical_split"] = F17B
