"""DuckDB oracle SQL for the CRM block (K*)."""

from __future__ import annotations

from ..operators import crm as K
from .sqlkit import div, month_index, msum, pct, values_list, with_player_activity, with_player_lines

MONEY = "DECIMAL(18,2)"


def _first(c: str) -> str:
    return (f"arg_min({c}, CASE WHEN {c} IS NOT NULL THEN COALESCE(report_month, '') || '|' || COALESCE({c}, '') END)")


def _last_bet(tiebreak: str | None) -> str:
    key = "report_month" if tiebreak is None else f"COALESCE(report_month, '') || '|' || COALESCE({tiebreak}, '')"
    return f"arg_max(bet, CASE WHEN bet IS NOT NULL THEN {key} END)"


_LIFETIME = f"""{msum('revenue')} AS lifetime_ggr, {msum('ngr')} AS lifetime_ngr, {msum('bet')} AS lifetime_turnover,
    {msum('deposits')} AS lifetime_deposits, CAST(COALESCE(SUM(deposit_count), 0) AS BIGINT) AS lifetime_deposit_count,
    {msum('withdrawals')} AS lifetime_withdrawals, {msum('bonus_total')} AS lifetime_bonus,
    MIN(report_month) AS first_month, MAX(report_month) AS last_month,
    CAST(COUNT(DISTINCT report_month) AS BIGINT) AS months_active"""

_GMAX = f"(SELECT MAX({month_index('report_month')}) FROM player_activity)"
_RECENCY = f"""CAST({_GMAX} - {month_index('last_month')} AS BIGINT) AS months_inactive,
    CAST({month_index('last_month')} - {month_index('first_month')} + 1 AS BIGINT) AS tenure_months,
    {div('lifetime_deposits', 'lifetime_deposit_count')} AS avg_deposit_value"""


def _rule_a() -> str:
    return f"""CASE
      WHEN months_active >= 6 AND months_inactive = 0 AND months_active = tenure_months THEN '{K.IRONMAN}'
      WHEN lifetime_ggr < 0 AND lifetime_turnover > 5000 THEN '{K.PROMO_EXCLUSION}'
      WHEN months_inactive = 1 AND lifetime_ggr > 500 THEN '{K.EARLY_CHURN}'
      WHEN months_active <= 2 AND lifetime_turnover > 1000 AND months_inactive = 0 THEN '{K.RISING_STAR}'
      WHEN months_inactive >= 3 AND lifetime_ggr > 1000 THEN '{K.COLD_CROWN}'
      WHEN lifetime_ggr >= 1000 AND months_inactive = 0 THEN '{K.ACTIVE_CROWN}'
      WHEN months_inactive = 0 AND CAST(last_month_turnover AS DOUBLE) < avg_monthly_turnover * CAST(0.5 AS DOUBLE)
           AND lifetime_turnover >= 1000 THEN '{K.COOLING}'
      ELSE '{K.STANDARD}' END"""


def _rule_b() -> str:
    return f"""CASE
      WHEN months_active >= 6 AND months_inactive = 0 AND months_active = tenure_months THEN '{K.IRONMAN}'
      WHEN lifetime_ggr >= 1000 AND months_inactive = 0 THEN '{K.ACTIVE_CROWN}'
      WHEN months_inactive = 0 AND CAST(last_month_turnover AS DOUBLE) < avg_monthly_turnover * CAST(0.5 AS DOUBLE)
           AND lifetime_turnover >= 1000 THEN '{K.COOLING_B}'
      WHEN lifetime_ggr < 0 AND lifetime_turnover > 5000 THEN '{K.PROMO_EXCLUSION_B}'
      WHEN months_inactive = 1 AND lifetime_ggr > 500 THEN '{K.EARLY_CHURN}'
      WHEN months_active <= 2 AND lifetime_turnover > 1000 AND months_inactive = 0 THEN '{K.RISING_STAR}'
      WHEN months_inactive >= 3 AND lifetime_ggr > 1000 THEN '{K.COLD_CROWN}'
      ELSE '{K.STANDARD}' END"""


_MONEY_OUT = ["lifetime_ggr", "lifetime_ngr", "lifetime_turnover", "lifetime_deposits", "lifetime_withdrawals",
              "lifetime_bonus", "last_month_turnover"]

K1_CTE = f"""k1a AS (
  SELECT id, brand, {_first('client')} AS client, {_LIFETIME},
    {_last_bet(None)} AS last_month_turnover
  FROM player_activity WHERE id IS NOT NULL AND brand IS NOT NULL GROUP BY id, brand
),
k1b AS (
  SELECT * REPLACE (COALESCE(last_month_turnover, CAST(0 AS {MONEY})) AS last_month_turnover), {_RECENCY},
    CAST(lifetime_turnover AS DOUBLE) / GREATEST(months_active, 1) AS avg_monthly_turnover
  FROM k1a
),
k1 AS (SELECT *, {_rule_a()} AS recommended_campaign FROM k1b)"""

K3_CTE = f"""k3a AS (
  SELECT id, {_LIFETIME}, {_first('brand')} AS brand, {_first('country')} AS country, {_first('client')} AS client,
    {_last_bet('brand')} AS last_month_turnover
  FROM player_activity WHERE id IS NOT NULL GROUP BY id
),
k3 AS (
  SELECT * REPLACE (COALESCE(last_month_turnover, CAST(0 AS {MONEY})) AS last_month_turnover), {_RECENCY},
    {div('lifetime_turnover', 'months_active')} AS avg_monthly_turnover,
    lifetime_ggr >= 500 AS is_vip
  FROM k3a
),
profiles AS (SELECT *, {_rule_b()} AS smart_profile FROM k3)"""


def _out(src: str, money=_MONEY_OUT) -> str:
    return f"SELECT * REPLACE ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in money)}) FROM {src}"


K1 = with_player_activity(f", {K1_CTE}\n{_out('k1')}")
K3 = with_player_activity(f", {K3_CTE}\n{_out('k3')}")
K4 = with_player_activity(f", {K3_CTE}\n{_out('profiles')}")

_TIERS = """CASE WHEN frequency >= 3 AND monetary > 0 AND recent = 1 THEN 'True VIP'
       WHEN frequency >= 3 AND monetary > 0 AND recent = 0 THEN 'Churn Risk' ELSE 'Casual' END"""

K5 = with_player_activity(f""",
pl AS (
  SELECT id, COUNT(DISTINCT report_month) AS frequency, {msum('revenue')} AS monetary,
    MAX(CASE WHEN report_month = (SELECT MAX(report_month) FROM player_activity) THEN 1 ELSE 0 END) AS recent
  FROM player_activity WHERE id IS NOT NULL GROUP BY id)
SELECT {_TIERS} AS tier, CAST(COUNT(*) AS BIGINT) AS players, CAST(CAST(SUM(monetary) AS {MONEY}) AS DOUBLE) AS ggr
FROM pl GROUP BY tier""")

K5B = with_player_activity(f""",
latest AS (SELECT brand, MAX(report_month) AS target FROM player_activity GROUP BY brand),
pl AS (
  SELECT p.brand, p.id, COUNT(DISTINCT p.report_month) AS frequency, {msum('p.revenue')} AS monetary,
    MAX(CASE WHEN p.report_month = l.target THEN 1 ELSE 0 END) AS recent
  FROM player_activity p JOIN latest l ON p.brand = l.brand
  WHERE p.id IS NOT NULL AND p.brand IS NOT NULL GROUP BY p.brand, p.id)
SELECT brand, {_TIERS} AS tier, CAST(COUNT(*) AS BIGINT) AS players,
  CAST(CAST(SUM(monetary) AS {MONEY}) AS DOUBLE) AS ggr
FROM pl GROUP BY brand, tier""")

OVERLAP_BRANDS = ("PROMO", "STANDARD")

K6 = with_player_activity(f""",
both_ids AS (SELECT id FROM player_activity WHERE brand IN ('{OVERLAP_BRANDS[0]}', '{OVERLAP_BRANDS[1]}')
             GROUP BY id HAVING COUNT(DISTINCT brand) > 1)
SELECT '{OVERLAP_BRANDS[0]}' AS brand_1, '{OVERLAP_BRANDS[1]}' AS brand_2,
  (SELECT CAST(COUNT(*) AS BIGINT) FROM both_ids) AS overlap_count,
  CAST({msum('revenue')} AS DOUBLE) AS overlap_ggr
FROM player_activity WHERE id IN (SELECT id FROM both_ids)""")

K6B = with_player_activity(f""",
multi AS (SELECT id FROM player_activity GROUP BY id HAVING COUNT(DISTINCT brand) > 1),
rev AS (SELECT id, {msum('revenue')} AS rev FROM player_activity WHERE id IN (SELECT id FROM multi) GROUP BY id),
pb AS (SELECT DISTINCT brand, id FROM player_activity WHERE id IN (SELECT id FROM multi))
SELECT brand, CAST(COUNT(*) AS BIGINT) AS shared_players, CAST(CAST(SUM(rev) AS {MONEY}) AS DOUBLE) AS shared_players_ggr
FROM pb JOIN rev USING (id) GROUP BY brand""")

_COHORT_ROWS = f"""cr0 AS (
  SELECT id, report_month AS month, {msum('revenue')} AS revenue
  FROM player_activity WHERE id IS NOT NULL AND report_month IS NOT NULL GROUP BY id, report_month
),
cr AS (SELECT *, MIN(month) OVER (PARTITION BY id) AS cohort_month FROM cr0)"""

K7 = with_player_activity(f""", {_COHORT_ROWS},
g AS (
  SELECT cohort_month, CAST({month_index('month')} - {month_index('cohort_month')} AS BIGINT) AS month_index,
    CAST(SUM(revenue) AS {MONEY}) AS ggr
  FROM cr WHERE {month_index('month')} - {month_index('cohort_month')} >= 0 GROUP BY cohort_month, month_index)
SELECT cohort_month, month_index, CAST(ggr AS DOUBLE) AS ggr,
  CAST(SUM(ggr) OVER (PARTITION BY cohort_month ORDER BY month_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
    AS cumulative_ggr
FROM g""")


def _k8_part(keys: str, where: str, label: str | None) -> str:
    kp = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys} " if keys else ""
    join_k = f"{keys}, " if keys else ""
    brand_sel = f"'{label}' AS brand" if label else "brand"
    p = label or "b"
    return f"""{p}_r0 AS (
  SELECT {kp}id, report_month AS month FROM player_activity
  WHERE id IS NOT NULL AND report_month IS NOT NULL {where} GROUP BY {kp}id, report_month
),
{p}_r AS (SELECT *, MIN(month) OVER (PARTITION BY {kp}id) AS cohort_month FROM {p}_r0),
{p}_m AS (SELECT {kp}month, DENSE_RANK() OVER ({part}ORDER BY month) AS mi FROM (SELECT DISTINCT {kp}month FROM {p}_r)),
{p}_x AS (
  SELECT r.*, CAST(m.mi - c.mi AS INTEGER) AS "offset" FROM {p}_r r
  JOIN {p}_m m USING ({join_k}month)
  JOIN {p}_m c ON {' AND '.join([f'c.{k.strip()} = r.{k.strip()}' for k in keys.split(',')] + ['c.month = r.cohort_month']) if keys else 'c.month = r.cohort_month'}
),
{p}_sizes AS (SELECT {kp}cohort_month, COUNT(*) AS cohort_size FROM {p}_x WHERE "offset" = 0 GROUP BY {kp}cohort_month),
{p}_act AS (SELECT {kp}cohort_month, "offset", COUNT(*) AS active_players FROM {p}_x WHERE "offset" > 0
            GROUP BY {kp}cohort_month, "offset"),
{p}_out AS (
  SELECT {brand_sel}, cohort_month, CAST("offset" AS BIGINT) AS "offset", CAST(active_players AS BIGINT) AS active_players,
    CAST(cohort_size AS BIGINT) AS cohort_size,
    CAST(active_players AS DOUBLE) / CAST(cohort_size AS DOUBLE) * CAST(100 AS DOUBLE) AS retention_pct
  FROM {p}_act JOIN {p}_sizes USING ({kp}cohort_month)
)"""


K8 = with_player_activity(f""", {_k8_part('brand', 'AND brand IS NOT NULL', None)},
{_k8_part('', '', 'Combined')}
SELECT * FROM b_out UNION ALL SELECT * FROM Combined_out""")

K9 = with_player_activity(f""", {_COHORT_ROWS},
g AS (SELECT cohort_month, CAST({month_index('month')} - {month_index('cohort_month')} AS BIGINT) AS month_index,
        CAST(COUNT(*) AS BIGINT) AS players FROM cr GROUP BY cohort_month, month_index)
SELECT g.cohort_month, g.month_index, g.players, CAST(g.players AS DOUBLE) / CAST(b.players AS DOUBLE) AS retention
FROM g LEFT JOIN (SELECT cohort_month, players FROM g WHERE month_index = 0) b USING (cohort_month)""")

K10 = with_player_activity(f""",
pl AS (SELECT id, {msum('revenue')} AS lifetime_ggr FROM player_activity WHERE id IS NOT NULL GROUP BY id),
p AS (SELECT * FROM pl WHERE lifetime_ggr > 0),
r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY lifetime_ggr DESC, id) AS rk,
        SUM(lifetime_ggr) OVER (ORDER BY lifetime_ggr DESC, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
        SUM(lifetime_ggr) OVER () AS tot, COUNT(*) OVER () AS n FROM p)
SELECT id, CAST(lifetime_ggr AS DOUBLE) AS lifetime_ggr, CAST(CAST(cum AS {MONEY}) AS DOUBLE) AS cumulative_ggr,
  CAST(cum AS DOUBLE) / CAST(tot AS DOUBLE) * CAST(100 AS DOUBLE) AS cumulative_ggr_pct,
  CAST(rk AS BIGINT) AS player_rank,
  CAST(rk AS DOUBLE) / CAST(n AS DOUBLE) * CAST(100 AS DOUBLE) AS cumulative_players_pct
FROM r""")

K11 = with_player_activity(f""",
pl AS (SELECT id, {msum('ngr')} AS ngr FROM player_activity WHERE id IS NOT NULL GROUP BY id),
p AS (SELECT * FROM pl WHERE ngr > 0),
r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY ngr DESC, id) AS rk, COUNT(*) OVER () AS n FROM p),
t AS (SELECT *, LEAST(GREATEST(1, n // 100), n) AS t1 FROM r),
t2 AS (SELECT *, LEAST(GREATEST(t1 + 1, n // 20), n) AS t5 FROM t),
t3 AS (SELECT *, LEAST(GREATEST(t5 + 1, n // 5), n) AS t20 FROM t2),
g AS (SELECT CASE WHEN rk <= t1 THEN 0 WHEN rk <= t5 THEN 1 WHEN rk <= t20 THEN 2 ELSE 3 END AS tid,
        COUNT(*) AS player_count, CAST(SUM(ngr) AS {MONEY}) AS ngr_generated FROM t3 GROUP BY tid),
tiers(tid, tier) AS (VALUES {values_list(list(enumerate(K.PARETO_TIERS)))})
SELECT tier, CAST(COALESCE(player_count, 0) AS BIGINT) AS player_count,
  CAST(COALESCE(ngr_generated, CAST(0 AS {MONEY})) AS DOUBLE) AS ngr_generated,
  {pct(f'COALESCE(ngr_generated, CAST(0 AS {MONEY}))', '(SELECT SUM(ngr) FROM p)')} AS revenue_share
FROM tiers LEFT JOIN g USING (tid)""")

K12 = with_player_activity(f""",
pl AS (SELECT id, {msum('bet_casino')} AS bc, {msum('bet_sports')} AS bs, {msum('ngr')} AS ngr
       FROM player_activity WHERE id IS NOT NULL GROUP BY id),
a AS (SELECT *, CASE WHEN bc > 0 AND bs > 0 THEN 'Omnichannel' WHEN bc > 0 AND bs <= 0 THEN 'Casino Only'
                     WHEN bc <= 0 AND bs > 0 THEN 'Sportsbook Only' ELSE 'Inactive' END AS affinity FROM pl)
SELECT affinity, CAST(COUNT(*) AS BIGINT) AS players, CAST(CAST(SUM(ngr) AS {MONEY}) AS DOUBLE) AS total_ngr,
  {div(f'CAST(SUM(ngr) AS {MONEY})', 'COUNT(*)')} AS avg_ngr_per_player
FROM a GROUP BY affinity""")


def _velocity_case() -> str:
    parts = []
    for lo, hi, name in K.VELOCITY_BINS:
        cond = f"reactivation_days > {lo}" if hi is None else f"reactivation_days > {lo} AND reactivation_days <= {hi}"
        parts.append(f"WHEN {cond} THEN '{name}'")
    return "CASE " + " ".join(parts) + " END"


K13 = with_player_lines(f""",
x AS (SELECT *, {_velocity_case()} AS velocity FROM player_lines WHERE reactivation_days IS NOT NULL),
g AS (SELECT velocity, COUNT(DISTINCT id) AS rp, {msum('deposits')} AS dep, {msum('ngr')} AS ngr
      FROM x WHERE velocity IS NOT NULL GROUP BY velocity),
bins(velocity) AS (VALUES {", ".join(f"('{b[2]}')" for b in K.VELOCITY_BINS)})
SELECT velocity, CAST(COALESCE(rp, 0) AS BIGINT) AS reactivated_players,
  CAST(COALESCE(dep, 0) AS DOUBLE) AS total_deposits, CAST(COALESCE(ngr, 0) AS DOUBLE) AS total_ngr
FROM bins LEFT JOIN g USING (velocity)""")

K14 = with_player_activity(f""",
lm AS (SELECT MAX(report_month) AS latest FROM player_activity),
pm AS (SELECT MAX(report_month) AS prev FROM player_activity WHERE report_month < (SELECT latest FROM lm)),
x AS (SELECT * FROM player_activity WHERE report_month IN ((SELECT latest FROM lm), (SELECT prev FROM pm))),
pv AS (
  SELECT id, brand,
    CAST(SUM(CASE WHEN report_month = (SELECT prev FROM pm) THEN ngr ELSE 0 END) AS {MONEY}) AS prev_month_ngr,
    CAST(SUM(CASE WHEN report_month = (SELECT latest FROM lm) THEN ngr ELSE 0 END) AS {MONEY}) AS curr_month_ngr,
    CAST(SUM(CASE WHEN report_month = (SELECT prev FROM pm) THEN bet ELSE 0 END) AS {MONEY}) AS prev_month_turnover,
    CAST(SUM(CASE WHEN report_month = (SELECT latest FROM lm) THEN bet ELSE 0 END) AS {MONEY}) AS curr_month_turnover
  FROM x GROUP BY id, brand),
v AS (SELECT *, CAST(prev_month_ngr - curr_month_ngr AS {MONEY}) AS ngr_drop_value FROM pv
      WHERE prev_month_ngr >= 500 OR prev_month_turnover >= 5000),
v2 AS (SELECT *, CASE WHEN prev_month_ngr > 0 THEN CAST(ngr_drop_value AS DOUBLE) / CAST(prev_month_ngr AS DOUBLE) * CAST(100 AS DOUBLE)
                      ELSE CAST(0 AS DOUBLE) END AS ngr_drop_pct FROM v)
SELECT id, brand, CAST(prev_month_ngr AS DOUBLE) AS prev_month_ngr, CAST(curr_month_ngr AS DOUBLE) AS curr_month_ngr,
  CAST(prev_month_turnover AS DOUBLE) AS prev_month_turnover, CAST(curr_month_turnover AS DOUBLE) AS curr_month_turnover,
  CAST(ngr_drop_value AS DOUBLE) AS ngr_drop_value, ngr_drop_pct
FROM v2 WHERE ngr_drop_pct >= 30 AND ngr_drop_value >= 200
ORDER BY ngr_drop_value DESC, id, brand LIMIT 50""")

_LB = ("id, brand, CAST(lifetime_ggr AS DOUBLE) AS lifetime_ggr, CAST(lifetime_ngr AS DOUBLE) AS lifetime_ngr, "
       "CAST(lifetime_turnover AS DOUBLE) AS lifetime_turnover, CAST(lifetime_bonus AS DOUBLE) AS lifetime_bonus, "
       "CAST(lifetime_withdrawals AS DOUBLE) AS lifetime_withdrawals, lifetime_deposit_count, avg_deposit_value, "
       "first_month, last_month, months_active, months_inactive, smart_profile")

K15 = with_player_activity(f", {K3_CTE}\nSELECT {_LB} FROM profiles ORDER BY lifetime_ggr DESC, id LIMIT 50")
K16 = with_player_activity(
    f", {K3_CTE}\nSELECT {_LB} FROM profiles WHERE lifetime_ggr < 0 ORDER BY lifetime_turnover DESC, id LIMIT 50")
K17 = with_player_activity(
    f", {K3_CTE}\nSELECT {_LB} FROM profiles WHERE lifetime_ngr < 0 AND lifetime_bonus > 50 "
    f"AND lifetime_withdrawals > 0 ORDER BY lifetime_ngr ASC, id LIMIT 50")
K18 = with_player_activity(
    f", {K3_CTE}\nSELECT {_LB} FROM profiles WHERE lifetime_deposit_count >= 10 AND avg_deposit_value <= 25 "
    f"AND avg_deposit_value > 0 ORDER BY lifetime_deposit_count DESC, id LIMIT 50")
K19 = with_player_activity(
    f", {K3_CTE}\nSELECT id, brand, last_month, months_inactive, CAST(lifetime_ggr AS DOUBLE) AS lifetime_ggr, "
    f"CAST(lifetime_turnover AS DOUBLE) AS lifetime_turnover, smart_profile FROM profiles "
    f"WHERE months_inactive >= 3 AND lifetime_ggr >= 500")
K20 = with_player_activity(f""", {K3_CTE},
ord(position, smart_profile) AS (VALUES {values_list(list(enumerate(K.PROFILE_ORDER_B)))}),
g AS (SELECT smart_profile, COUNT(*) AS players FROM profiles GROUP BY smart_profile)
SELECT CAST(position AS BIGINT) AS position, smart_profile, CAST(COALESCE(players, 0) AS BIGINT) AS players
FROM ord LEFT JOIN g USING (smart_profile)""")
K20B = with_player_activity(
    f", {K3_CTE}\nSELECT id, brand, first_month, last_month, months_active, months_inactive, "
    f"CAST(lifetime_ggr AS DOUBLE) AS lifetime_ggr, CAST(lifetime_turnover AS DOUBLE) AS lifetime_turnover, "
    f"smart_profile FROM profiles WHERE smart_profile = '{K.COLD_CROWN}'")

ORACLES = {
    "k1_player_master_list": K1,
    "k3_rfm_summary": K3,
    "k4_smart_profiles": K4,
    "k5_vip_tier_summary": K5,
    "k5b_vip_tier_by_brand": K5B,
    "k6_cross_brand_overlap": K6,
    "k6b_multi_brand_overlap": K6B,
    "k7_ltv_curves": K7,
    "k8_cohort_retention_matrix": K8,
    "k9_retention_heatmap": K9,
    "k10_pareto_curve": K10,
    "k11_pareto_tiers": K11,
    "k12_product_affinity": K12,
    "k13_reactivation_velocity": K13,
    "k14_vip_churn_radar": K14,
    "k15_crown_jewels": K15,
    "k16_bonus_abusers": K16,
    "k17_promo_exploitation": K17,
    "k18_payment_friction": K18,
    "k19_churn_targets": K19,
    "k20_profile_counts": K20,
    "k20b_profile_extract": K20B,
}
