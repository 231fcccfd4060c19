"""DuckDB oracle SQL for the streaming (R1, R4) and journey (R5–R7) queries."""

from __future__ import annotations

from ..sources.testdata import EVENT_TO_JOURNEY
from ..streaming.journey import FUNNEL_STEPS
from .sqlkit import PLAYER_ACTIVITY, msum, with_ops

_MAP = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_TO_JOURNEY.items())
EVENTS = f"""contact_events AS (
  SELECT * FROM (
    SELECT 'box' || CAST(user_id % 5 AS VARCHAR) AS box_id, CAST(user_id AS BIGINT) AS contact_id,
      CAST(user_id AS VARCHAR) AS account_number, CAST(user_id % 7 AS INTEGER) AS campaign_id,
      CAST(user_id % 3 AS INTEGER) AS brand_id, CASE event_type {_MAP} END AS event_type, ts AS event_at,
      value, props AS extra_data, event_id
    FROM events)
  WHERE event_type IS NOT NULL
),
dedup AS (SELECT DISTINCT ON (box_id, contact_id, event_type, event_at) * FROM contact_events
  ORDER BY box_id, contact_id, event_type, event_at, event_id)"""

R1 = with_ops("""
SELECT campaign_name, ops_client, ops_brand, ops_date, records, conversions, CAST(total_cost AS DOUBLE) AS total_cost,
  extracted_lifecycle, extracted_engagement, country, CAST(campaign_data_age_days AS BIGINT) AS campaign_data_age_days
FROM ops_daily""")

R4 = """
SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type, CAST(COUNT(*) AS BIGINT) AS rows,
  ROUND(SUM(value), 6) AS total_value
FROM events GROUP BY 1, 2"""

R5 = f"""WITH {EVENTS},
feed AS (SELECT * FROM contact_events
  UNION ALL SELECT * REPLACE (event_id + 1000000000000 AS event_id) FROM contact_events WHERE event_id % 2 = 0)
SELECT box_id, contact_id, event_type, event_at, CAST(min(event_id) AS BIGINT) AS event_id, arg_min(value, event_id) AS value
FROM feed GROUP BY box_id, contact_id, event_type, event_at"""

R5B = f"""WITH {EVENTS}
SELECT box_id, contact_id, event_type, event_at, CAST(event_id AS BIGINT) AS event_id, value FROM dedup"""

_STEPS = ", ".join(f"CAST(COUNT(DISTINCT CASE WHEN event_type = '{s}' THEN contact_id END) AS BIGINT) AS {s}_contacts"
                   for s in FUNNEL_STEPS)
_RATES = ", ".join(
    f"CASE WHEN {a}_contacts > 0 THEN CAST({b}_contacts AS DOUBLE) / CAST({a}_contacts AS DOUBLE) * CAST(100 AS DOUBLE) "
    f"ELSE CAST(0 AS DOUBLE) END AS {a}_to_{b}_pct" for a, b in zip(FUNNEL_STEPS, FUNNEL_STEPS[1:]))
R6 = f"""WITH {PLAYER_ACTIVITY}, {EVENTS},
g AS (SELECT campaign_id, {_STEPS},
        CAST(SUM(CASE WHEN event_type = 'call' THEN value END) AS DECIMAL(18,2)) AS cost FROM dedup GROUP BY campaign_id),
dep AS (SELECT DISTINCT campaign_id, account_number FROM dedup WHERE event_type = 'deposit'),
ggr AS (SELECT id AS account_number, {msum('revenue')} AS ggr FROM player_activity GROUP BY id),
per AS (SELECT campaign_id, CAST(SUM(ggr) AS DECIMAL(18,2)) AS ggr FROM dep JOIN ggr USING (account_number) GROUP BY campaign_id)
SELECT CAST(g.campaign_id AS BIGINT) AS campaign_id, {", ".join(f"g.{s}_contacts" for s in FUNNEL_STEPS)}, CAST(g.cost AS DOUBLE) AS cost, {_RATES},
  CAST(COALESCE(per.ggr, 0) AS DOUBLE) AS ggr,
  CASE WHEN g.cost > 0 THEN CAST(COALESCE(per.ggr, 0) AS DOUBLE) / CAST(g.cost AS DOUBLE) END AS roi
FROM g LEFT JOIN per USING (campaign_id)"""

_FIRST = ", ".join(f"MIN(CASE WHEN event_type = '{s}' THEN event_at END) AS t_{s}" for s in FUNNEL_STEPS)


def _hours(a: str, b: str) -> str:
    return f"(CAST(epoch_us(t_{b}) - epoch_us(t_{a}) AS DOUBLE) / 1000000.0 / 3600.0)"


_TRANS = " UNION ALL ".join(
    f"SELECT '{a}_to_{b}' AS step, {_hours(a, b)} AS hours FROM ft WHERE t_{a} IS NOT NULL AND t_{b} IS NOT NULL AND t_{b} >= t_{a}"
    for a, b in zip(FUNNEL_STEPS, FUNNEL_STEPS[1:]))
R7 = f"""WITH {EVENTS},
ft AS (SELECT contact_id, {_FIRST} FROM dedup GROUP BY contact_id),
u AS ({_TRANS})
SELECT step, CAST(COUNT(*) AS BIGINT) AS contacts, ROUND(quantile_cont(hours, 0.5), 6) AS median_hours FROM u GROUP BY step"""

R7B = f"""WITH {EVENTS},
ft AS (SELECT contact_id, {_FIRST} FROM dedup GROUP BY contact_id)
SELECT CAST(floor({_hours('call', 'deposit')} / 24) AS BIGINT) AS day_bucket, CAST(COUNT(*) AS BIGINT) AS contacts
FROM ft WHERE t_call IS NOT NULL AND t_deposit IS NOT NULL AND t_deposit >= t_call GROUP BY 1"""

ORACLES = {
    "r1_stream_ops_ingest": R1,
    "r4_stream_event_pulse": R4,
    "r5_journey_dedup": R5,
    "r5b_journey_dedup_stream": R5B,
    "r6_journey_funnel": R6,
    "r7_time_to_convert": R7,
    "r7b_time_to_convert_histogram": R7B,
}

S1 = f"""WITH {PLAYER_ACTIVITY}
SELECT brand, report_month, CAST(COUNT(*) AS BIGINT) AS rows, CAST(CAST(SUM(revenue) AS DECIMAL(18,2)) AS DOUBLE) AS ggr,
  CAST(CAST(SUM(bet) AS DECIMAL(18,2)) AS DOUBLE) AS turnover, CAST(CAST(SUM(bonus_total) AS DECIMAL(18,2)) AS DOUBLE) AS bonus,
  CAST(SUM(deposit_count) AS BIGINT) AS deposit_count
FROM player_activity GROUP BY brand, report_month"""

S4 = with_ops("""
SELECT campaign_name, ops_client, ops_brand, ops_date, records, calls, conversions, CAST(total_cost AS DOUBLE) AS total_cost,
  true_cac, extracted_lifecycle, extracted_engagement, country, CAST(COALESCE(campaign_data_age_days, -1) AS BIGINT) AS campaign_data_age_days
FROM ops_daily""")

ORACLES.update({"s1_financial_files": S1, "s4_ops_files": S4})

S2 = f"""WITH {PLAYER_ACTIVITY}
SELECT brand, report_month, CAST(COUNT(*) AS BIGINT) AS rows FROM player_activity
WHERE (brand, report_month) NOT IN (SELECT DISTINCT brand, report_month FROM player_activity WHERE report_month < '2025-01')
GROUP BY brand, report_month"""
ORACLES["s2_duplicate_policy"] = S2

_ROUTED = f"""WITH {PLAYER_ACTIVITY},
reg AS (SELECT brand, i, 'Client ' || CAST(i % 3 AS VARCHAR) AS client, ['detailed', 'basic', 'sheet_cohort', 'Standard'][CAST(i % 4 AS INTEGER) + 1] AS format
  FROM (SELECT brand, row_number() OVER (ORDER BY brand) - 1 AS i FROM (SELECT DISTINCT brand FROM player_activity WHERE brand IS NOT NULL))),
x AS (SELECT p.* EXCLUDE (client), r.client, r.format FROM player_activity p JOIN reg r USING (brand))"""


def _dsum(expr: str, name: str) -> str:
    return f"CAST(CAST(SUM({expr}) AS DECIMAL(18,2)) AS DOUBLE) AS {name}"


S1B = _ROUTED + f"""
SELECT client, brand, report_month, format, CAST(COUNT(*) AS BIGINT) AS rows,
  CAST(COUNT(DISTINCT CASE format WHEN 'detailed' THEN coalesce(wb_tag, 'Unknown') WHEN 'basic' THEN wb_tag
    ELSE trim(split_part(wb_tag, '-', 1)) END) AS BIGINT) AS segments,
  CAST(COUNT(DISTINCT CASE WHEN format = 'detailed' THEN country ELSE 'Global' END) AS BIGINT) AS countries,
  {_dsum('revenue', 'ggr')}, {_dsum("CASE WHEN format = 'sheet_cohort' THEN 0 ELSE bet END", 'turnover')},
  {_dsum("CASE WHEN format = 'basic' THEN revenue ELSE ngr END", 'ngr')},
  {_dsum("CASE WHEN format = 'basic' THEN 0 ELSE deposits END", 'deposits')}
FROM x WHERE format <> 'Standard' GROUP BY client, brand, report_month, format"""

S11 = _ROUTED + """
SELECT lower(trim(brand)) AS brand_key, report_month, CASE WHEN format = 'Standard' THEN 'unknown format'
    WHEN CAST(id AS BIGINT) % 11 = 0 THEN 'no player id' WHEN CAST(id AS BIGINT) % 7 = 0 THEN 'malformed line' ELSE 'good' END AS reason,
  CAST(COUNT(*) AS BIGINT) AS rows
FROM x GROUP BY 1, 2, 3"""
ORACLES.update({"s1b_routed_formats": S1B, "s11_quarantine": S11})

W4B = _ROUTED + f"""
SELECT client, brand, CAST(COUNT(*) AS BIGINT) AS rows, {_dsum('revenue', 'ggr')}, {_dsum('bet', 'turnover')} FROM x GROUP BY client, brand"""
ORACLES["w4b_replace_client"] = W4B

F13B = f"""WITH {PLAYER_ACTIVITY}
SELECT brand, substr(report_month, 1, 4) || '-Q' || CAST(CAST(ceil(CAST(substr(report_month, 6, 2) AS INTEGER) / 3) AS INTEGER) AS VARCHAR) AS quarter,
  CAST(COUNT(DISTINCT id) AS BIGINT) AS players FROM player_activity GROUP BY 1, 2"""
ORACLES["f13b_sketch_players"] = F13B

TOTALS = f"""WITH {PLAYER_ACTIVITY}
SELECT client, brand, report_month, CAST(COUNT(*) AS BIGINT) AS rows, {_dsum('revenue', 'ggr')}, {_dsum('bet', 'turnover')}
FROM player_activity GROUP BY client, brand, report_month"""
W8 = f"""WITH {PLAYER_ACTIVITY},
s AS (SELECT brand, report_month AS month, wb_tag, CAST(COUNT(id) AS BIGINT) AS total_players, {_dsum('revenue', 'ggr')}
  FROM player_activity WHERE brand IS NOT NULL AND report_month IS NOT NULL AND wb_tag IS NOT NULL GROUP BY brand, report_month, wb_tag)
SELECT brand, month, strftime(CAST(month || '-01' AS DATE), '%B %Y') AS month_label, wb_tag, total_players, round(ggr, 2) AS ggr FROM s"""
P1B = f"""WITH {PLAYER_ACTIVITY}
SELECT id, client, brand, report_month, CAST(revenue AS DOUBLE) AS revenue, CAST(bet AS DOUBLE) AS bet FROM player_activity
WHERE client = 'ASIA' AND brand = 'PROMO' AND report_month BETWEEN '2024-05' AND '2025-02'"""
ORACLES.update({"w1_append_replace_fact": TOTALS, "w7_csv_extract": TOTALS, "w8_multitab_report": W8, "p1b_financial_filter": P1B})

ORACLES["s7_range_scan"] = f"""WITH {PLAYER_ACTIVITY}
SELECT brand, report_month, CAST(COUNT(*) AS BIGINT) AS rows, {_dsum('revenue', 'ggr')} FROM player_activity
WHERE report_month BETWEEN '2024-07' AND '2025-06' GROUP BY brand, report_month"""
