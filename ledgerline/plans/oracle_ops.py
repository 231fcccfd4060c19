"""DuckDB oracle SQL for the operations block (C/O), quality (Q) and periods (P)."""

from __future__ import annotations

from ..functions import campaign as C
from ..operators import ops as O
from .sqlkit import PLAYER_ACTIVITY, SLA_TABLE, month_index, with_ops, with_player_activity

MONEY = "DECIMAL(18,2)"
REF = "(SELECT MAX(ops_date) FROM ops_daily)"


def _wd(d: str) -> str:
    return f"(isodow({d}) - 1)"


def _pmod7(x: str) -> str:
    return f"((({x}) % 7 + 7) % 7)"


def last_thu(d: str) -> str:
    return f"CAST({d} - CAST({_pmod7(_wd(d) + ' - 3')} AS INTEGER) AS DATE)"


def week_start(d: str) -> str:
    return f"CAST({d} - CAST({_pmod7(_wd(d) + ' - 4')} AS INTEGER) AS DATE)"


def half(d: str) -> str:
    return f"('H' || CASE WHEN month({d}) <= 6 THEN '1' ELSE '2' END || ' ' || CAST(year({d}) AS VARCHAR))"


def capped(num: str, den: str) -> str:
    return (f"CASE WHEN CAST({den} AS DOUBLE) <> 0 THEN LEAST(CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) "
            f"* CAST(100 AS DOUBLE), CAST(100 AS DOUBLE)) ELSE CAST(0 AS DOUBLE) END")


def nz_pct(num: str, den: str) -> str:
    return (f"CASE WHEN ({den}) <> 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) * CAST(100 AS DOUBLE) "
            f"ELSE CAST(0 AS DOUBLE) END")


_CORE = ("regexp_replace(regexp_replace(regexp_replace(campaign_name, '[_-]\\d{4}[_-]\\d{2}[_-]\\d{2}$', ''), "
         "'[_-]\\d{2}[A-Z]{3}\\d{4}$', ''), '[_-]\\d{4}[_-]\\d{2}$', '')")

OPS_BASE = f""",
ops_base AS (
  SELECT *,
    CASE WHEN regexp_matches(replace(campaign_name, '-', '_'), '_\\d+_\\d+$') AND contains(campaign_name, '_')
         THEN regexp_replace(campaign_name, '_[^_]*$', '') ELSE campaign_name END AS campaign_signature,
    concat_ws('-', COALESCE(ops_brand, 'UNKNOWN'), COALESCE(country, 'UNKNOWN'), COALESCE(extracted_lifecycle, 'UNKNOWN'),
              COALESCE(extracted_engagement, 'UNKNOWN')) AS strategy_signature,
    CASE WHEN regexp_matches(upper(core_signature), '[-_ ]RND') THEN 'RND'
         WHEN regexp_matches(upper(core_signature), '[-_ ]WB') THEN 'WB' ELSE 'UNKNOWN' END AS ops_lifecycle
  FROM (SELECT *, {_CORE} AS core_signature FROM ops_daily)
)"""

_BK = ["brand", "country", "extracted_lifecycle", "extracted_segment", "extracted_engagement"]
BENCH = f""",
bx AS (
  SELECT {half('ops_date')} AS benchmark_period, ops_date,
    COALESCE(ops_brand, 'UNKNOWN') AS brand, COALESCE(country, 'UNKNOWN') AS country,
    COALESCE(extracted_lifecycle, 'UNKNOWN') AS extracted_lifecycle, COALESCE(extracted_segment, 'UNKNOWN') AS extracted_segment,
    COALESCE(extracted_engagement, 'UNKNOWN') AS extracted_engagement,
    records, calls, kpi2_logins, conversions, d_plus + d_neutral + d_minus AS deliveries,
    CAST(cost_sip + cost_sms + cost_email AS {MONEY}) AS telecom_cost
  FROM ops_daily WHERE ops_date IS NOT NULL
),
bd AS (
  SELECT benchmark_period, ops_date, {", ".join(_BK)}, SUM(records) AS records, SUM(calls) AS calls,
    SUM(kpi2_logins) AS kpi2_logins, SUM(conversions) AS conversions, SUM(deliveries) AS deliveries,
    CAST(SUM(telecom_cost) AS {MONEY}) AS telecom_cost
  FROM bx GROUP BY benchmark_period, ops_date, {", ".join(_BK)}
),
bench0 AS (
  SELECT benchmark_period, {", ".join(_BK)},
    CAST(SUM(records) AS DOUBLE) / COUNT(*) AS avg_daily_records,
    CAST(SUM(calls) AS DOUBLE) / COUNT(*) AS avg_daily_calls,
    CAST(SUM(kpi2_logins) AS DOUBLE) / COUNT(*) AS avg_daily_logins,
    CAST(SUM(conversions) AS DOUBLE) / COUNT(*) AS avg_daily_conversions,
    CAST(SUM(deliveries) AS DOUBLE) / COUNT(*) AS avg_daily_deliveries,
    CAST(SUM(telecom_cost) AS DOUBLE) / COUNT(*) AS avg_daily_telecom_cost
  FROM bd GROUP BY benchmark_period, {", ".join(_BK)}
),
bench AS (
  SELECT *, CASE WHEN avg_daily_conversions > 0 THEN avg_daily_telecom_cost / avg_daily_conversions
                 ELSE CAST(0 AS DOUBLE) END AS avg_daily_true_cac FROM bench0
)"""

SNAPS = f""",
snaps0 AS (SELECT *, unnest(generate_series(0, records % 3)) AS _v FROM ops_daily),
snaps AS (
  SELECT * EXCLUDE (_v) REPLACE (CAST(records - (records % 3 - _v) AS BIGINT) AS records),
    CAST(ops_date + 1 AS TIMESTAMP) + to_hours(CAST(_v * 6 AS BIGINT)) AS snapshot_timestamp
  FROM snaps0
)"""

RAW = "regexp_replace(campaign_name, '_\\d{4}-\\d{2}-\\d{2}$', '')"
_L = lambda vals: "[" + ", ".join("'" + v + "'" for v in vals) + "]"


def _tokens(name: str) -> str:
    return (f"list_transform(string_split(replace(upper({name}), '_', '-'), '-'), "
            f"lambda t: CASE WHEN t = 'WBD' THEN 'WB' ELSE t END)")


C1 = with_ops(f"""
SELECT campaign_name, ops_date,
  CASE WHEN COALESCE({_tokens(RAW)}[1], '') = '' THEN 'UNKNOWN' ELSE {_tokens(RAW)}[1] END AS tag,
  extracted_lifecycle, extracted_segment, extracted_engagement, extracted_product, extracted_sublifecycle, country,
  extracted_language, CAST(campaign_data_age_days AS BIGINT) AS campaign_data_age_days,
  CAST(COALESCE(campaign_data_age_days, -1) AS BIGINT) AS data_age_sink,
  CASE WHEN regexp_matches(campaign_name, '(\\d{{4}}-\\d{{2}}-\\d{{2}})_\\d{{4}}-\\d{{2}}-\\d{{2}}$')
       THEN CAST(date_diff('day', CAST(strptime(regexp_extract(campaign_name, '(\\d{{4}}-\\d{{2}}-\\d{{2}})_\\d{{4}}-\\d{{2}}-\\d{{2}}$', 1), '%Y-%m-%d') AS DATE), ops_date) AS BIGINT)
  END AS data_age_range_suffix,
  COALESCE(CASE extracted_engagement {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.ENGAGEMENT_LABELS.items())} END,
           extracted_engagement) AS engagement_label,
  COALESCE(CASE extracted_product {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.PRODUCT_LABELS.items())} END,
           extracted_product) AS product_label
FROM ops_daily""")

C8 = with_ops("SELECT campaign_name, core_signature, campaign_signature, strategy_signature, ops_lifecycle FROM ops_base",
              OPS_BASE)

_NUM = r"^\s*([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|0[xX][0-9a-fA-F]+|0[bB][01]+|0[oO][0-7]+)?\s*$"
C12 = with_ops(f""",
s0 AS (
  SELECT {RAW} AS _name,
    list_transform(string_split({RAW}, '-'), lambda p: CASE WHEN upper(p) = 'WBD' THEN 'WB' ELSE p END) AS _parts,
    records
  FROM ops_daily
),
s1 AS (
  SELECT *, upper(list_filter(_parts, lambda p: list_contains({_L(C.LIFECYCLES)}, upper(p)))[1]) AS _lc FROM s0
  WHERE (contains(_name, 'NLI') OR contains(upper(_name), '{O.SHORT_EXCEPTION}')) AND len(_parts) >= 2
),
s2 AS (
  SELECT *, list_transform(list_filter(_parts, lambda p, i: i >= 2 AND upper(p) <> _lc
              AND NOT list_contains({_L(C.PRODUCTS + C.SEGMENTS + O.SHORT_BASE_BLACKLIST)}, upper(p))
              AND NOT regexp_matches(upper(p), '{_NUM}')
              AND NOT regexp_matches(upper(p), '{O.SHORT_MONTHS_PATTERN}')), lambda p: upper(p)) AS _rest
  FROM s1 WHERE _lc IS NOT NULL
)
SELECT CASE WHEN len(_rest) > 0 THEN concat_ws('-', _parts[1], array_to_string(_rest, '-'), _lc)
            ELSE concat_ws('-', _parts[1], _lc) END AS short_name,
  CAST(SUM(records) AS BIGINT) AS total
FROM s2 GROUP BY short_name""")

O3 = with_ops("""
SELECT ops_date, extracted_engagement, CAST(SUM(records) AS BIGINT) AS total_records,
  CAST(SUM(conversions) AS BIGINT) AS total_conversions, CAST(SUM(kpi2_logins) AS BIGINT) AS total_logins
FROM ops_daily WHERE ops_date IS NOT NULL AND extracted_engagement IS NOT NULL
GROUP BY ops_date, extracted_engagement""")


def _mean_if(cond: str, c: str) -> str:
    return f"ROUND(COALESCE(AVG(CASE WHEN {cond} THEN {c} END), CAST(0 AS DOUBLE)), 6)"


_CUR = "age >= 0 AND age < window_days"
_PRI = "age >= window_days AND age < 2 * window_days"
O4 = with_ops(f""",
pulse AS (
  SELECT ops_date, extracted_engagement, CAST(SUM(records) AS BIGINT) AS total_records,
    CAST(SUM(conversions) AS BIGINT) AS total_conversions, CAST(SUM(kpi2_logins) AS BIGINT) AS total_logins
  FROM ops_daily WHERE ops_date IS NOT NULL AND extracted_engagement IS NOT NULL
  GROUP BY ops_date, extracted_engagement
),
p AS (
  SELECT *, upper(extracted_engagement) AS engagement,
    {capped('total_conversions', 'total_records')} AS conv_pct, {capped('total_logins', 'total_records')} AS login_pct
  FROM pulse WHERE upper(extracted_engagement) IN ('LI', 'NLI')
),
mx AS (SELECT engagement, MAX(ops_date) AS _max FROM p GROUP BY engagement),
pw AS (SELECT p.*, date_diff('day', p.ops_date, mx._max) AS age, unnest({list(O.PULSE_WINDOWS)}) AS window_days
       FROM p JOIN mx USING (engagement)),
g AS (
  SELECT engagement, window_days,
    CAST(COALESCE(SUM(CASE WHEN {_CUR} THEN total_records END), 0) AS BIGINT) AS volume_current,
    CAST(COALESCE(SUM(CASE WHEN {_PRI} THEN total_records END), 0) AS BIGINT) AS volume_prior,
    {_mean_if(_CUR, 'login_pct')} AS login_pct_current, {_mean_if(_PRI, 'login_pct')} AS login_pct_prior,
    {_mean_if(_CUR, 'conv_pct')} AS conv_pct_current, {_mean_if(_PRI, 'conv_pct')} AS conv_pct_prior
  FROM pw GROUP BY engagement, window_days
)
SELECT engagement, CAST(window_days AS BIGINT) AS window_days, volume_current, volume_prior, login_pct_current,
  login_pct_prior, conv_pct_current, conv_pct_prior, volume_current - volume_prior AS volume_delta,
  ROUND(login_pct_current - login_pct_prior, 6) AS login_pct_delta, ROUND(conv_pct_current - conv_pct_prior, 6) AS conv_pct_delta
FROM g""")

O5 = with_ops("SELECT * FROM bench", BENCH)


def _o6() -> str:
    sums = []
    for c in O.HOH_SUMS:
        sums.append(f"COALESCE(SUM(CASE WHEN is_cur THEN {c} END), 0) AS c_{c}")
        sums.append(f"COALESCE(SUM(CASE WHEN NOT is_cur THEN {c} END), 0) AS r_{c}")
    scale = ("CASE WHEN pri_days > 0 THEN CAST(cur_days AS DOUBLE) / CAST(pri_days AS DOUBLE) "
             "ELSE CAST(1 AS DOUBLE) END")
    scaled = ", ".join(f"CAST(trunc(CAST(r_{c} AS DOUBLE) * {scale}) AS BIGINT) AS p_{c}" for c in O.HOH_SUMS)

    def rate(side, nums, den):
        num = " + ".join(f"{side}_{n}" for n in nums)
        return (f"CASE WHEN {side}_{den} > 0 THEN CAST({num} AS DOUBLE) / CAST({side}_{den} AS DOUBLE) "
                f"* CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END")

    vol = [("Records", "records"), ("Logins", "kpi2_logins"), ("Conversions", "conversions")]
    rates = [("Calls Delivered %", ["d_plus", "d_minus", "d_neutral"], "records"), ("No Answer %", ["na"], "records"),
             ("Invalid %", ["t", "dnc", "dx", "wn", "am"], "records"), ("Email Delivered %", ["ed"], "es"),
             ("Email Opened %", ["eo"], "es"), ("Email Clicked %", ["ec"], "es"), ("Email Failed %", ["ef"], "es"),
             ("SMS Delivered %", ["sd"], "ss"), ("SMS Failed %", ["sf"], "ss"), ("SMS Pending %", ["sp"], "ss")]
    sel = []
    head = "current_half, prior_half, cur_days, pri_days"
    for i, (label, c) in enumerate(vol):
        p, cu = f"CAST(p_{c} AS DOUBLE)", f"CAST(c_{c} AS DOUBLE)"
        sel.append(f"SELECT {head}, CAST({i} AS BIGINT) AS position, '{label}' AS metric, {p} AS prior, {cu} AS current, "
                   f"CASE WHEN {p} <> 0 THEN ({cu} - {p}) / {p} * CAST(100 AS DOUBLE) END AS change, 'pct' AS change_unit FROM h3")
    for j, (label, nums, den) in enumerate(rates):
        p, cu = rate("p", nums, den), rate("c", nums, den)
        sel.append(f"SELECT {head}, CAST({len(vol) + j} AS BIGINT), '{label}', {p}, {cu}, ({cu}) - ({p}), 'pp' FROM h3")
    return with_ops(f""",
labs AS (SELECT arg_max({half('ops_date')}, ops_date) AS cur FROM ops_daily),
labs2 AS (SELECT cur, CASE WHEN substr(cur, 1, 2) = 'H2' THEN 'H1 ' || substr(cur, 4, 4)
                      ELSE 'H2 ' || CAST(CAST(substr(cur, 4, 4) AS INTEGER) - 1 AS VARCHAR) END AS pri FROM labs),
hx AS (SELECT o.*, {half('o.ops_date')} = l.cur AS is_cur, l.cur AS current_half, l.pri AS prior_half
       FROM ops_daily o, labs2 l WHERE {half('o.ops_date')} IN (l.cur, l.pri)),
h1 AS (SELECT ANY_VALUE(current_half) AS current_half, ANY_VALUE(prior_half) AS prior_half,
         COUNT(DISTINCT CASE WHEN is_cur THEN ops_date END) AS cur_days,
         COUNT(DISTINCT CASE WHEN NOT is_cur THEN ops_date END) AS pri_days, {", ".join(sums)} FROM hx),
h2 AS (SELECT *, {scaled} FROM h1),
h3 AS (SELECT *, c_sd + c_sf + c_sp AS c_ss, p_sd + p_sf + p_sp AS p_ss FROM h2)
{" UNION ALL ".join(sel)}""")


O6 = _o6()

_SLA_SUMS = ", ".join(f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in O.SLA_SUMS)
_BH = f"(CASE WHEN month({REF}) <= 6 THEN 'H1 ' ELSE 'H2 ' END || CAST(year({REF}) - 1 AS VARCHAR))"


def _bench_col(c):
    return (f"CASE WHEN bench_days > 0 THEN CAST(trunc(CAST(COALESCE(_b_{c}, 0) AS DOUBLE) * (CAST(num_days AS DOUBLE) "
            f"/ CAST(bench_days AS DOUBLE))) AS BIGINT) ELSE CAST(0 AS BIGINT) END")


_SLA_BENCH = ["records", "kpi2_logins", "conversions", "calls", "sa", "ev", "sd", "sf", "sp", "ed", "ef", "eo"]

O7 = with_ops(f""",
known AS (SELECT * FROM ops_daily WHERE extracted_lifecycle <> 'UNKNOWN' AND ops_client <> 'UNKNOWN'),
cur AS (SELECT ops_client, {_SLA_SUMS}, list_sort(list_distinct(array_agg(extracted_lifecycle))) AS active_lifecycles
        FROM known GROUP BY ops_client),
prev AS (SELECT * FROM snaps WHERE {half('ops_date')} = {_BH}),
bench AS (SELECT ops_client, {", ".join(f"SUM({c}) AS _b_{c}" for c in _SLA_BENCH)} FROM prev GROUP BY ops_client),
j AS (SELECT cur.*, {", ".join(f"bench._b_{c}" for c in _SLA_BENCH)},
        (SELECT CAST(COUNT(DISTINCT ops_date) AS BIGINT) FROM ops_daily) AS num_days,
        (SELECT CAST(COUNT(DISTINCT ops_date) AS BIGINT) FROM prev) AS bench_days
      FROM cur LEFT JOIN bench USING (ops_client)),
k AS (SELECT * EXCLUDE ({", ".join(f"_b_{c}" for c in _SLA_BENCH)}), {", ".join(f"{_bench_col(c)} AS bench_{c}" for c in _SLA_BENCH)} FROM j)
SELECT *,
  CASE WHEN bench_records <> 0 THEN (CAST(records AS DOUBLE) - CAST(bench_records AS DOUBLE)) / CAST(bench_records AS DOUBLE) * CAST(100 AS DOUBLE) END AS records_delta_pct,
  CASE WHEN bench_kpi2_logins <> 0 THEN (CAST(kpi2_logins AS DOUBLE) - CAST(bench_kpi2_logins AS DOUBLE)) / CAST(bench_kpi2_logins AS DOUBLE) * CAST(100 AS DOUBLE) END AS kpi2_logins_delta_pct,
  CASE WHEN bench_conversions <> 0 THEN (CAST(conversions AS DOUBLE) - CAST(bench_conversions AS DOUBLE)) / CAST(bench_conversions AS DOUBLE) * CAST(100 AS DOUBLE) END AS conversions_delta_pct
FROM k""", SNAPS)

O8 = with_ops(f""", {SLA_TABLE},
mins AS (SELECT client_name, lifecycle, CAST(SUM(monthly_minimum_records) AS BIGINT) AS monthly_minimum_records
         FROM contractual_volumes WHERE monthly_minimum_records > 0 GROUP BY client_name, lifecycle),
vol AS (SELECT ops_client AS client_name, extracted_lifecycle AS lifecycle, CAST(SUM(records) AS BIGINT) AS actual_records
        FROM ops_daily GROUP BY ops_client, extracted_lifecycle),
x AS (SELECT m.client_name, m.lifecycle, m.monthly_minimum_records, CAST(COALESCE(v.actual_records, 0) AS BIGINT) AS actual_records,
        (SELECT CAST(date_diff('day', MIN(ops_date), MAX(ops_date)) + 1 AS BIGINT) FROM ops_daily) AS timeframe_days
      FROM mins m LEFT JOIN vol v ON m.client_name = v.client_name AND m.lifecycle = v.lifecycle
      WHERE m.client_name IN (SELECT ops_client FROM ops_daily))
SELECT *, CAST(monthly_minimum_records AS DOUBLE) / CAST(30 AS DOUBLE) * timeframe_days AS pro_rated_target,
  CAST(actual_records AS DOUBLE) < CAST(monthly_minimum_records AS DOUBLE) / CAST(30 AS DOUBLE) * timeframe_days AS breach
FROM x""")


def _o9_finish(src: str) -> str:
    avg = "(CAST(_s90 AS DOUBLE) / CAST(90 AS DOUBLE))"
    return (f"SELECT client, {avg} AS avg_90d, CAST(_s0 AS DOUBLE) AS latest_day, "
            f"CASE WHEN {avg} > 0 THEN (CAST(_s0 AS DOUBLE) - {avg}) / {avg} ELSE CAST(0 AS DOUBLE) END AS difference FROM {src}")


O9 = with_ops(f""",
x AS (SELECT *, date_diff('day', ops_date, {REF}) AS age FROM ops_daily
      WHERE ops_client NOT IN ('UNKNOWN', 'N/A', '')),
g AS (SELECT ops_client AS client, CAST(SUM(records) AS BIGINT) AS _s90,
        CAST(COALESCE(SUM(CASE WHEN age = 0 THEN records END), 0) AS BIGINT) AS _s0
      FROM x WHERE age >= 0 AND age <= 90 GROUP BY ops_client),
r AS ({_o9_finish('g')}),
t AS ({_o9_finish("(SELECT 'Total' AS client, SUM(_s90) AS _s90, SUM(_s0) AS _s0 FROM g)")})
SELECT *, CASE WHEN difference <= -0.5 THEN 'Bulk campaigns' ELSE '' END AS note FROM r
UNION ALL SELECT *, '' FROM t""")

_PERIOD_KEY = "substr(benchmark_period, 4, 4) || substr(benchmark_period, 1, 2)"
O10 = with_ops(f""",
g AS (SELECT CAST(SUM(total_cost) AS {MONEY}) AS total_spend, CAST(SUM(calls) AS BIGINT) AS total_calls,
        CAST(SUM(conversions) AS BIGINT) AS total_conversions, CAST(SUM(d_total) AS BIGINT) AS total_d,
        CAST(SUM(records) AS BIGINT) AS total_records, COUNT(DISTINCT ops_date) AS num_days FROM ops_daily),
lp AS (SELECT arg_max(benchmark_period, {_PERIOD_KEY}) AS p FROM bench),
b AS (SELECT ROUND(SUM(avg_daily_calls), 6) AS exp_daily_calls, ROUND(SUM(avg_daily_conversions), 6) AS exp_daily_convs,
        ROUND(SUM(avg_daily_deliveries), 6) AS exp_daily_delivs FROM bench WHERE benchmark_period = (SELECT p FROM lp)),
x AS (SELECT * FROM g, b),
y AS (SELECT *, CASE WHEN total_calls > 0 THEN CAST(total_d AS DOUBLE) / CAST(total_calls AS DOUBLE) * CAST(100 AS DOUBLE)
                     ELSE CAST(0 AS DOUBLE) END AS contact_rate FROM x)
SELECT total_records, CAST(total_spend AS DOUBLE) AS total_spend, total_calls, total_conversions, contact_rate,
  CASE WHEN total_conversions > 0 THEN CAST(total_spend AS DOUBLE) / CAST(total_conversions AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS true_cac,
  CAST(trunc(CAST(total_calls AS DOUBLE) - exp_daily_calls * num_days) AS BIGINT) AS calls_vs_benchmark,
  CAST(trunc(CAST(total_conversions AS DOUBLE) - exp_daily_convs * num_days) AS BIGINT) AS conversions_vs_benchmark,
  contact_rate - CASE WHEN exp_daily_calls > 0 THEN exp_daily_delivs / exp_daily_calls * CAST(100 AS DOUBLE)
                      ELSE CAST(0 AS DOUBLE) END AS contact_rate_vs_benchmark
FROM y""", BENCH)

_WEEKS = f""",
wk AS (SELECT *, {week_start('ops_date')} AS week_start FROM ops_daily WHERE ops_date <= {last_thu(REF)}),
wk52 AS (SELECT * FROM wk WHERE week_start > CAST({last_thu(REF)} - 7 * 52 AS DATE))"""

O11 = with_ops(f"""{_WEEKS}
SELECT week_start, extracted_lifecycle, CAST(SUM(conversions) AS BIGINT) AS conversions FROM wk52
WHERE extracted_lifecycle <> 'UNKNOWN' GROUP BY week_start, extracted_lifecycle
UNION ALL
SELECT week_start, 'TOTAL', CAST(SUM(conversions) AS BIGINT) FROM wk52 GROUP BY week_start""")

O12 = with_ops(f"""{_WEEKS},
g AS (SELECT week_start, CAST(SUM(conversions) AS BIGINT) AS conversions, CAST(SUM(kpi2_logins) AS BIGINT) AS logins,
        CAST(SUM(total_cost) AS {MONEY}) AS total_cost,
        SUM(CASE WHEN campaign_data_age_days >= 0 THEN campaign_data_age_days END) AS _age_sum,
        COUNT(CASE WHEN campaign_data_age_days >= 0 THEN 1 END) AS _age_n FROM wk52 GROUP BY week_start)
SELECT week_start, conversions, logins, CAST(total_cost AS DOUBLE) AS total_cost,
  CAST(total_cost AS DOUBLE) / CAST(CASE WHEN conversions = 0 THEN 1 ELSE conversions END AS DOUBLE) AS cpc,
  CASE WHEN _age_n > 0 THEN CAST(_age_sum AS DOUBLE) / CAST(_age_n AS DOUBLE) END AS avg_data_age
FROM g""")

LATEST_SNAPS = """,
latest_snaps AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY campaign_name, ops_date ORDER BY snapshot_timestamp DESC) AS _rn FROM snaps)
  WHERE _rn = 1
)"""

O13 = with_ops("""
SELECT campaign_name, ops_client, ops_date, records, calls, conversions,
  strftime(snapshot_timestamp, '%Y-%m-%d %H:%M:%S') AS snapshot_at FROM latest_snaps""", SNAPS + LATEST_SNAPS)

_SNAP_SIG = """CASE WHEN regexp_matches(replace(campaign_name, '-', '_'), '_\\d+_\\d+$') AND contains(campaign_name, '_')
    THEN regexp_replace(campaign_name, '_[^_]*$', '') ELSE campaign_name END"""


def _trend(period: str, source: str, days: str, li: str) -> str:
    return with_ops(f""", {SLA_TABLE},
r AS (SELECT *, {_SNAP_SIG} AS sig FROM {source}),
v AS (SELECT ops_client AS client, * FROM r UNION ALL SELECT 'All' AS client, * FROM r),
one AS (SELECT client, CASE WHEN COUNT(DISTINCT sig) = 1 THEN MIN(sig) END AS sig FROM v GROUP BY client),
g AS (SELECT client, {period}, CAST(SUM(records) AS BIGINT) AS records, CAST(SUM(calls) AS BIGINT) AS calls,
        CAST(SUM(conversions) AS BIGINT) AS conversions, CAST(SUM(kpi2_logins) AS BIGINT) AS logins{li}
      FROM v GROUP BY client, {period}),
m AS (SELECT client, CAST(SUM(records) AS DOUBLE) / COUNT(*) AS mean_volume FROM g GROUP BY client),
sla AS (SELECT client_name AS client, CAST(SUM(monthly_minimum_records) AS DOUBLE) / CAST(30 AS DOUBLE) * CAST({days} AS DOUBLE) AS sla_minimum
        FROM contractual_volumes WHERE brand_code = 'ALL' GROUP BY client_name HAVING SUM(monthly_minimum_records) > 0)
SELECT g.*, {capped('conversions', 'records')} AS conv_pct, {capped('logins', 'records')} AS login_pct, mean_volume, sla_minimum,
  (CAST(0.02 AS DOUBLE) + (length(one.sig) % 5) * CAST(0.01 AS DOUBLE)) * CAST(100 AS DOUBLE) AS target_conv_pct,
  (CAST(0.10 AS DOUBLE) + (length(one.sig) % 7) * CAST(0.01 AS DOUBLE)) * CAST(100 AS DOUBLE) AS target_li_pct
FROM g JOIN m USING (client) JOIN one USING (client) LEFT JOIN sla USING (client)""", SNAPS + LATEST_SNAPS)


O14 = _trend("ops_date", "latest_snaps", "1", ", ROUND(AVG(li_pct * CAST(100 AS DOUBLE)), 6) AS li_pct_mean")
O15 = _trend("week_start", f"(SELECT *, {week_start('ops_date')} AS week_start FROM latest_snaps WHERE ops_date <= {last_thu(REF)})", "7", "")


def _score(src: str, keys: str) -> str:
    rec1 = "CASE WHEN records = 0 THEN 1 ELSE records END"
    calls1 = "CASE WHEN calls = 0 THEN 1 ELSE calls END"
    net = "GREATEST(records - hlrv - twoxrv, 1)"

    def clip(e):
        return f"LEAST(GREATEST({e}, CAST(0 AS DOUBLE)), CAST(1 AS DOUBLE))"
    return f"""SELECT {keys}, {", ".join(O.SCORE_SUMS)}, {net} AS net_records,
  {clip(f'CAST(calls AS DOUBLE) / CAST({rec1} AS DOUBLE)')} * CAST(100 AS DOUBLE) AS gross_completion_pct,
  {clip(f'CAST(calls AS DOUBLE) / CAST({net} AS DOUBLE)')} * CAST(100 AS DOUBLE) AS net_completion_pct,
  d_plus + d_neutral + d_minus AS deliveries, am + dnc + dx + wn + t AS issues,
  CAST(d_plus + d_neutral + d_minus AS DOUBLE) / CAST({calls1} AS DOUBLE) * CAST(100 AS DOUBLE) AS deliveries_pct,
  CAST(kpi2_logins AS DOUBLE) / CAST({rec1} AS DOUBLE) * CAST(100 AS DOUBLE) AS logins_per_record_pct,
  {nz_pct('conversions', 'kpi2_logins')} AS conversions_per_login_pct,
  {nz_pct('ed', 'ed + ef')} AS email_delivered_pct,
  {nz_pct('eo', 'ed')} AS email_open_pct,
  {nz_pct('sd', 'sd + sp + sf')} AS sms_delivered_pct
FROM {src}"""


_BANDS = """CASE WHEN deliveries_pct >= 20 THEN 'green' WHEN deliveries_pct >= 15 THEN 'yellow'
       WHEN deliveries_pct >= 10 THEN 'orange' ELSE 'red' END AS deliveries_band,
  CASE WHEN email_delivered_pct >= 90 THEN 'green' WHEN email_delivered_pct >= 85 THEN 'yellow' ELSE 'red' END AS delivery_rate_band,
  CASE WHEN logins_per_record_pct >= 10 THEN 'green' WHEN logins_per_record_pct >= 5 THEN 'yellow' ELSE 'red' END AS engagement_band"""

O16 = with_ops(f""",
g AS (SELECT core_signature, {", ".join(f"CAST(SUM({s}) AS BIGINT) AS {s}" for s in O.SCORE_SUMS)}
      FROM ops_base GROUP BY core_signature),
s AS ({_score('g', 'core_signature')})
SELECT *, {_BANDS} FROM s""", OPS_BASE)

O18 = with_ops(f""",
s AS ({_score('ops_base', 'campaign_name, ops_date, core_signature')})
SELECT *, CAST(na AS DOUBLE) / CAST(CASE WHEN records = 0 THEN 1 ELSE records END AS DOUBLE) * CAST(100 AS DOUBLE) AS na_pct,
  CAST(issues AS DOUBLE) / CAST(CASE WHEN records = 0 THEN 1 ELSE records END AS DOUBLE) * CAST(100 AS DOUBLE) AS issues_pct,
  CASE WHEN eo <> 0 THEN CAST(ec AS DOUBLE) / CAST(eo AS DOUBLE) * CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS email_clicked_pct
FROM s""", OPS_BASE)

_LK = ["campaign_name", "ops_client", "ops_brand", "ops_date", "country", "extracted_lifecycle", "extracted_segment",
       "extracted_engagement"]
O19 = with_ops(f""",
g AS (SELECT {", ".join(_LK)}, CAST(SUM(records) AS BIGINT) AS records, CAST(SUM(calls) AS BIGINT) AS calls,
        CAST(SUM(total_cost) AS {MONEY}) AS total_cost, CAST(SUM(conversions) AS BIGINT) AS conversions,
        {", ".join(f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in ("d_total", "na", "am", "dnc", "dx", "wn", "t"))}
      FROM ops_daily GROUP BY {", ".join(_LK)}),
g2 AS (SELECT *,
  CASE WHEN conversions <> 0 THEN CAST(total_cost AS DOUBLE) / CAST(conversions AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS true_cac,
  {nz_pct('conversions', 'records')} AS conv_pct,
  {nz_pct('d_total', 'd_total + na + am + dnc + dx + wn + t')} AS contact_rate,
  (CASE WHEN month(ops_date) <= 6 THEN 'H1 ' ELSE 'H2 ' END || CAST(year(ops_date) - 1 AS VARCHAR)) AS tbh FROM g)
SELECT g2.* EXCLUDE (tbh, total_cost), CAST(g2.total_cost AS DOUBLE) AS total_cost,
  COALESCE(b.avg_daily_true_cac, CAST(0 AS DOUBLE)) AS benchmark_cac,
  g2.true_cac - COALESCE(b.avg_daily_true_cac, CAST(0 AS DOUBLE)) AS cac_delta
FROM g2 LEFT JOIN bench b ON b.brand = g2.ops_brand AND b.country = g2.country
  AND b.extracted_lifecycle = g2.extracted_lifecycle AND b.extracted_segment = g2.extracted_segment
  AND b.extracted_engagement = g2.extracted_engagement AND b.benchmark_period = g2.tbh""", BENCH)


def _o20() -> str:
    aggs = []
    for m, _, _ in O.VARIANCE_METRICS:
        aggs += [f"SUM(CASE WHEN _age = 0 THEN {m} END) AS {m}__y",
                 f"SUM(CASE WHEN _age IN (7, 14, 21, 28) THEN {m} END) AS {m}__dow",
                 f"SUM(CASE WHEN _age < 7 THEN {m} END) AS {m}__l7", f"SUM({m}) AS {m}__all"]
    activity = " + ".join(f"ABS(CAST(COALESCE({m}__all, 0) AS DOUBLE))" for m, _, _ in O.VARIANCE_METRICS)

    def var(v, b):
        return (f"CASE WHEN {b} = 0 THEN CASE WHEN {v} = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END "
                f"WHEN ABS(({v} - {b}) / {b}) < 0.01 THEN CAST(0 AS DOUBLE) ELSE ({v} - {b}) / {b} END")
    sels = []
    for m, label, is_cost in O.VARIANCE_METRICS:
        y = f"CAST(COALESCE({m}__y, 0) AS DOUBLE)"
        dow = f"(CAST(COALESCE({m}__dow, 0) AS DOUBLE) / CAST(4 AS DOUBLE))"
        l7 = f"CAST(COALESCE({m}__l7, 0) AS DOUBLE)"
        allv = f"CAST(COALESCE({m}__all, 0) AS DOUBLE)"
        w8 = f"({allv} / CAST(8 AS DOUBLE))"
        vd = var(y, dow)
        hm0 = f"(-({vd}))" if is_cost else f"({vd})"
        hm = f"(CASE WHEN ABS({hm0}) < 0.01 THEN CAST(0 AS DOUBLE) ELSE {hm0} END)"
        sels.append(f"""SELECT client, lifecycle, '{label}' AS metric, {y} AS yesterday, {allv} / CAST(56 AS DOUBLE) AS daily_avg,
  {dow} AS dow_avg, {vd} AS var_dow, {l7} AS last_7, {w8} AS w8_avg, {var(l7, w8)} AS var_w8,
  LEAST(GREATEST({hm}, CAST(-0.5 AS DOUBLE)), CAST(0.5 AS DOUBLE)) AS heat, {hm} <= -0.15 AS flag FROM g""")
    return with_ops(f""",
x AS (SELECT ops_client AS client, extracted_lifecycle AS lifecycle, date_diff('day', ops_date, {REF}) AS _age,
        CAST(records AS DOUBLE) AS records, CAST(kpi2_logins AS DOUBLE) AS logins,
        CAST(conversions AS DOUBLE) AS conversions, CAST(total_cost AS {MONEY}) AS total_cost
      FROM ops_daily WHERE extracted_engagement = 'NLI' AND date_diff('day', ops_date, {REF}) BETWEEN 0 AND 55
        AND upper(trim(extracted_lifecycle)) <> 'UNKNOWN' AND extracted_lifecycle IS NOT NULL),
g0 AS (SELECT client, lifecycle, {", ".join(aggs)} FROM x GROUP BY client, lifecycle),
g AS (SELECT * FROM g0 WHERE {activity} > 0)
{" UNION ALL ".join(sels)}""")


O20 = _o20()

O21 = with_ops(f""", {SLA_TABLE},
limits AS (SELECT client_name AS client, CAST(SUM(monthly_minimum_records) AS BIGINT) AS sla_limit
           FROM contractual_volumes WHERE monthly_minimum_records > 0 GROUP BY client_name),
mtd AS (SELECT ops_client AS client, CAST(SUM(records) AS BIGINT) AS mtd_records FROM ops_daily
        WHERE extracted_engagement = 'NLI' AND date_trunc('month', ops_date) = date_trunc('month', {REF})
          AND ops_date <= {REF} GROUP BY ops_client),
x AS (SELECT l.client, l.sla_limit, COALESCE(m.mtd_records, 0) AS mtd_records,
        CAST(l.sla_limit AS DOUBLE) / CAST(30 AS DOUBLE) * dayofmonth({REF}) AS prorated_sla
      FROM limits l LEFT JOIN mtd m USING (client)),
y AS (SELECT *, CASE WHEN prorated_sla > 0 THEN CAST(mtd_records AS DOUBLE) / prorated_sla ELSE CAST(1 AS DOUBLE) END AS pacing FROM x)
SELECT *, CASE WHEN pacing < 1.0 THEN 'under' ELSE 'over' END AS status FROM y""")


def _o22() -> str:
    cols = [("records", "New Data"), ("kpi2_logins", "Logins"), ("conversions", "Conversions"), ("total_cost", "Total Cost")]
    sums = ", ".join(f"SUM({c}) AS {c}__30, SUM(CASE WHEN age < 7 THEN {c} END) AS {c}__7" for c, _ in cols)
    sels = []
    for c, label in cols:
        a30 = f"CAST(COALESCE({c}__30, 0) AS DOUBLE) / CAST(_span + 1 AS DOUBLE)"
        a7 = f"CAST(COALESCE({c}__7, 0) AS DOUBLE) / CAST(LEAST(_span + 1, 7) AS DOUBLE)"
        sels.append(f"SELECT '{label}' AS metric, {a30} AS avg_30, {a7} AS avg_7, "
                    f"CASE WHEN {a7} >= {a30} THEN 'UP' ELSE 'DOWN' END AS trend FROM g")
    return with_ops(f""",
x AS (SELECT *, date_diff('day', ops_date, {REF}) AS age FROM ops_daily WHERE extracted_engagement = 'NLI'),
g AS (SELECT MAX(age) AS _span, {sums} FROM x WHERE age >= 0 AND age < 30)
{" UNION ALL ".join(sels)}""")


O22 = _o22()

_ALIAS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in O.CLIENT_ALIASES.items())
O23 = with_ops(f"""
SELECT COALESCE(CASE ops_client {_ALIAS} END, ops_client) AS client, CAST(SUM(records) AS BIGINT) AS records
FROM ops_daily GROUP BY client""")

_R4 = ("CAST(SUM(records) AS BIGINT) AS total_records, CAST(SUM(kpi2_logins) AS BIGINT) AS total_logins, "
       "CAST(SUM(conversions) AS BIGINT) AS total_conversions, CAST(SUM(calls) AS BIGINT) AS total_calls")
O24 = with_ops(f"""
SELECT 'client' AS view, ops_client AS key, {_R4} FROM snaps GROUP BY ops_client
UNION ALL SELECT 'client', 'GRAND TOTAL', {_R4} FROM snaps
UNION ALL SELECT 'month', strftime(ops_date, '%Y-%m'), {_R4} FROM snaps GROUP BY strftime(ops_date, '%Y-%m')""", SNAPS)

_OUT_ROWS = [("overall", "Deliveries", "d_plus + d_minus + d_total"), ("overall", "No Answer", "na"),
             ("overall", "Issues", "wn + dnc + dx + t"), ("deliveries", "D+", "d_plus"), ("deliveries", "D", "d_total"),
             ("deliveries", "D-", "d_minus"), ("issues", "WN", "wn"), ("issues", "DNC", "dnc"), ("issues", "DX", "dx"),
             ("issues", "T", "t")]
O25 = with_ops(f""",
t AS (SELECT {", ".join(f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in ("d_plus", "d_minus", "d_total", "na", "wn", "dnc", "dx", "t"))} FROM ops_daily),
r AS ({" UNION ALL ".join(f"SELECT '{a}' AS chart, '{b}' AS outcome, CAST(COALESCE({e}, 0) AS BIGINT) AS value FROM t" for a, b, e in _OUT_ROWS)})
SELECT * FROM r WHERE chart <> 'issues' OR value > 0""")

_TARGETS = f""",
targets0 AS (
  SELECT DISTINCT ops_client AS client_name, tag AS brand_code, campaign_signature FROM ops_base
),
targets AS (
  SELECT campaign_signature,
    (CAST(0.02 AS DOUBLE) + (length(campaign_signature) % 5) * CAST(0.01 AS DOUBLE)) * CAST(100 AS DOUBLE) AS target_conv_pct,
    (CAST(0.10 AS DOUBLE) + (length(campaign_signature) % 7) * CAST(0.01 AS DOUBLE)) * CAST(100 AS DOUBLE) AS target_li_pct,
    CAST(20 AS DOUBLE) + (length(campaign_signature) % 11) AS target_cac_usd
  FROM targets0
)"""

O26 = with_ops(f"""{_TARGETS},
tg AS (SELECT campaign_signature, FIRST(target_conv_pct) AS target_conv_pct, FIRST(target_li_pct) AS target_li_pct,
         FIRST(target_cac_usd) AS target_cac_usd FROM targets GROUP BY campaign_signature),
v AS (SELECT ops_client, COUNT(DISTINCT campaign_signature) AS signatures, MIN(campaign_signature) AS campaign_signature
      FROM ops_base GROUP BY ops_client)
SELECT v.ops_client, CAST(v.signatures AS BIGINT) AS signatures,
  CASE WHEN v.signatures = 1 THEN v.campaign_signature END AS campaign_signature,
  CASE WHEN v.signatures = 1 THEN tg.target_conv_pct END AS target_conv_pct,
  CASE WHEN v.signatures = 1 THEN tg.target_li_pct END AS target_li_pct,
  CASE WHEN v.signatures = 1 THEN tg.target_cac_usd END AS target_cac_usd
FROM v LEFT JOIN tg USING (campaign_signature)""", OPS_BASE)

F16 = with_ops(f""",
cm AS (SELECT ops_brand AS brand, extracted_engagement AS campaign_type, strftime(ops_date, '%Y-%m') AS report_month,
         CAST(SUM(records) AS BIGINT) AS records, CAST(SUM(conversions) AS BIGINT) AS kpi1_conversions,
         CAST(SUM(kpi2_logins) AS BIGINT) AS kpi2_logins, CAST(SUM(calls) AS BIGINT) AS calls,
         CAST(SUM(es) AS BIGINT) AS emails_sent, CAST(SUM(sd) AS BIGINT) AS sms_sent
       FROM ops_daily GROUP BY 1, 2, 3),
sc AS (SELECT * REPLACE (CASE WHEN upper(trim(campaign_type)) = 'LI' THEN 0 ELSE records END AS records,
                         CASE WHEN upper(trim(campaign_type)) = 'LI' THEN 0 ELSE kpi2_logins END AS kpi2_logins) FROM cm),
s AS (SELECT brand, report_month AS month, CAST(COALESCE(SUM(records), 0) AS BIGINT) AS total_records,
        CAST(COALESCE(SUM(kpi1_conversions), 0) AS BIGINT) AS total_kpi1, CAST(COALESCE(SUM(kpi2_logins), 0) AS BIGINT) AS total_kpi2,
        CAST(COALESCE(SUM(calls), 0) AS BIGINT) AS total_calls, CAST(COALESCE(SUM(emails_sent), 0) AS BIGINT) AS total_emails,
        CAST(COALESCE(SUM(sms_sent), 0) AS BIGINT) AS total_sms
      FROM sc WHERE brand IS NOT NULL AND report_month IS NOT NULL GROUP BY brand, report_month),
c AS (SELECT 'Combined' AS brand, month, CAST(SUM(total_records) AS BIGINT) AS total_records, CAST(SUM(total_kpi1) AS BIGINT) AS total_kpi1,
        CAST(SUM(total_kpi2) AS BIGINT) AS total_kpi2, CAST(SUM(total_calls) AS BIGINT) AS total_calls,
        CAST(SUM(total_emails) AS BIGINT) AS total_emails, CAST(SUM(total_sms) AS BIGINT) AS total_sms FROM s GROUP BY month),
u AS (SELECT * FROM s UNION ALL SELECT brand, month, total_records, total_kpi1, total_kpi2, total_calls, total_emails, total_sms FROM c)
SELECT *, CASE WHEN CAST(total_records AS DOUBLE) <> 0 THEN CAST(total_kpi1 AS DOUBLE) / CAST(total_records AS DOUBLE) * CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS kpi1_conversion_rate,
  CASE WHEN CAST(total_records AS DOUBLE) <> 0 THEN CAST(total_kpi2 AS DOUBLE) / CAST(total_records AS DOUBLE) * CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS kpi2_login_rate
FROM u""")

# ---------------------------------------------------------------------------
# Q and P
# ---------------------------------------------------------------------------

_SPINE = f"""bm AS (SELECT brand, MIN({month_index('report_month')}) AS lo, MAX({month_index('report_month')}) AS hi
       FROM player_activity WHERE brand IS NOT NULL AND report_month IS NOT NULL GROUP BY brand),
spine AS (SELECT brand, printf('%04d-%02d', mi // 12, mi % 12 + 1) AS report_month
          FROM (SELECT brand, unnest(generate_series(g.glo, g.ghi)) AS mi
                FROM bm, (SELECT MIN(lo) AS glo, MAX(hi) AS ghi FROM bm) g))"""

Q1 = with_player_activity(f""", {_SPINE}
SELECT brand, report_month FROM spine
WHERE NOT EXISTS (SELECT 1 FROM player_activity p WHERE p.brand = spine.brand AND p.report_month = spine.report_month)""")

Q2 = with_player_activity(f""", {_SPINE},
loaded AS (SELECT DISTINCT brand, report_month FROM player_activity)
SELECT s.report_month, s.brand, CASE WHEN l.brand IS NOT NULL THEN 'IMPORTED' ELSE 'PENDING' END AS status
FROM spine s LEFT JOIN loaded l ON l.brand = s.brand AND l.report_month = s.report_month""")

Q3 = with_ops("""
SELECT DISTINCT tag FROM ops_daily
WHERE tag <> 'UNKNOWN' AND tag IS NOT NULL AND tag NOT IN (SELECT brand_code FROM client_mapping)""")


def _q4() -> str:
    from .sqlkit import PLAYER_ACTIVITY, OPS_DAILY
    return f"""WITH {PLAYER_ACTIVITY}, {OPS_DAILY}, {SLA_TABLE},
names AS (
  SELECT DISTINCT client FROM (
    SELECT client_name AS client FROM client_mapping UNION ALL SELECT client_name FROM contractual_volumes
    UNION ALL SELECT ops_client FROM ops_daily UNION ALL SELECT client FROM player_activity)
  WHERE client IS NOT NULL AND trim(client) <> '' AND client <> 'UNKNOWN'),
brands AS (SELECT client_name AS client, COUNT(*) AS n FROM client_mapping GROUP BY client_name),
slas AS (SELECT client_name AS client, COUNT(*) AS n FROM contractual_volumes GROUP BY client_name),
lo AS (SELECT ops_client AS client, MAX(ops_date) AS d FROM ops_daily GROUP BY ops_client),
lf AS (SELECT client, MAX(report_month) AS m FROM player_activity GROUP BY client)
SELECT names.client, CAST(COALESCE(brands.n, 0) AS BIGINT) AS brands_registered,
  CAST(COALESCE(slas.n, 0) AS BIGINT) AS slas_configured, lo.d AS last_ops_date, lf.m AS last_fin_month,
  CASE WHEN brands.n IS NOT NULL THEN 'Registered' ELSE 'Unregistered' END AS status
FROM names LEFT JOIN brands USING (client) LEFT JOIN slas USING (client) LEFT JOIN lo USING (client)
  LEFT JOIN lf USING (client)"""


Q4 = _q4()


def _q5() -> str:
    from .sqlkit import PLAYER_ACTIVITY, OPS_DAILY
    mstart = "CAST(month || '-01' AS DATE)"
    return f"""WITH {PLAYER_ACTIVITY}, {OPS_DAILY},
g AS (SELECT strftime(ops_date, '%Y-%m') AS month, CAST(COUNT(DISTINCT ops_date) AS BIGINT) AS actual_days,
        CAST(SUM(records) AS BIGINT) AS records, CAST(SUM(kpi2_logins) AS BIGINT) AS logins,
        CAST(SUM(conversions) AS BIGINT) AS conversions, CAST(SUM(calls) AS BIGINT) AS calls FROM ops_daily GROUP BY 1),
e AS (SELECT *, CAST(CASE WHEN date_trunc('month', {REF}) = {mstart} THEN GREATEST(dayofmonth({REF}) - 1, 0)
                          WHEN {mstart} > {REF} THEN 0 ELSE dayofmonth(last_day({mstart})) END AS BIGINT) AS expected_days FROM g),
fin AS (SELECT DISTINCT report_month AS month FROM player_activity)
SELECT e.*,
  CASE WHEN expected_days = 0 THEN 'N/A (Future)' WHEN actual_days = 0 THEN 'Incomplete'
       WHEN actual_days >= expected_days THEN 'Complete'
       WHEN expected_days - actual_days <= 2 THEN printf('Warning (%d/%d days)', actual_days, expected_days)
       ELSE printf('Partial (%d/%d days)', actual_days, expected_days) END AS ops_status,
  CASE WHEN fin.month IS NOT NULL THEN 'Complete'
       WHEN {month_index(f"strftime({REF}, '%Y-%m')")} - {month_index('e.month')} <= 0 THEN 'Pending'
       WHEN {month_index(f"strftime({REF}, '%Y-%m')")} - {month_index('e.month')} = 1 THEN 'Warning (Missing Last Month)'
       ELSE 'Issue (Missing +2 Months)' END AS financial_status
FROM e LEFT JOIN fin ON fin.month = e.month"""


Q5 = _q5()

Q7 = with_ops(f"""
SELECT ops_date, CAST(SUM(records) AS BIGINT) AS records, CAST(SUM(kpi2_logins) AS BIGINT) AS logins,
  CAST(SUM(conversions) AS BIGINT) AS conversions, CAST(SUM(calls) AS BIGINT) AS calls
FROM ops_daily WHERE strftime(ops_date, '%Y-%m') = strftime({REF}, '%Y-%m') GROUP BY ops_date""")

Q8 = with_ops("""
SELECT CAST(d AS DATE) AS ops_date
FROM (SELECT unnest(generate_series(CAST(MIN(ops_date) AS TIMESTAMP), CAST(MAX(ops_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS d
      FROM ops_daily)
WHERE CAST(d AS DATE) NOT IN (SELECT ops_date FROM ops_daily)""")

Q9 = with_ops("""
SELECT MIN(ops_date) AS raw_min, MAX(ops_date) AS raw_max,
  (SELECT MIN(ops_date) FROM latest_snaps) AS mat_min, (SELECT MAX(ops_date) FROM latest_snaps) AS mat_max,
  MIN(ops_date) = (SELECT MIN(ops_date) FROM latest_snaps) AND MAX(ops_date) = (SELECT MAX(ops_date) FROM latest_snaps) AS in_sync
FROM ops_daily""", SNAPS + LATEST_SNAPS)

Q10 = with_ops(f"""
SELECT {REF} AS target_date, CAST(COUNT(*) AS BIGINT) AS rows, COUNT(*) > 0 AS ok FROM ops_daily WHERE ops_date = {REF}""")

P1_SPEC = {"client": "Northwind Gaming", "engagement": "NLI", "campaign": "dk", "start": "1997-01-01",
           "end": "1999-12-31"}
P1 = with_ops("""
SELECT campaign_name, ops_client, ops_date, records, conversions FROM ops_daily
WHERE ops_client = 'Northwind Gaming' AND extracted_engagement = 'NLI' AND contains(lower(campaign_name), 'dk')
  AND ops_date >= DATE '1997-01-01' AND ops_date <= DATE '1999-12-31'""")


def _p2() -> str:
    from .sqlkit import PLAYER_ACTIVITY, OPS_DAILY
    return f"""WITH {PLAYER_ACTIVITY}, {OPS_DAILY},
u AS (
  SELECT 'client' AS dimension, ops_client AS value FROM ops_daily UNION ALL SELECT 'client', client FROM player_activity
  UNION ALL SELECT 'brand', ops_brand FROM ops_daily UNION ALL SELECT 'brand', brand FROM player_activity
  UNION ALL SELECT 'country', upper(country) FROM ops_daily
  UNION ALL SELECT 'lifecycle', extracted_lifecycle FROM ops_daily
  UNION ALL SELECT 'segment', extracted_segment FROM ops_daily
  UNION ALL SELECT 'engagement', extracted_engagement FROM ops_daily
  UNION ALL SELECT 'product', extracted_product FROM ops_daily)
SELECT DISTINCT dimension, value FROM u WHERE value IS NOT NULL AND trim(value) <> '' AND upper(value) <> 'UNKNOWN'"""


P2 = _p2()


def _p3() -> str:
    from .sqlkit import PLAYER_ACTIVITY, OPS_DAILY
    return f"""WITH {PLAYER_ACTIVITY}, {OPS_DAILY}
SELECT LEAST(MIN(ops_date), (SELECT CAST(MIN(report_month) || '-01' AS DATE) FROM player_activity)) AS min_date,
  GREATEST(MAX(ops_date), (SELECT last_day(CAST(MAX(report_month) || '-01' AS DATE)) FROM player_activity)) AS max_date
FROM ops_daily"""


P3 = _p3()


def _p4() -> str:
    hi, lo = "b.hi", "b.lo"
    first = f"CAST(date_trunc('month', {hi}) AS DATE)"
    lme = f"CAST({first} - 1 AS DATE)"
    rows = [("Yesterday", hi, hi)]
    for n in (7, 14, 30, 90):
        rows.append((f"Last {n} Days", f"CAST({hi} - {n - 1} AS DATE)", hi))
    rows += [("Current Month", first, hi), ("Last Month", f"CAST(date_trunc('month', {lme}) AS DATE)", lme)]
    sels = [f"SELECT CAST({i} AS BIGINT) AS position, '{n}' AS preset, GREATEST({s}, {lo}) AS start_date, "
            f"LEAST({e}, {hi}) AS end_date FROM b" for i, (n, s, e) in enumerate(rows)]
    return with_ops(f""",
b AS (SELECT MIN(ops_date) AS lo, MAX(ops_date) AS hi FROM ops_daily)
{" UNION ALL ".join(sels)}""")


P4 = _p4()

P5 = with_ops(f"""
SELECT * FROM (
  SELECT {half('ops_date')} AS half,
    make_date(year(ops_date), CASE WHEN month(ops_date) <= 6 THEN 1 ELSE 7 END, 1) AS start_date,
    CASE WHEN month(ops_date) <= 6 THEN make_date(year(ops_date), 6, 30) ELSE make_date(year(ops_date), 12, 31) END AS end_date,
    CAST(COUNT(DISTINCT ops_date) AS BIGINT) AS days_with_data
  FROM ops_daily GROUP BY 1, 2, 3)
WHERE end_date < {REF}""")

P6 = with_ops(f"""
SELECT week_start, CAST(COUNT(DISTINCT ops_date) AS BIGINT) AS days_with_data, CAST(SUM(records) AS BIGINT) AS records,
  CAST(week_start + 6 AS DATE) AS week_end
FROM (SELECT *, {week_start('ops_date')} AS week_start FROM ops_daily WHERE ops_date <= {last_thu(REF)})
GROUP BY week_start""")

P8 = with_ops("""
SELECT campaign_name, ops_date, records FROM ops_daily WHERE contains(lower(campaign_name), 'nli')
ORDER BY campaign_name, ops_date OFFSET 1000 LIMIT 1000""")

ORACLES = {
    "c1_campaign_parse": C1,
    "c8_campaign_signatures": C8,
    "c12_short_name_totals": C12,
    "f16_campaign_summary": F16,
    "o3_daily_pulse": O3,
    "o4_pulse_windows": O4,
    "o5_historical_benchmarks": O5,
    "o6_half_over_half": O6,
    "o7_sla_fulfilment": O7,
    "o8_sla_breaches": O8,
    "o9_volume_90d": O9,
    "o10_cac_header": O10,
    "o11_weekly_conversions": O11,
    "o12_weekly_logins_cpc": O12,
    "o13_latest_snapshots": O13,
    "o14_daily_efficiency": O14,
    "o15_weekly_efficiency": O15,
    "o16_pitch_scorecard": O16,
    "o18_daily_campaign_detail": O18,
    "o19_true_cost_ledger": O19,
    "o20_morning_variance": O20,
    "o21_sla_pacing": O21,
    "o22_trend_flags": O22,
    "o23_client_alias_recap": O23,
    "o24_recap": O24,
    "o25_outcome_distributions": O25,
    "o26_signature_targets": O26,
    "q1_registry_gaps": Q1,
    "q2_compliance_grid": Q2,
    "q3_unmapped_tags": Q3,
    "q4_client_health": Q4,
    "q5_ops_completeness": Q5,
    "q7_daily_drilldown": Q7,
    "q8_date_gaps": Q8,
    "q9_sync_check": Q9,
    "q10_post_load_check": Q10,
    "p1_global_filter": P1,
    "p2_filter_domains": P2,
    "p3_date_bounds": P3,
    "p4_period_presets": P4,
    "p5_completed_halves": P5,
    "p6_completed_weeks": P6,
    "p8_search_page": P8,
}


# ---------------------------------------------------------------------------
# Views added after the first block
# ---------------------------------------------------------------------------
O1 = with_ops("""
SELECT campaign_name, ops_client, ops_brand, ops_date, records, CAST(total_cost AS DOUBLE) AS total_cost, core_signature,
  campaign_signature, strategy_signature, ops_lifecycle FROM ops_base""", OPS_BASE)

O2 = with_ops("""
SELECT campaign_name, ops_date, records,
  concat_ws('-', COALESCE(ops_brand, 'UNKNOWN'), COALESCE(country, 'UNKNOWN'), COALESCE(extracted_lifecycle, 'UNKNOWN'),
            COALESCE(extracted_engagement, 'UNKNOWN')) AS strategy_signature FROM snaps""", SNAPS)

O17 = with_ops(f""",
g AS (SELECT core_signature, {", ".join(f"CAST(SUM({s}) AS BIGINT) AS {s}" for s in O.SCORE_SUMS)}
      FROM ops_base GROUP BY core_signature),
s AS ({_score('g', 'core_signature')})
SELECT core_signature, {_BANDS} FROM s""", OPS_BASE)

P7 = with_ops("""
SELECT ops_client, CAST(SUM(records) AS BIGINT) AS records FROM ops_daily
WHERE ops_client IN ('Northwind Gaming', 'Orchid Media') GROUP BY ops_client""")


def _c18() -> str:
    from .registry import BRAND_MERGES
    case = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in BRAND_MERGES)
    return with_player_activity(f"""
SELECT brand, CAST(COUNT(*) AS BIGINT) AS rows, CAST(CAST(SUM(revenue) AS DECIMAL(18,2)) AS DOUBLE) AS ggr
FROM (SELECT COALESCE(CASE brand {case} END, brand) AS brand, revenue FROM player_activity) GROUP BY brand""")


C18 = _c18()

C19 = with_ops("SELECT campaign_name, extracted_lifecycle, extracted_engagement FROM ops_daily")

ORACLES.update({
    "o1_ops_base": O1,
    "o2_snapshots_base": O2,
    "o17_color_bands": O17,
    "p7_client_visibility": P7,
    "c18_brand_merge": C18,
    "c19_reparse_unknown": C19,
})

# S3: the same campaign summary after the file round trip; the loader title-cases
# the brand (initcap(trim(brand))).
_INITCAP = "array_to_string(list_transform(string_split(lower(trim(ops_brand)), ' '), lambda w: upper(w[1:1]) || w[2:]), ' ')"
S3 = F16.replace("cm AS (SELECT ops_brand AS brand,", f"cm AS (SELECT {_INITCAP} AS brand,")
assert S3 != F16
ORACLES["s3_campaign_files"] = S3

ORACLES["w5_upsert_by_key"] = ORACLES["o13_latest_snapshots"]


def _c18b() -> str:
    from ..sources.dims import CLIENT_MAPPING
    from .registry import CLIENT_RENAMES
    case = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in CLIENT_RENAMES.items())
    names = ", ".join(f"('{m[2]}')" for m in CLIENT_MAPPING)
    every = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COALESCE(CASE {c} {case} END, {c}) AS client FROM {src}"
        for t, c, src in (("client_mapping", "client_name", f"(VALUES {names}) m(client_name)"), ("player_activity", "client", "player_activity"),
                          ("ops_daily", "ops_client", "ops_daily")))
    return with_ops(f"SELECT table_name, client, CAST(COUNT(*) AS BIGINT) AS rows FROM ({every}) GROUP BY 1, 2", ",\n" + PLAYER_ACTIVITY)


ORACLES["c18b_rename_cascade"] = _c18b()
