"""SQL text shared by the oracle queries (DuckDB dialect).

The adapters below mirror ``sources/testdata.py`` expression by expression so
that both engines see the same canonical facts.  Helpers render the same
arithmetic the Spark helpers in ``functions/core.py`` use (same operation
order, same types), which is what makes the comparisons exact.
"""

from __future__ import annotations

from ..sources import testdata as T
from ..sources.dims import CLIENT_MAPPING, CONTRACTUAL_VOLUMES

D = "DOUBLE"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def pct(num: str, den: str) -> str:
    return (f"COALESCE(CASE WHEN CAST({den} AS DOUBLE) <> 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) "
            f"* CAST(100 AS DOUBLE) END, CAST(0 AS DOUBLE))")


def div(num: str, den: str) -> str:
    return (f"COALESCE(CASE WHEN CAST({den} AS DOUBLE) <> 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) "
            f"END, CAST(0 AS DOUBLE))")


def count_if(cond: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def msum(x: str) -> str:
    return f"CAST(COALESCE(SUM({x}), 0) AS DECIMAL(18,2))"


def rev_share(x: str) -> str:
    return f"CAST(ROUND({x} * CAST(0.15 AS DECIMAL(4,2)), 2) AS DECIMAL(18,2))"


def month_from_index(i: str) -> str:
    return f"printf('%04d-%02d', ({i}) // 12, ({i}) % 12 + 1)"


def month_index(m: str) -> str:
    return f"(CAST(substr({m}, 1, 4) AS INTEGER) * 12 + CAST(substr({m}, 6, 2) AS INTEGER) - 1)"


def values_list(rows) -> str:
    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)
    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


def _pick(values, idx: str) -> str:
    arr = "[" + ", ".join("'" + v + "'" for v in values) + "]"
    return f"{arr}[({idx}) + 1]"


MONEY = "DECIMAL(18,2)"

PLAYER_LINES = f"""
geo AS (
  SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
),
pl_raw AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS id, g.r_name AS client, p.p_type AS brand, g.n_name AS country,
         c.c_mktsegment AS wb_tag, c.c_mktsegment AS segment,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l.l_discount AS DECIMAL(4,2)) AS disc,
         CAST(l.l_tax AS DECIMAL(4,2)) AS tax, l.l_returnflag AS rf, l.l_linestatus AS ls,
         l.l_orderkey AS orderkey, o.o_orderdate AS orderdate
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN geo g ON c.c_nationkey = g.n_nationkey
  JOIN lineitem l ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
pl_money AS (
  SELECT *, CAST(ROUND(price * (disc - 0.04), 2) AS {MONEY}) AS revenue,
         CAST(ROUND(price * disc, 2) AS {MONEY}) AS bonus,
         CAST(ROUND(price * tax, 2) AS {MONEY}) AS taxamt
  FROM pl_raw
),
pl_money2 AS (
  SELECT *, CAST(ROUND(revenue * (1 - tax), 2) AS {MONEY}) AS ngr FROM pl_money
),
player_lines AS (
  SELECT id, client, brand, country, wb_tag, segment,
    CAST(price AS {MONEY}) AS bet, revenue, ngr,
    CAST(CASE WHEN ls = 'F' THEN price ELSE 0 END AS {MONEY}) AS bet_casino,
    CAST(CASE WHEN ls = 'F' THEN revenue ELSE 0 END AS {MONEY}) AS revenue_casino,
    CAST(CASE WHEN ls = 'F' THEN ngr ELSE 0 END AS {MONEY}) AS ngr_casino,
    CAST(CASE WHEN ls = 'O' THEN price ELSE 0 END AS {MONEY}) AS bet_sports,
    CAST(CASE WHEN ls = 'O' THEN revenue ELSE 0 END AS {MONEY}) AS revenue_sports,
    CAST(CASE WHEN ls = 'O' THEN ngr ELSE 0 END AS {MONEY}) AS ngr_sports,
    CAST(CASE WHEN rf = 'A' THEN 1 ELSE 0 END AS BIGINT) AS deposit_count,
    CAST(CASE WHEN rf = 'A' THEN price ELSE 0 END AS {MONEY}) AS deposits,
    CAST(CASE WHEN rf = 'R' THEN price ELSE 0 END AS {MONEY}) AS withdrawals,
    bonus AS bonus_total,
    CAST(CASE WHEN ls = 'F' THEN bonus ELSE 0 END AS {MONEY}) AS bonus_casino,
    CAST(CASE WHEN ls = 'O' THEN bonus ELSE 0 END AS {MONEY}) AS bonus_sports,
    taxamt AS tax_total,
    {month_from_index(f"{T.BASE_MONTH_INDEX} + (year(orderdate) * 12 + month(orderdate)) % {T.FOLD_MONTHS}")} AS report_month,
    CAST(orderdate AS DATE) AS reactivation_date,
    CAST(CAST(orderdate AS DATE) - CAST(orderkey % 45 - 3 AS INTEGER) AS DATE) AS campaign_start_date,
    CAST(orderkey % 45 - 3 AS INTEGER) AS reactivation_days
  FROM pl_money2
)"""

_PA_SUMS = ",\n    ".join(f"CAST(SUM({m}) AS {MONEY}) AS {m}" for m in T.PLAYER_MEASURES)

PLAYER_ACTIVITY = PLAYER_LINES + f""",
player_activity AS (
  SELECT id, brand, report_month, client, country, wb_tag, segment,
    {_PA_SUMS},
    CAST(SUM(deposit_count) AS BIGINT) AS deposit_count
  FROM player_lines
  GROUP BY id, brand, report_month, client, country, wb_tag, segment
)"""


def _flag(c: str) -> str:
    return f"CASE WHEN {c} THEN 1 ELSE 0 END"


_OPS_COUNTERS = {
    "records": "q",
    "calls": "q + 3",
    "conversions": _flag("l_returnflag = 'R'"),
    "kpi2_logins": _flag("l_linestatus = 'O'"),
    "d_plus": "l_partkey % 3",
    "d_minus": "l_suppkey % 2",
    "d_neutral": "l_linenumber % 4",
    "tech_issues": "l_partkey % 2",
    "am": "l_suppkey % 3",
    "dnc": _flag("l_linenumber = 1"),
    "na": "q % 5",
    "dx": _flag("l_partkey % 4 = 0"),
    "wn": _flag("l_suppkey % 7 = 0"),
    "hlrv": _flag("l_partkey % 11 = 0"),
    "twoxrv": _flag("l_partkey % 13 = 0"),
    "sa": "q % 3",
    "sd": "q % 4",
    "sf": _flag("l_suppkey % 5 = 0"),
    "sp": _flag("l_suppkey % 6 = 0"),
    "ev": "q % 6",
    "es": "q % 7",
    "ed": "q % 5",
    "eo": "q % 3",
    "ec": _flag("q % 4 = 0"),
    "ef": _flag("q % 9 = 0"),
    "optouts_all": _flag("l_partkey % 17 = 0"),
    "optout_call": _flag("l_partkey % 51 = 0"),
    "optout_sms": _flag("l_partkey % 34 = 0"),
    "optout_email": _flag("l_partkey % 68 = 0"),
}

_SEP = "CASE WHEN o_custkey % 5 = 0 THEN '_' ELSE '-' END"
_BODY = ("concat_ws('-', " + ", ".join([
    _pick(T.GEN_TAGS, "o_custkey % 8"), _pick(T.GEN_COUNTRIES, "o_custkey % 11"),
    _pick(T.GEN_LANGS, "o_orderkey % 6"), _pick(T.GEN_PRODUCTS, "o_orderkey % 5"),
    _pick(T.GEN_SEGMENTS, "o_custkey % 7"), _pick(T.GEN_LIFECYCLES, "o_custkey % 10"),
    _pick(T.GEN_SUBS, "o_orderkey % 4"), _pick(T.GEN_ENGAGEMENTS, "(o_orderkey // 3) % 5")]) + ")")
_CDATE = "CAST(CAST(o_orderdate AS DATE) - CAST(o_orderkey % 9 AS INTEGER) AS DATE)"
_SUFFIX = (f"CASE o_orderkey % 4 WHEN 0 THEN '-' || strftime({_CDATE}, '%Y-%m-%d') "
           f"WHEN 1 THEN '_' || strftime({_CDATE}, '%Y_%m_%d') "
           f"WHEN 2 THEN '-' || upper(strftime({_CDATE}, '%d%b%Y')) ELSE '' END")

_LIST = lambda vals: "[" + ", ".join("'" + v + "'" for v in vals) + "]"


def _first_in(vocab) -> str:
    return f"COALESCE(list_filter(toks, lambda t: list_contains({_LIST(vocab)}, t))[1], 'UNKNOWN')"


def _ops_sql() -> str:
    from ..functions import campaign as C
    sums = ",\n    ".join(f"CAST(SUM({e}) AS BIGINT) AS {n}" for n, e in _OPS_COUNTERS.items())
    lang_pairs = ", ".join(f"('{k}', '{v}')" for k, v in C.LANGUAGE_DEFAULTS.items())
    block = _LIST(C.COUNTRY_BLOCKLIST)
    mapping = values_list(CLIENT_MAPPING)
    return f"""
ops_lines AS (
  SELECT l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS BIGINT) AS q, l_extendedprice,
         l_returnflag, l_linestatus, CAST(o_orderdate AS DATE) AS ops_date,
         replace({_BODY}, '-', {_SEP}) || {_SUFFIX} AS campaign
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
ops_agg AS (
  SELECT campaign, ops_date,
    {sums},
    SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS _price
  FROM ops_lines GROUP BY campaign, ops_date
),
ops_tok AS (
  SELECT *, list_transform(string_split(replace(upper(campaign), '_', '-'), '-'),
                           lambda t: CASE WHEN t = 'WBD' THEN 'WB' ELSE t END) AS toks
  FROM ops_agg
),
ops_tag AS (
  SELECT *, CASE WHEN COALESCE(toks[1], '') = '' THEN 'UNKNOWN' ELSE toks[1] END AS tag FROM ops_tok
),
ops_parsed AS (
  SELECT *,
    {_first_in(C.LIFECYCLES)} AS extracted_lifecycle,
    {_first_in(C.SEGMENTS)} AS extracted_segment,
    {_first_in(C.ENGAGEMENTS)} AS extracted_engagement,
    {_first_in(C.PRODUCTS)} AS extracted_product,
    {_first_in(C.SUBLIFECYCLES)} AS extracted_sublifecycle,
    COALESCE(list_filter(toks, lambda t, i: i > 1 AND regexp_matches(t, '^\\p{{L}}{{2,3}}$')
             AND NOT list_contains({block}, t) AND t <> tag)[1], 'Global') AS country,
    CASE WHEN len(list_filter(toks, lambda t: trim(t) <> '')) >= 3
         THEN array_to_string(list_filter(toks, lambda t: trim(t) <> '')[-3:], '-') END AS _last3
  FROM ops_tag
),
lang_map(k, v) AS (VALUES {lang_pairs}),
client_mapping(brand_code, brand_name, client_name, financial_format) AS (VALUES {mapping}),
ops_daily AS (
  SELECT campaign || '_' || strftime(ops_date, '%Y-%m-%d') AS campaign_name,
    COALESCE(cm.client_name, 'UNKNOWN') AS ops_client,
    COALESCE(cm.brand_name, p.tag) AS ops_brand,
    ops_date,
    {", ".join(T.OPS_COUNTERS[:4])},
    d_neutral AS d_total, d_plus, d_minus, d_neutral, tech_issues, tech_issues AS t,
    {", ".join(T.OPS_COUNTERS[10:])},
    CAST(cost_caller + cost_sip + cost_sms + cost_email AS {MONEY}) AS total_cost,
    CASE WHEN conversions > 0 THEN CAST(CAST(cost_caller + cost_sip + cost_sms + cost_email AS {MONEY}) AS DOUBLE) / conversions
         ELSE CAST(0 AS DOUBLE) END AS true_cac,
    cost_caller, cost_sip, cost_sms, cost_email,
    CASE WHEN calls > 0 THEN d_plus / calls ELSE CAST(0 AS DOUBLE) END AS d_ratio,
    CASE WHEN records > 0 THEN kpi2_logins / records ELSE CAST(0 AS DOUBLE) END AS li_pct,
    extracted_engagement, extracted_lifecycle, extracted_segment, extracted_product,
    COALESCE(lm.v, 'UNKNOWN') AS extracted_language, extracted_sublifecycle, country,
    CASE WHEN regexp_matches(_last3, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}$')
         THEN CAST(date_diff('day', CAST(try_strptime(_last3, '%Y-%m-%d') AS DATE), ops_date) AS INTEGER) END
      AS campaign_data_age_days,
    p.tag AS tag
  FROM (
    SELECT *,
      CAST(ROUND(_price * 0.001, 2) AS {MONEY}) AS cost_caller,
      CAST(ROUND(calls * 0.02, 2) AS {MONEY}) AS cost_sip,
      CAST(ROUND(sd * 0.05, 2) AS {MONEY}) AS cost_sms,
      CAST(ROUND(es * 0.01, 2) AS {MONEY}) AS cost_email
    FROM ops_parsed) p
  LEFT JOIN client_mapping cm ON cm.brand_code = p.tag
  LEFT JOIN lang_map lm ON lm.k = p.country
)"""


OPS_DAILY = _ops_sql()


def with_player_activity(body: str) -> str:
    return f"WITH {PLAYER_ACTIVITY}\n{body}"


def with_player_lines(body: str) -> str:
    return f"WITH {PLAYER_LINES}\n{body}"


def with_ops(body: str, extra: str = "") -> str:
    return f"WITH {OPS_DAILY}{extra}\n{body}"


SLA_TABLE = f"contractual_volumes(client_name, brand_code, lifecycle, monthly_minimum_records) AS (VALUES {values_list(CONTRACTUAL_VOLUMES)})"
