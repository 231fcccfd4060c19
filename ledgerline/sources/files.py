"""File sources (S1–S11) and financial format adapters.

Raw exports arrive as CSV (or parquet exports of workbooks carrying a
``sheet_name`` column).  Everything is read as strings with an explicit header
layout and coerced with ``try_cast``; file names are parsed from
``_metadata.file_name``, so one read covers any number of files and Spark
splits the work by file.  Only file *listing* happens on the driver.
"""

from __future__ import annotations

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import campaign as C
from ..functions.core import MONEY

# ---------------------------------------------------------------------------
# Raw header layouts of the three financial export formats, the
# monthly campaign file and the daily operations file.  These are the input
# contract of the exports, so they are written out exactly.
# ---------------------------------------------------------------------------
DETAILED_HEADERS = {
    "Player Key": "id",
    "Brand": "brand",
    "Segment": "wb_tag",
    "Turnover (Total) €": "bet",
    "GGR (Total) €": "revenue",
    "NGR (Total) € after Tax": "ngr",
    "Country": "country",
    "Turnover (Casino) €": "bet_casino",
    "GGR (Casino) €": "revenue_casino",
    "NGR (Casino) €": "ngr_casino",
    "Turnover (Sports) €": "bet_sports",
    "GGR (Sports) €": "revenue_sports",
    "NGR (Sports) €": "ngr_sports",
    "Deposit #": "deposit_count",
    "Deposit €": "deposits",
    "Withdrawal €": "withdrawals",
    "Bonus Cost (Casino) €": "bonus_casino",
    "Bonus Cost (Sports) €": "bonus_sports",
    "Tax €": "tax_total",
    "Reactivation Date": "reactivation_date",
    "Campaign Start Date": "campaign_start_date",
}
DETAILED_BONUS_TOTAL_MATCH = "Bonus Cost (Total)"
BASIC_HEADERS = {
    "Player unique identifier": "id",
    "Brand": "brand",
    "WB tag/flag": "wb_tag",
    "Bet": "bet",
    "Win": "win",
    "Revenue": "revenue",
}
SHEET_ID_HEADER = "Player Id"
SHEET_GGR_MATCH = "Total GGR"
SHEET_NGR_MATCH = "Total NGR"
SHEET_DEPOSITS_MATCH = "Deposits"
CAMPAIGN_HEADERS = {
    "Brand": "brand",
    "Campaign": "campaign_type",
    "Records": "records",
    "KPI 1 - Conversions": "kpi1_conversions",
    "KPI 2 - Logins": "kpi2_logins",
    "Calls": "calls",
    "ES": "emails_sent",
    "SS": "sms_sent",
}
OPS_METRIC_HEADERS = [
    "# Records", "New Data", "Calls", "KPI1-Conv.", "KPI2-Login", "LI%", "Cost Caller", "Cost SIP",
    "Cost SMS", "Cost Email", "D", "D+", "D-", "D Ratio", "T", "AM", "DNC", "NA", "DX", "WN",
    "HLRV", "2XRV", "SA", "SD", "SF", "SP", "EV", "ES", "ED", "EO", "EC", "EF",
    "Optouts (All)", "Optout - Call", "Optout - SMS", "Optout - Email",
]
OPS_RENAMES = {
    "Calls": "calls", "KPI1-Conv.": "conversions", "D": "d_neutral", "D+": "d_plus", "D-": "d_minus",
    "D Ratio": "d_ratio", "KPI2-Login": "kpi2_logins", "LI%": "li_pct", "T": "tech_issues",
    "Cost Caller": "cost_caller", "Cost SIP": "cost_sip", "Cost SMS": "cost_sms", "Cost Email": "cost_email",
    "AM": "am", "DNC": "dnc", "NA": "na", "DX": "dx", "WN": "wn", "HLRV": "hlrv", "2XRV": "twoxrv",
    "SA": "sa", "SD": "sd", "SF": "sf", "SP": "sp", "EV": "ev", "ES": "es", "ED": "ed", "EO": "eo",
    "EC": "ec", "EF": "ef", "Optouts (All)": "optouts_all", "Optout - Call": "optout_call",
    "Optout - SMS": "optout_sms", "Optout - Email": "optout_email",
}
# Month-name file pattern (``Jan '26``) for one client's export naming.
MONTH_NAMES = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

MONEY_COLS = ["bet", "revenue", "ngr", "bet_casino", "revenue_casino", "ngr_casino", "bet_sports",
              "revenue_sports", "ngr_sports", "deposits", "withdrawals", "bonus_total", "bonus_casino",
              "bonus_sports", "tax_total"]


# ---------------------------------------------------------------------------
# Generic CSV reading
# ---------------------------------------------------------------------------

def clean_header(name: str, strip_quotes: bool = False) -> str:
    """Strip BOM and surrounding whitespace (and quotes for ops files)."""
    s = str(name).replace("﻿", "")
    if strip_quotes:
        s = s.replace('"', "")
    return s.strip()


def unquoted(path: Column) -> Column:
    """A metadata path or name as the file system has it (as ``unquote`` does)."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


#: Where the text of a malformed line is kept.
CORRUPT = "_corrupt_line"


def read_csv_strings(spark: SparkSession, paths: list[str] | str, encoding: str = "UTF-8",
                     strip_quotes: bool = False, header: str | None = None) -> DataFrame:
    """All columns as strings, cleaned headers, with the source file name.

    PERMISSIVE mode keeps malformed rows (S11); empty files contribute no rows.  With the files'
    ``header`` line, the text of lines that have more or fewer cells than it is kept in ``CORRUPT``.
    """
    reader = (spark.read.option("header", True).option("inferSchema", False).option("mode", "PERMISSIVE")
              .option("encoding", encoding).option("multiLine", False))
    if header is not None:
        names = [clean_header(c, strip_quotes) for c in next(csv.reader([header]))]
        cells = [StructField(c, StringType()) for c in [*names, CORRUPT]]
        # cells are counted on whole lines, so no column may be pruned while parsing
        reader = reader.option("columnPruning", False).option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", True).schema(StructType(cells))
    df = reader.csv(paths)
    df = df.toDF(*[clean_header(c, strip_quotes) for c in df.columns])
    return df.withColumn("_file", unquoted(F.col("_metadata.file_name"))).withColumn("_path", F.col("_metadata.file_path"))


def files_needing_latin1(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files holding bytes that are not valid UTF-8."""
    t = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), "value")
    return t.where(~F.expr("is_valid_utf8(value)")).select("path").distinct()


def file_layouts(spark: SparkSession, paths: list[str] | str) -> dict[tuple[str, str], list[str]]:
    """Files by (header line, encoding), on their full paths, from one distributed scan.

    S10: a file with bytes that are not valid UTF-8 is ISO-8859-1.  S11: empty files have no
    layout.  One row per file reaches the driver."""
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value")
    found = lines.groupBy("path").agg(F.min_by("value", F.struct("block", "line")).alias("header"),
                                      F.bool_and(F.expr("is_valid_utf8(value)")).alias("utf8")).collect()
    out: dict[tuple[str, str], list[str]] = {}
    for r in sorted(found, key=lambda r: r.path):
        out.setdefault((r.header, "UTF-8" if r.utf8 else "ISO-8859-1"), []).append(unquote(r.path))
    return out


def read_csv_any_encoding(spark: SparkSession, paths: list[str], strip_quotes: bool = False) -> DataFrame:
    """Every file is read under its own header and encoding, and the parts are united
    by column name.  ``_header`` holds the cleaned header of the row's file; without any line
    in the files there are no rows and no other columns."""
    return read_layouts(spark, file_layouts(spark, paths), strip_quotes).drop("_path")


def read_layouts(spark: SparkSession, layouts: dict[tuple[str, str], list[str]], strip_quotes: bool = False,
                 corrupt: bool = False) -> DataFrame:
    """The files of ``file_layouts``, each read once; ``corrupt`` keeps malformed lines."""
    parts = []
    for (header, encoding), files in layouts.items():
        part = read_csv_strings(spark, files, encoding, strip_quotes, header if corrupt else None)
        names = [c for c in part.columns if c not in ("_file", "_path", CORRUPT)]
        parts.append(part.withColumn("_header", F.array(*map(F.lit, names))))
    if not parts:
        return spark.createDataFrame([], "_file string, _path string, _header array<string>")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def num(c: str) -> Column:
    """Coerce a text cell to money; text, blanks → 0 (ruling Q22: all formats fill 0)."""
    return F.coalesce(F.trim(F.col(c)).try_cast(MONEY), F.lit(0).cast(MONEY))


# ---------------------------------------------------------------------------
# File-name parsing
# ---------------------------------------------------------------------------

def escape_brand(brand: Column) -> Column:
    """A brand as part of a file name: ``%`` and ``/`` are escaped, no visible one is ``%0``."""
    text = F.coalesce(brand, F.lit(""))
    return F.when(F.trim(text) == "", F.lit("%0")).otherwise(F.replace(F.replace(text, F.lit("%"), F.lit("%25")), F.lit("/"), F.lit("%2F")))


def unescape_brand(name: Column) -> Column:
    """The brand that ``escape_brand`` wrote."""
    return F.when(name == "%0", F.lit("")).otherwise(F.replace(F.replace(name, F.lit("%2F"), F.lit("/")), F.lit("%25"), F.lit("%")))


def brand_month_from_filename(name: Column, month_name_brand: str | None = None) -> tuple[Column, Column]:
    """``brand_yyyy_mm.ext`` or ``yyyy-mm brand.ext``; for the one client
    whose exports are named with a month name and a two-digit year (``Jan '26``),
    pass its brand key as ``month_name_brand``."""
    lower = F.lower(name)
    p1 = r"^([a-z]+)_(\d{4})_(\d{2})\.(csv|xlsx)$"
    stem = F.regexp_replace(name, r"(?i)\.(csv|xlsx|xls)$", "")
    p2 = r"^(\d{4})-(\d{2})\s+(.+)$"
    month_num = None
    for i, m in enumerate(MONTH_NAMES):
        cond = lower.contains(m)
        val = F.lit(f"{i + 1:02d}")
        month_num = F.when(cond, val) if month_num is None else month_num.when(cond, val)
    yy = F.regexp_extract(lower, r"(?:'|20)(\d{2})\b", 1)
    named = F.lit(False)
    if month_name_brand:
        named = lower.contains(month_name_brand.lower()) & month_num.isNotNull() & (yy != "")
    brand = (F.when(named, F.lit(month_name_brand.lower() if month_name_brand else None))
             .when(lower.rlike(p1), F.regexp_extract(lower, p1, 1))
             .when(F.trim(stem).rlike(p2), F.lower(F.trim(unescape_brand(F.regexp_extract(F.trim(stem), p2, 3))))))
    month = (F.when(named, F.concat(F.lit("20"), yy, F.lit("-"), month_num))
             .when(lower.rlike(p1), F.concat(F.regexp_extract(lower, p1, 2), F.lit("-"), F.regexp_extract(lower, p1, 3)))
             .when(F.trim(stem).rlike(p2), F.concat(F.regexp_extract(F.trim(stem), p2, 1), F.lit("-"),
                                                    F.regexp_extract(F.trim(stem), p2, 2))))
    return brand, month


def date_from_filename(name: Column) -> Column:
    """``20yy[-_]mm[-_]dd``, else ``20yy[-_]mm`` + ``-01``."""
    d = r"(20\d{2})[-_](\d{2})[-_](\d{2})"
    m = r"(20\d{2})[-_](\d{2})"
    daily = F.concat_ws("-", F.regexp_extract(name, d, 1), F.regexp_extract(name, d, 2), F.regexp_extract(name, d, 3))
    monthly = F.concat_ws("-", F.regexp_extract(name, m, 1), F.regexp_extract(name, m, 2), F.lit("01"))
    return F.when(name.rlike(d), F.try_to_date(daily, "yyyy-MM-dd")) \
        .when(name.rlike(m), F.try_to_date(monthly, "yyyy-MM-dd"))


# ---------------------------------------------------------------------------
# Format adapters
# ---------------------------------------------------------------------------

def _finish(df: DataFrame) -> DataFrame:
    cols = ["id", "client", "brand", "country", "wb_tag", "segment", *MONEY_COLS, "deposit_count",
            "report_month", "reactivation_date", "campaign_start_date", "reactivation_days", "_file"]
    for c in cols:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    return df.select(*cols)


def adapt_detailed(raw: DataFrame, target_brand: Column | str, target_client: Column | str) -> DataFrame:
    """The 21-header layout + dynamic bonus-total/segment headers."""
    ren = {k: v for k, v in DETAILED_HEADERS.items() if k in raw.columns}
    # files of several layouts may name the column differently; each row has one of them
    bonus_cols = [F.col(f"`{c}`") for c in raw.columns if DETAILED_BONUS_TOTAL_MATCH in c]
    seg_col = "Segment" if "Segment" in raw.columns else next((c for c in raw.columns if "segment" in c.lower()), None)
    sel = [F.col(f"`{k}`").alias(v) for k, v in ren.items() if v != "wb_tag"]
    if seg_col:
        sel.append(F.col(f"`{seg_col}`").alias("wb_tag"))
    sel.append((F.coalesce(*bonus_cols) if bonus_cols else F.lit(None)).alias("bonus_total"))
    sel += [F.col("_file"), F.col("report_month")] if "report_month" in raw.columns else [F.col("_file")]
    sel += [F.col(c) for c in ("_tb", "_tc") if c in raw.columns]  # per-file targets (directory loads)
    x = raw.select(*sel)
    tb = F.lit(target_brand) if isinstance(target_brand, str) else target_brand
    tc = F.lit(target_client) if isinstance(target_client, str) else target_client
    x = x.withColumn("id", F.trim("id")).where(F.col("id").isNotNull() & (F.col("id") != "") & (F.col("id") != "nan"))
    for c in MONEY_COLS:
        x = x.withColumn(c, num(c) if c in x.columns else F.lit(0).cast(MONEY))
    if "brand" not in x.columns:
        x = x.withColumn("brand", F.lit(None).cast("string"))
    count = F.col("deposit_count").try_cast("double").cast("bigint") if "deposit_count" in x.columns else F.lit(None).cast("bigint")
    x = x.withColumn("deposit_count", F.coalesce(count, F.lit(0)))
    x = x.withColumn("segment", F.coalesce(F.col("wb_tag"), F.lit("Unknown")) if seg_col else F.lit("Unknown"))
    x = x.withColumn("brand", F.when(F.trim(F.coalesce("brand", F.lit(""))) == "", tb).otherwise(F.col("brand")))
    x = x.withColumn("client", tc)
    for c in ("reactivation_date", "campaign_start_date"):
        if c not in x.columns:
            x = x.withColumn(c, F.lit(None).cast("string"))
    return _finish(reactivation_delay(x))


def reactivation_delay(df: DataFrame) -> DataFrame:
    """``dd/MM/yyyy`` dates; bad dates → null; days between them."""
    r = F.try_to_date(F.col("reactivation_date").cast("string"), "dd/MM/yyyy")
    s = F.try_to_date(F.col("campaign_start_date").cast("string"), "dd/MM/yyyy")
    return (df.withColumn("reactivation_date", r).withColumn("campaign_start_date", s)
            .withColumn("reactivation_days", F.datediff("reactivation_date", "campaign_start_date")))


def _literal(x: Column | str) -> Column:
    return F.lit(x) if isinstance(x, str) else x


def _carried(raw: DataFrame) -> list[str]:
    """The month and the per-file targets (directory loads), where a frame has them."""
    return [c for c in ("report_month", "_tb", "_tc") if c in raw.columns]


def adapt_basic(raw: DataFrame, target_brand: Column | str, target_client: Column | str) -> DataFrame | None:
    """Six required headers (else the file is rejected); NGR := revenue,
    country := Global, verticals/deposits/bonus = 0, dates null."""
    if any(h not in raw.columns for h in BASIC_HEADERS):
        return None
    # the file's own brand column is not used
    x = raw.select(*[F.col(f"`{k}`").alias(v) for k, v in BASIC_HEADERS.items() if v != "brand"], "_file", *_carried(raw))
    x = x.where(F.col("id").isNotNull())
    for c in ("bet", "revenue"):
        x = x.withColumn(c, num(c))
    x = (x.withColumn("segment", F.col("wb_tag")).withColumn("client", _literal(target_client))
         .withColumn("brand", _literal(target_brand)).withColumn("ngr", F.col("revenue"))
         .withColumn("country", F.lit("Global")).withColumn("deposit_count", F.lit(0).cast("bigint")))
    for c in MONEY_COLS:
        if c not in x.columns:
            x = x.withColumn(c, F.lit(0).cast(MONEY))
    x = (x.withColumn("reactivation_date", F.lit(None).cast("date"))
         .withColumn("campaign_start_date", F.lit(None).cast("date"))
         .withColumn("reactivation_days", F.lit(None).cast("int")))
    return _finish(x)


def adapt_sheet_cohort(raw: DataFrame, target_brand: Column | str, target_client: Column | str) -> DataFrame | None:
    """T4: one row set per sheet (``sheet_name`` column): segment = text before
    the first ``-``, wb_tag = the sheet name, country from the ROC/ONT prefix;
    revenue/NGR/deposits columns located by substring; bet = 0."""
    if SHEET_ID_HEADER not in raw.columns:
        return None

    def find(match, exclude=None):
        hit = None
        for c in raw.columns:
            if match in c and (exclude is None or exclude not in c):
                hit = c
        return hit

    ggr, ngr, dep = find(SHEET_GGR_MATCH), find(SHEET_NGR_MATCH), find(SHEET_DEPOSITS_MATCH, "#")
    sheet = F.coalesce(F.col("sheet_name"), F.lit("UNKNOWN")) if "sheet_name" in raw.columns else F.lit("UNKNOWN")
    x = raw.select(F.col(f"`{SHEET_ID_HEADER}`").alias("id"), sheet.alias("_sheet"), "_file", *_carried(raw),
                   *[(F.col(f"`{c}`") if c else F.lit(None)).alias(a) for c, a in ((ggr, "revenue"), (ngr, "ngr"), (dep, "deposits"))])
    x = x.where(F.col("id").isNotNull())
    for c in ("revenue", "ngr", "deposits"):
        x = x.withColumn(c, num(c))
    for c in MONEY_COLS:
        if c not in x.columns:
            x = x.withColumn(c, F.lit(0).cast(MONEY))
    x = (x.withColumn("client", _literal(target_client)).withColumn("brand", _literal(target_brand))
         .withColumn("country", F.when(F.col("_sheet").startswith("ROC"), "CA-ROC")
                     .when(F.col("_sheet").startswith("ONT"), "CA-ONT").otherwise("Global"))
         .withColumn("segment", F.when(F.col("_sheet").contains("-"), F.trim(F.split("_sheet", "-").getItem(0)))
                     .otherwise(F.col("_sheet")))
         .withColumn("wb_tag", F.col("_sheet")).withColumn("deposit_count", F.lit(0).cast("bigint"))
         .withColumn("reactivation_date", F.lit(None).cast("date"))
         .withColumn("campaign_start_date", F.lit(None).cast("date"))
         .withColumn("reactivation_days", F.lit(None).cast("int")))
    return _finish(x)


ADAPTERS = {"detailed": adapt_detailed, "basic": adapt_basic, "sheet_cohort": adapt_sheet_cohort}


def resolve_client(mapping: DataFrame, key: Column) -> tuple[DataFrame, Column, Column]:
    """Lookup on lower(trim(code or name)); the registry is a bounded
    dimension, so the lookup table (codes ∪ names) is broadcast."""
    lk = (mapping.select(F.lower(F.trim("brand_code")).alias("_k"), "client_name", "brand_name", "financial_format")
          .unionByName(mapping.select(F.lower(F.trim("brand_name")).alias("_k"), "client_name", "brand_name",
                                      "financial_format"))
          .dropDuplicates(["_k"]))
    return F.broadcast(lk), F.lower(F.trim(key)), F.col("client_name")


def load_financial_files(spark: SparkSession, files: list[str], mapping: DataFrame, fmt: str,
                         brand_key: str, report_month: str | None = None) -> DataFrame | None:
    """S1 for one brand folder: read its files in one job, tag the month from
    the file name (S8) unless given, and apply the brand's format adapter.
    Unknown formats are rejected (T5: returns None)."""
    adapter = ADAPTERS.get(fmt)
    if adapter is None:
        return None
    raw = read_csv_any_encoding(spark, files)
    _, month = brand_month_from_filename(F.col("_file"))
    raw = raw.withColumn("report_month", F.lit(report_month) if report_month else month)
    row = mapping.where(F.lower(F.trim("brand_code")) == brand_key.lower().strip()).select(
        "client_name", "brand_name").limit(1).collect()  # one registry row
    client = row[0].client_name if row else "UNKNOWN"
    brand = row[0].brand_name if row else brand_key.strip().title()
    return adapter(raw, brand, client)


def load_financial_directory(spark: SparkSession, files: list[str], mapping: DataFrame,
                             fmt: str = "detailed") -> DataFrame | None:
    """S1 for many brand folders of one format in a single read: each file's
    brand key and month come from its name (S8); client and target brand are
    resolved per file by a broadcast join to the registry (T7), so no
    per-brand driver loop or lookup is needed."""
    adapter = ADAPTERS.get(fmt)
    if adapter is None:
        return None
    raw = read_csv_any_encoding(spark, files)
    key, month = brand_month_from_filename(F.col("_file"))
    raw = raw.withColumn("report_month", month).withColumn("_key", F.lower(F.trim(key)))
    lk, _, _ = resolve_client(mapping, F.col("_key"))
    raw = raw.join(lk.select(F.col("_k").alias("_key"), F.col("client_name").alias("_client"),
                             F.col("brand_name").alias("_brand")), "_key", "left")
    raw = (raw.withColumn("_tb", F.coalesce(F.col("_brand"), F.initcap(F.col("_key"))))
           .withColumn("_tc", F.coalesce(F.col("_client"), F.lit("UNKNOWN"))))
    return adapter(raw, F.col("_tb"), F.col("_tc"))


# ---------------------------------------------------------------------------
# S2 duplicate policy, S3 campaign files, S4–S6 operations files
# ---------------------------------------------------------------------------

def apply_duplicate_policy(new: DataFrame, existing_keys: DataFrame, allow_overwrite: bool) -> DataFrame:
    """Without overwrite, rows of an already loaded (brand, month) are
    rejected (anti join); with overwrite they pass and the sink replaces those
    partitions (dynamic partition overwrite)."""
    if allow_overwrite:
        return new
    return new.join(existing_keys.select("brand", "report_month").distinct(), ["brand", "report_month"], "left_anti")


def load_campaign_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """S3: exact header match, then case-insensitive; counters int-coerced
    (bad → 0); brand title-cased; month from the file name."""
    raw = read_csv_any_encoding(spark, paths)
    lower = {c.lower(): c for c in raw.columns}
    sel = []
    for h, v in CAMPAIGN_HEADERS.items():
        src = h if h in raw.columns else lower.get(h.lower())
        sel.append((F.col(f"`{src}`") if src else F.lit(None).cast("string")).alias(v))
    x = raw.select(*sel, "_file")
    for c in ["records", "kpi1_conversions", "kpi2_logins", "calls", "emails_sent", "sms_sent"]:
        x = x.withColumn(c, F.coalesce(F.trim(c).try_cast("double").cast("bigint"), F.lit(0)))
    _, month = brand_month_from_filename(F.col("_file"))
    return x.withColumn("brand", F.initcap(F.trim("brand"))).withColumn("report_month", month).drop("_file")


def load_ops_files(spark: SparkSession, paths: list[str], mapping: DataFrame) -> DataFrame:
    """Clean headers, default the 36 metrics to 0, date from the ``Date``
    column or the file name (S9), parse the campaign name (C1–C6), compute
    C13/C14 and resolve client/brand (J4).  Same output shape as ``ops_daily``."""
    raw = read_csv_any_encoding(spark, paths, strip_quotes=True)
    if "Campaign Name" not in raw.columns:
        return spark.createDataFrame([], "campaign_name string")
    x = raw
    for h in OPS_METRIC_HEADERS:
        x = x.withColumn(h, F.coalesce(F.trim(F.col(f"`{h}`")).try_cast("double"), F.lit(0.0))) if h in raw.columns \
            else x.withColumn(h, F.lit(0.0))
    fdate = date_from_filename(F.col("_file"))
    ops_date = F.coalesce(F.try_to_date(F.col("Date"), "yyyy-MM-dd"), fdate) if "Date" in raw.columns else fdate
    x = x.withColumn("ops_date", ops_date).where(F.col("ops_date").isNotNull())
    x = x.withColumn("campaign", F.coalesce(F.col("`Campaign Name`"), F.lit("UNKNOWN")).cast("string"))
    # Ruling Q6: '# Records' is the fallback only when 'New Data' is absent from the row's file.
    rec = F.when(F.array_contains("_header", "New Data"), F.col("`New Data`")).otherwise(F.col("`# Records`"))
    x = x.withColumn("records", rec.cast("bigint"))
    ints = [v for k, v in OPS_RENAMES.items() if not k.startswith("Cost") and k not in ("D Ratio", "LI%")]
    x = x.select("campaign", "ops_date", "records",
                 *[F.col(f"`{k}`").cast("bigint").alias(v) if v in ints else F.col(f"`{k}`").alias(v)
                   for k, v in OPS_RENAMES.items()])
    x = x.withColumn("t", F.col("tech_issues")).withColumn("d_total", F.col("d_neutral"))
    for c in ("cost_caller", "cost_sip", "cost_sms", "cost_email"):
        x = x.withColumn(c, F.col(c).cast(MONEY))
    parsed = C.parse_campaign(x, "campaign", "ops_date")
    parsed = parsed.join(F.broadcast(mapping.select(F.col("brand_code").alias("tag"), "brand_name", "client_name")),
                         "tag", "left")
    total = (F.col("cost_caller") + F.col("cost_sip") + F.col("cost_sms") + F.col("cost_email")).cast(MONEY)
    return parsed.select(
        F.concat(F.col("campaign"), F.lit("_"), F.date_format("ops_date", "yyyy-MM-dd")).alias("campaign_name"),
        F.coalesce("client_name", F.lit("UNKNOWN")).alias("ops_client"),
        F.coalesce("brand_name", "tag").alias("ops_brand"), "ops_date", "records", "calls", "conversions",
        "kpi2_logins", "d_total", "d_plus", "d_minus", "d_neutral", "tech_issues", "t", "am", "dnc", "na", "dx", "wn",
        "hlrv", "twoxrv", "sa", "sd", "sf", "sp", "ev", "es", "ed", "eo", "ec", "ef", "optouts_all", "optout_call",
        "optout_sms", "optout_email", total.alias("total_cost"),
        F.when(F.col("conversions") > 0, total.cast("double") / F.col("conversions")).otherwise(0.0).alias("true_cac"),
        "cost_caller", "cost_sip", "cost_sms", "cost_email", "d_ratio", "li_pct", "extracted_engagement",
        "extracted_lifecycle", "extracted_segment", "extracted_product", "extracted_language",
        "extracted_sublifecycle", "country", F.coalesce("campaign_data_age_days", F.lit(-1)).alias("campaign_data_age_days"),
        "tag")


def upsert_latest(new: DataFrame, old: DataFrame, key: list[str], version: str, hashed: list[str] | None = None) -> DataFrame:
    """Last write wins per key: the newest version, on equal versions the new row (of several
    new ones the one of the largest hash, over the columns ``hashed`` or all)."""
    u = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*key).orderBy(F.col(version).desc(), F.col("_new").desc(), F.xxhash64(*[F.col(f"`{c}`") for c in hashed or new.columns]).desc())
    return u.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_new")


def daily_layouts(spark: SparkSession, paths: list[str]) -> dict[str, list[tuple[str, int]]]:
    """Files by header, the second line of each, from one distributed read: (path, number of that
    line in the read).  A file's first block is read by one task in order, so its lines carry
    consecutive numbers there.  One row per file reaches the driver."""
    lines = _numbered(spark, paths).where(F.col("block") == 0)
    first = lines.groupBy(F.col("path").alias("of")).agg(F.min("line").alias("title"))
    second = lines.join(first, (F.col("path") == F.col("of")) & (F.col("line") == F.col("title") + 1)).select("path", "value")
    out: dict[str, list[str]] = {}
    for r in sorted(second.collect()):
        out.setdefault(r.value, []).append(unquote(r.path))
    return out


def _numbered(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"),
                                         F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))


def merge_daily_sources(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Per-source exports of one day merged by column name.  Each export has a title line and
    the real header on the 2nd line; files of equal headers are parsed together with ``from_csv``,
    so the plan has a scan per layout, not per file.  Rows that are entirely null are dropped;
    files without a header line give no rows (S11), and if all are such there is no column."""
    frames = []
    for header, files in daily_layouts(spark, paths).items():
        names = [clean_header(h) for h in next(csv.reader([header]))]
        ddl = ", ".join(f"`{n}` STRING" for n in names)
        lines = _numbered(spark, files)
        # the first two lines of each file, wherever else their text occurs
        first = lines.where(F.col("block") == 0).groupBy(F.col("path").alias("of")).agg(F.min("line").alias("title"))
        body = lines.join(first, F.col("path") == F.col("of")).where((F.col("block") > 0) | (F.col("line") > F.col("title") + 1))
        frames.append(body.select(F.from_csv("value", ddl).alias("r")).select("r.*"))
    if not frames:
        return spark.createDataFrame([], "")
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return merged.na.drop("all")


def scan(spark: SparkSession, path: str, columns: list[str], where: Column | None = None) -> DataFrame:
    """Projected, filtered table scan (pushed into parquet)."""
    df = spark.read.parquet(path).select(*columns)
    return df.where(where) if where is not None else df


# ---------------------------------------------------------------------------
# Exports in the raw layouts (used to exercise the readers on whole tables)
# ---------------------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


#: Files that one key's rows are dealt to, so that a hot key is not one task.
EXPORT_SPLITS = 2


def export_named_csv(df: DataFrame, root: str, key_cols: list[str], name_fn, splits: int = EXPORT_SPLITS) -> list[str]:
    """Write CSV files (with header) per distinct ``key_cols`` value, named
    ``name_fn(*key values)``, the naming the exports arrive with, in up to ``splits``
    numbered folders.  Only file names pass through the driver (one listing of the output)."""
    spark = df.sparkSession
    stage = root.rstrip("/") + "/_stage"
    salted = df.withColumn("_split", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(splits)))
    (salted.repartition(*key_cols, "_split").write.partitionBy(*key_cols, "_split").option("header", True)
     .option("encoding", "UTF-8").csv(stage))
    fs, base = _fs(spark, stage)
    it = fs.listFiles(base, True)
    out = []
    while it.hasNext():
        st = it.next()
        path = st.getPath()
        if not path.getName().endswith(".csv"):
            continue
        parts = {k: unquote(v) for k, v in (kv.split("=", 1) for kv in str(path.getParent().toUri().getPath()).split("/") if "=" in kv)}
        target = f"{root.rstrip('/')}/{parts['_split']}/{name_fn(*[parts[k] for k in key_cols])}"
        _, tp = _fs(spark, target)
        fs.mkdirs(tp.getParent())
        if not fs.rename(path, tp):
            raise OSError(f"cannot rename {path} to {target}")
        out.append(target)
    return sorted(out)


def export_detailed(pa: DataFrame, root: str) -> dict[str, list[str]]:
    """PlayerRecord rows → detailed-format files ``<brand>/<brand>_yyyy_mm.csv``, by brand."""
    inv = {v: k for k, v in DETAILED_HEADERS.items()}
    # numbers are dealt as numbers; the CSV writer makes the texts where the files are written
    cols = [F.col(v).alias(inv[v]) for v in DETAILED_HEADERS.values()
            if v not in ("reactivation_date", "campaign_start_date") and v in pa.columns]
    cols.append(F.col("bonus_total").alias("Bonus Cost (Total)  €"))
    key = F.lower(F.regexp_replace("brand", "[^A-Za-z]", ""))
    x = pa.select(*cols, key.alias("_bk"), F.col("report_month").alias("_m"))
    files = export_named_csv(x, root, ["_bk", "_m"], lambda b, m: f"{b}/{b}_{m.replace('-', '_')}.csv")
    by_brand: dict[str, list[str]] = {}
    for f in files:
        by_brand.setdefault(f.rsplit("/", 2)[-2], []).append(f)
    return by_brand


def export_ops(ops: DataFrame, root: str) -> list[str]:
    """Operations rows → monthly files ``ops_yyyy_mm.csv`` in the raw daily
    layout with a ``Date`` column."""
    inv = {v: k for k, v in OPS_RENAMES.items()}
    raw = F.regexp_replace(F.col("campaign_name"), r"_\d{4}-\d{2}-\d{2}$", "")
    cols = [raw.alias("Campaign Name"), F.date_format("ops_date", "yyyy-MM-dd").alias("Date"),
            F.col("records").alias("New Data")]
    cols += [F.col(v).alias(k) for v, k in inv.items() if v in ops.columns]
    x = ops.select(*cols, F.date_format("ops_date", "yyyy_MM").alias("_m"))
    return export_named_csv(x, root, ["_m"], lambda m: f"ops_{m}.csv")


def export_campaign_monthly(cm: DataFrame, root: str) -> list[str]:
    """CampaignRecord rows → monthly campaign files ``yyyy-mm <brand>.csv`` in the raw
    campaign layout; every brand has a file of its own (``escape_brand``)."""
    inv = {v: k for k, v in CAMPAIGN_HEADERS.items()}
    x = cm.select(*[F.col(v).cast("string").alias(inv[v]) for v in CAMPAIGN_HEADERS.values()],
                  escape_brand(F.col("brand")).alias("_bk"), F.col("report_month").alias("_m"))
    return export_named_csv(x, root, ["_bk", "_m"], lambda b, m: f"{m} {b}.csv", splits=1)  # monthly totals: few rows a key
