"""One directory of financial exports in several layouts, and what is rejected.

Every file is resolved once: its brand key and month come from its name (S8), its client,
brand and format from the registry (T7).  This table has one row per file; it is joined to
the lines by a size-checked broadcast and decides which adapter reads which files.  Each file
is read once per output, under its own header and encoding; all layouts are one plan.

A line is either good or rejected with one reason, so good + rejected = lines.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files as FL

#: The column that names a player, by format, and the columns without which a file is rejected.
ID_HEADER = {"detailed": "Player Key", "basic": "Player unique identifier", "sheet_cohort": FL.SHEET_ID_HEADER}
REQUIRED = {"detailed": ["Player Key"], "basic": list(FL.BASIC_HEADERS), "sheet_cohort": [FL.SHEET_ID_HEADER]}
# Reasons, in the order in which they are tested.
BAD_NAME, UNKNOWN_FORMAT, MISSING_HEADERS = "file name", "unknown format", "missing headers"
MALFORMED, NO_PLAYER = "malformed line", "no player id"
REJECTED_COLUMNS = ["file", "brand_key", "report_month", "format", "reason", "line"]


def resolve_files(spark: SparkSession, paths: list[str], mapping: DataFrame) -> list[dict]:
    """One entry per non-empty file: path, header, encoding, key, month, format, brand, client, reason
    (why the whole file is rejected, else None)."""
    listed = [(path, header, encoding) for (header, encoding), found in FL.file_layouts(spark, paths).items() for path in found]
    if not listed:
        return []
    table = spark.createDataFrame(listed, "path string, header string, encoding string")
    key, month = FL.brand_month_from_filename(F.element_at(F.split("path", "/"), -1))
    table = table.withColumn("key", F.lower(F.trim(key))).withColumn("month", month)
    lookup, _, _ = FL.resolve_client(mapping, F.col("key"))
    joined = table.join(lookup, F.col("key") == F.col("_k"), "left")
    out = []
    for r in joined.collect():
        fmt = r.financial_format if r.financial_format in FL.ADAPTERS else None
        names = {FL.clean_header(c) for c in next(FL.csv.reader([r.header]))}
        reason = (BAD_NAME if r.month is None or r.key is None else UNKNOWN_FORMAT if fmt is None
                  else MISSING_HEADERS if not names.issuperset(REQUIRED[fmt]) else None)
        out.append({"path": r.path, "header": r.header, "encoding": r.encoding, "key": r.key, "month": r.month,
                    "format": r.financial_format, "brand": r.brand_name or (r.key or "").title(),
                    "client": r.client_name or "UNKNOWN", "reason": reason})
    return sorted(out, key=lambda f: f["path"])


def _lines(spark: SparkSession, entries: list[dict], corrupt: bool) -> DataFrame:
    """The lines of the files with their file's entry; ``corrupt``: malformed ones keep their text."""
    layouts: dict[tuple[str, str], list[str]] = {}
    for f in entries:
        layouts.setdefault((f["header"], f["encoding"]), []).append(f["path"])
    raw = FL.read_layouts(spark, layouts, corrupt=corrupt)
    named = spark.createDataFrame([(f["path"], f["key"], f["month"], f["format"], f["brand"], f["client"], f["reason"]) for f in entries],
                                  "_of string, _key string, report_month string, _format string, _tb string, _tc string, _file_reason string")
    return raw.withColumn("_plain", FL.unquoted(F.col("_path"))).join(named, F.col("_plain") == F.col("_of"), "left").drop("_of", "_plain")


def _line_reason(fmt: str) -> Column:
    """Why a line of an accepted file is rejected, null for good ones."""
    id_ = F.trim(F.col(f"`{ID_HEADER[fmt]}`"))
    return F.when(F.col(FL.CORRUPT).isNotNull(), F.lit(MALFORMED)).when(id_.isNull() | id_.isin("", "nan"), F.lit(NO_PLAYER))


def route_financial_files(spark: SparkSession, paths: list[str], mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejected) of a directory in which every brand exports in the registry's format for it.

    ``good`` has the canonical columns and ``format``; ``rejected`` the lines of files whose name
    gives no brand and month, whose format has no adapter (T5) or whose required headers are
    missing, and, in other files, lines of a wrong number of cells and lines without a player.
    Its ``line`` is the text of a malformed line, else the cells as JSON.  Empty files have neither.
    """
    entries = resolve_files(spark, paths, mapping)
    good, bad = [], []
    for fmt, whole in sorted({(f["format"] or "", f["reason"] is None) for f in entries}):
        mine = [f for f in entries if ((f["format"] or ""), f["reason"] is None) == (fmt, whole)]
        raw = _lines(spark, mine, corrupt=whole)
        reason = _line_reason(fmt) if whole else F.col("_file_reason")
        text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns if not c.startswith("_") and c != "report_month"]))
        bad.append(raw.withColumn("_reason", reason).where(F.col("_reason").isNotNull()).select(
            F.col("_file").alias("file"), F.col("_key").alias("brand_key"), "report_month", F.col("_format").alias("format"),
            F.col("_reason").alias("reason"), (F.coalesce(F.col(FL.CORRUPT), text) if whole else text).alias("line")))
        if whole:
            good.append(FL.ADAPTERS[fmt](raw.where(reason.isNull()).drop(FL.CORRUPT), F.col("_tb"), F.col("_tc")).withColumn("format", F.lit(fmt)))

    def union(frames: list[DataFrame], schema: str) -> DataFrame:
        return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], schema)

    empty = ", ".join(f"{c} {'decimal(18,2)' if c in FL.MONEY_COLS else 'string'}" for c in ["id", "client", "brand", "report_month", "format", *FL.MONEY_COLS])
    return union(good, empty), union(bad, ", ".join(f"{c} string" for c in REJECTED_COLUMNS))


def load_with_quarantine(spark: SparkSession, paths: list[str], mapping: DataFrame, good_path: str, rejected_path: str) -> None:
    """S11 sink: good rows by month, and beside them the rejected lines by reason.  A load replaces
    the months and reasons that it holds."""
    good, rejected = route_financial_files(spark, paths, mapping)
    for frame, path, part in ((good, good_path, "report_month"), (rejected, rejected_path, "reason")):
        (frame.hint("rebalance", part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path))


# ---------------------------------------------------------------------------
# Exports in each brand's own layout (used to exercise the routing on whole tables)
# ---------------------------------------------------------------------------

def _cells(fmt: str) -> dict[str, Column]:
    """Header → cell of a canonical row in a format."""
    def text(c: str) -> Column:
        return F.col(c).cast("string")
    if fmt == "basic":
        return {"Player unique identifier": F.col("id"), "Brand": F.col("brand"), "WB tag/flag": F.col("wb_tag"), "Bet": text("bet"),
                "Win": (F.col("bet") - F.col("revenue")).cast("string"), "Revenue": text("revenue")}
    if fmt == "sheet_cohort":
        return {FL.SHEET_ID_HEADER: F.col("id"), "sheet_name": F.concat_ws("-", F.col("wb_tag"), F.col("report_month")),
                f"{FL.SHEET_GGR_MATCH} €": text("revenue"), f"{FL.SHEET_NGR_MATCH} €": text("ngr"),
                f"{FL.SHEET_DEPOSITS_MATCH} €": text("deposits"), f"{FL.SHEET_DEPOSITS_MATCH} #": text("deposit_count")}
    skip = ("reactivation_date", "campaign_start_date")
    return {h: text(c) for h, c in FL.DETAILED_HEADERS.items() if c not in skip} | {FL.DETAILED_BONUS_TOTAL_MATCH: text("bonus_total")}


def export_by_format(pa: DataFrame, mapping: DataFrame, root: str, damage: bool = False) -> list[str]:
    """PlayerRecord rows → ``yyyy-mm <brand>.csv`` files, each brand in its registry format (formats
    without an adapter are written in the detailed layout).  ``damage`` spoils some lines: a blank
    player for ids divisible by 11, and a cell too many for other ids divisible by 7."""
    out = []
    formats = mapping.select("brand_name", F.coalesce("financial_format", F.lit("")).alias("_format"))
    number = F.col("id").try_cast("bigint")
    for fmt in ("detailed", "basic", "sheet_cohort", None):
        mine = F.col("_format") == fmt if fmt else ~F.col("_format").isin(*FL.ADAPTERS)
        x = pa.join(formats.where(mine), pa.brand == F.col("brand_name")).drop("brand_name", "_format")
        cells = _cells(fmt or "detailed")
        if damage:
            x = x.withColumn("id", F.when(number % 11 == 0, F.lit(" ")).otherwise(F.col("id"))).withColumn("_more", (number % 7 == 0) & (number % 11 != 0))
        keys = [FL.escape_brand(F.col("brand")).alias("_bk"), F.col("report_month").alias("_m")]
        if not damage:
            out += FL.export_named_csv(x.select(*[c.alias(h) for h, c in cells.items()], *keys), f"{root}/{fmt or 'other'}",
                                       ["_bk", "_m"], lambda b, m: f"{m} {b}.csv")
            continue
        # lines of their own, since a CSV writer gives every line the same number of cells
        line = F.concat(F.to_csv(F.struct(*[c.alias(h) for h, c in cells.items()])), F.when(F.col("_more"), F.lit(",spoilt")).otherwise(""))
        out += _export_lines(x.select(line.alias("value"), *keys), f"{root}/{fmt or 'other'}", list(cells))
    return out


def _export_lines(df: DataFrame, root: str, header: list[str]) -> list[str]:
    """Lines of text → ``yyyy-mm <brand>.csv`` files below numbered folders, with the header as first line."""
    spark = df.sparkSession
    body = df.withColumn("_split", F.pmod(F.xxhash64("value"), F.lit(FL.EXPORT_SPLITS))).withColumn("_at", F.lit(1))
    first = body.select(F.lit(",".join(header)).alias("value"), "_bk", "_m", "_split", F.lit(0).alias("_at")).distinct()
    lines = body.unionByName(first)
    (lines.repartition("_bk", "_m", "_split").sortWithinPartitions("_bk", "_m", "_split", "_at").drop("_at")
     .write.partitionBy("_bk", "_m", "_split").text(f"{root}/_stage"))
    fs, base = FL._fs(spark, f"{root}/_stage")
    it, out = fs.listFiles(base, True), []
    while it.hasNext():
        path = it.next().getPath()
        if path.getName().endswith(".txt"):
            parts = {k: unquote(v) for k, v in (kv.split("=", 1) for kv in str(path.getParent().toUri().getPath()).split("/") if "=" in kv)}
            target = f"{root}/{parts['_split']}/{parts['_m']} {parts['_bk']}.csv"
            _, to = FL._fs(spark, target)
            fs.mkdirs(to.getParent())
            if not fs.rename(path, to):
                raise OSError(f"cannot rename {path} to {target}")
            out.append(target)
    return sorted(out)
