"""Sinks (W1–W9): partitioned parquet tables, reports and extracts.

Without a transactional table format, replacement is done with dynamic
partition overwrite (only the partitions present in the new data are
rewritten), and merges write a new version directory and then switch the
``_CURRENT`` pointer, so no plan ever reads and overwrites the same path.
"""

from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

from .sources import testdata as TD
from .sources.files import upsert_latest

FACT_PARTITIONS = {
    "player_activity": ["report_month"],
    "player_lines": ["report_month"],
    "ops_daily": ["ops_month"],
    "ops_snapshots": ["ops_month"],
}
# Secondary range key: splits a heavy partition value across several writer
# tasks while keeping each task's output to a few contiguous partitions.
FACT_SPLIT_KEYS = {
    "player_activity": ["id"],
    "player_lines": ["id"],
    "ops_daily": ["campaign_name"],
    "ops_snapshots": ["campaign_name"],
}


def append(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Append to a partitioned fact table or point-in-time log."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def clustered_for_write(df: DataFrame, partition_by: list[str], split_by: list[str],
                        files_per_partition: int = 4) -> DataFrame:
    """Hash-cluster rows on (partition columns, bucket of the split key) before a
    partitioned write: ``files_per_partition`` files per partition value, and a
    heavy partition value is still written by that many tasks in parallel.
    (Hash, not range, so the input is not evaluated twice for sampling.)"""
    bucket = F.pmod(F.xxhash64(*split_by), F.lit(files_per_partition))
    return df.repartition(*[F.col(c) for c in partition_by], bucket)


def replace(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a whole (materialized) table."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """W4 / W4b / S2-replace: delete-then-append for exactly the key ranges in
    ``df`` (dynamic partition overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def _fs(spark: SparkSession, path: str):
    """The Hadoop FileSystem serving ``path`` (local, HDFS, object stores)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def remove_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def current_version(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path.rstrip("/") + "/_CURRENT")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        name = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()
    return path.rstrip("/") + "/" + name


def write_version(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Write a new immutable version, then switch the ``_CURRENT`` pointer with
    a file-system rename (H6: never read and overwrite the same directory)."""
    spark = df.sparkSession
    name = f"v{int(time.time() * 1000)}"
    target = path.rstrip("/") + "/" + name
    replace(df, target, partition_by)
    fs, tmp = _fs(spark, path.rstrip("/") + f"/_CURRENT.{name}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(name.encode("utf-8")))
    out.close()
    _, ptr = _fs(spark, path.rstrip("/") + "/_CURRENT")
    _rename_over(spark, tmp, ptr)
    return target


def _rename_over(spark: SparkSession, source, target) -> None:
    """Put ``source`` in the place of ``target`` in one step (an error leaves the old one)."""
    sc = spark.sparkContext
    overwrite = getattr(sc._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = sc._gateway.new_array(overwrite, 1)
    options[0] = overwrite.OVERWRITE
    fs = target.getFileSystem(sc._jsc.hadoopConfiguration())
    files = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
    files.rename(fs.makeQualified(source), fs.makeQualified(target), options)


def upsert(spark: SparkSession, new: DataFrame, path: str, key: list[str], version: str,
           partition_by: list[str] | None = None) -> str:
    """W5 / S5 of small tables (dimensions): upsert by key, last write wins, written whole as a new
    version; a first load is merged with itself.  ``tables.upsert`` rewrites touched parts alone."""
    cur = current_version(spark, path)
    merged = upsert_latest(new, spark.read.parquet(cur) if cur else new.limit(0), key, version)
    return write_version(merged, path, partition_by)


def write_report(df: DataFrame, root: str, name: str, partition_by: list[str] | None = None) -> str:
    """Report store — one parquet directory per report name."""
    target = os.path.join(root, name)
    replace(df, target, partition_by)
    return target


def write_csv_extract(df: DataFrame, path: str, bounded: bool = False) -> None:
    """CSV with header; a single file only for bounded lists (top-k etc.)."""
    out = df.coalesce(1) if bounded else df
    out.write.mode("overwrite").option("header", True).csv(path)


def display_round(df: DataFrame, digits: int = 2, pct_cols: list[str] | None = None) -> DataFrame:
    """Display transform for reports: round floating columns; percentages /100
    (``pct_cols``) for spreadsheet percent formatting."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if pct_cols and f.name in pct_cols:
            c = F.round(c / 100.0, digits + 2)
        elif isinstance(f.dataType, (DoubleType, DecimalType)):
            c = F.round(c, digits)
        cols.append(c.alias(f.name))
    return df.select(*cols)


# The report columns shown as spreadsheet percentages (0–1).
PERCENT_COLS = ["profitable_pct", "hold_pct", "top_10_pct_ggr_share", "retention_pct"]


def write_multitab_report(tabs: dict[str, DataFrame], root: str) -> dict[str, str]:
    """One output table per tab (brand tabs partitioned by brand), months
    shown as ``August 2025``, percentages as fractions."""
    from .functions.core import pretty_month
    out = {}
    for name, df in tabs.items():
        d = df
        if "month" in d.columns:
            d = d.withColumn("month_label", pretty_month("month"))
        part = ["brand"] if "brand" in d.columns else None
        out[name] = write_report(display_round(d, pct_cols=PERCENT_COLS), root, name, part)
    return out


def registry_table(pa: DataFrame, file_col: str | None = None) -> DataFrame:
    """Ingestion registry (brand, report_month, status, file_path, ingested_at)."""
    g = pa.groupBy("brand", "report_month").agg(
        (F.max(file_col) if file_col else F.lit(None).cast("string")).alias("file_path"))
    return g.select("brand", "report_month", F.lit("IMPORTED").alias("status"), "file_path",
                    F.current_timestamp().alias("ingested_at"))


def materialize_facts(spark: SparkSession, sf_dir: str, out_dir: str) -> dict[str, DataFrame]:
    """Run the adapters once and persist the canonical facts as partitioned
    parquet (the reference ETL's materialization); return them read back."""
    out: dict[str, DataFrame] = {}

    def persist(name: str, df: DataFrame) -> DataFrame:
        path = os.path.join(out_dir, name)
        replace(clustered_for_write(df, FACT_PARTITIONS[name], FACT_SPLIT_KEYS[name]), path, FACT_PARTITIONS[name])
        back = spark.read.schema(df.schema).parquet(path)  # explicit types, no partition inference
        out[name] = back.drop(*[c for c in ("ops_month",) if c in back.columns])
        return out[name]

    # Line grain first; the monthly fact and the snapshot log are derived from
    # the written tables, so the adapter joins run once per fact family.
    lines = persist("player_lines", TD.player_lines(spark, sf_dir))
    persist("player_activity", TD.aggregate_player_activity(lines))
    ops = persist("ops_daily", TD.ops_daily(spark, sf_dir).withColumn("ops_month", F.date_format("ops_date", "yyyy-MM")))
    persist("ops_snapshots", TD.snapshots_of(ops).withColumn("ops_month", F.date_format("ops_date", "yyyy-MM")))
    return out
