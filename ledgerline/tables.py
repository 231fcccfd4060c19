"""Tables whose parts are replaced by commit.

A root folder holds several tables.  Each consists of parts (hash buckets of a key, or one
for each client); a part is a folder of Parquet files that is written once and never
changed.  Numbered manifests name the current folder of every part of every table; the
highest number counts.  A commit writes new folders first and then puts the next manifest
in place with one rename, so readers see all of it or nothing, whatever number of tables it
touches, and parts that it does not touch keep their very files.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import _fs
from .sources.files import upsert_latest

Parts = dict[str, str]

#: Hash buckets of a keyed table.
BUCKETS = 32
#: Shares of a bucket that are merged and written by tasks of their own.
SPLITS = 16
_NONE = "__none__"


def _manifest_folder(root: str) -> str:
    return f"{root.rstrip('/')}/_manifests"


def manifest(spark: SparkSession, root: str) -> tuple[int, dict[str, Parts]]:
    """(number, {table: {part: folder}}) of the last commit; (0, {}) before the first one."""
    fs, folder = _fs(spark, _manifest_folder(root))
    if not fs.exists(folder):
        return 0, {}
    numbers = [int(s.getPath().getName()[:-5]) for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json")]
    if not numbers:
        return 0, {}
    stream = fs.open(_fs(spark, f"{_manifest_folder(root)}/{max(numbers):012d}.json")[1])
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return max(numbers), json.loads(text)


def commit(spark: SparkSession, root: str, number: int, changes: dict[str, dict[str, str | None]]) -> int:
    """Make the next manifest after ``number``: parts get new folders, or go (None).  If another
    commit came first, nothing changes and an error is raised."""
    now, tables = manifest(spark, root)
    if now != number:
        raise RuntimeError(f"manifest {number} was replaced by {now}: read again and retry")
    for table, parts in changes.items():
        kept = {**tables.get(table, {}), **parts}
        tables[table] = {p: folder for p, folder in sorted(kept.items()) if folder is not None}
    fs, draft = _fs(spark, f"{_manifest_folder(root)}/.{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(tables).encode()))
    out.close()
    _, target = _fs(spark, f"{_manifest_folder(root)}/{number + 1:012d}.json")
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise RuntimeError(f"manifest {number + 1} exists already: read again and retry")
    return number + 1


def write_parts(df: DataFrame, root: str, table: str, part: Column) -> Parts:
    """Write ``df`` to new folders by ``part`` (a string; null is a part of its own), without
    committing; a large part is written by several tasks.  The listing of parts reaches the driver."""
    return _write_by_part(df.withColumn("_part", F.coalesce(part.cast("string"), F.lit(_NONE))).hint("rebalance", "_part"), root, table)


def _write_by_part(df: DataFrame, root: str, table: str) -> Parts:
    spark = df.sparkSession
    folder = f"{root.rstrip('/')}/{table}/{uuid.uuid4().hex}"
    df.write.partitionBy("_part").parquet(folder)
    fs, base = _fs(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(base) if s.isDirectory()]
    return {unquote(n.split("=", 1)[1]): f"{folder}/{n}" for n in names if n.startswith("_part=")}


def read_parts(spark: SparkSession, parts: Parts) -> DataFrame:
    return spark.read.parquet(*[parts[p] for p in sorted(parts)])


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The table as of the last commit."""
    return read_parts(spark, manifest(spark, root)[1][table])


def _part_names(df: DataFrame, part: Column) -> list[str]:
    """The parts that rows of ``df`` fall in: as many rows as the table has parts reach the driver."""
    return sorted(r[0] for r in df.select(F.coalesce(part.cast("string"), F.lit(_NONE)).alias("p")).distinct().collect())


def bucket(key: list[str], buckets: int = BUCKETS) -> Column:
    """The part of a row in a keyed table: its key alone decides, so an upsert knows the parts it touches."""
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("string")


def upsert(spark: SparkSession, new: DataFrame, root: str, table: str, key: list[str], version: str, buckets: int = BUCKETS) -> list[str]:
    """Per key the newest version stays, of equal versions the new row; returns the parts
    that were rewritten.  Only the parts that the new keys fall in are read; the rows of a first
    load are merged with each other in the same way."""
    number, tables = manifest(spark, root)
    part = bucket(key, buckets)
    touched = _part_names(new, part)
    if not touched:
        return []
    current = {p: folder for p, folder in tables.get(table, {}).items() if p in touched}
    old = read_parts(spark, current) if current else new.limit(0)
    # one shuffle for both the merge and the write: rows are dealt by part and, within it, by key
    dealt = [part.alias("_part"), F.pmod(F.xxhash64(F.lit(1), *key), F.lit(SPLITS)).alias("_split")]
    merged = upsert_latest(new.select("*", *dealt), old.select("*", *dealt), ["_part", "_split", *key], version, new.columns)
    changes = _write_by_part(merged.drop("_split"), root, table)
    commit(spark, root, number, {table: changes})
    return touched


def replace_parts(spark: SparkSession, new: DataFrame, root: str, table: str, part: str, only: list[str]) -> None:
    """The parts ``only`` (values of column ``part``) hold the rows that ``new`` has for them and
    nothing else; a part without new rows goes.  Other rows of ``new`` are not looked at."""
    number, tables = manifest(spark, root)
    mine = new.where(F.coalesce(F.col(part).cast("string"), F.lit(_NONE)).isin(only))
    written = write_parts(mine, root, table, F.col(part))
    commit(spark, root, number, {table: {p: written.get(p) for p in only}})


def create(spark: SparkSession, root: str, tables: dict[str, tuple[DataFrame, str]]) -> None:
    """Write tables, each (rows, column that names the part), and commit them together."""
    number, known = manifest(spark, root)
    changes = {}
    for name, (df, part) in tables.items():
        changes[name] = {**dict.fromkeys(known.get(name, {})), **write_parts(df, root, name, F.col(part))}
    commit(spark, root, number, changes)


def rename_everywhere(spark: SparkSession, root: str, columns: dict[str, tuple[str, str]], renames: dict[str, str]) -> dict[str, list[str]]:
    """Rename values in several tables with one commit; ``columns`` names for each table the
    column of the value and the column of the part.  Returns the parts rewritten, by table.

    Parts without an old value, and not the new home of one, keep their files.  If any table
    fails, none is changed."""
    number, tables = manifest(spark, root)
    old = list(renames)
    pairs = [F.lit(x) for kv in renames.items() for x in kv]
    changes, touched = {}, {}
    for table, (column, part) in columns.items():
        rows = read_table(spark, root, table)
        renamed = F.coalesce(F.create_map(*pairs)[F.col(column)], F.col(column)) if pairs else F.col(column)
        hit = rows.where(F.col(column).isin(old))
        before = _part_names(hit, F.col(part))
        after = _part_names(hit.withColumn(column, renamed), F.col(part))
        touched[table] = sorted({*before, *after})
        current = {p: f for p, f in tables[table].items() if p in touched[table]}
        if not current:
            continue
        written = write_parts(read_parts(spark, current).withColumn(column, renamed), root, table, F.col(part))
        changes[table] = {p: written.get(p) for p in touched[table]}
    commit(spark, root, number, changes)
    return touched
