"""Structured Streaming jobs for the daily operations feed.

The reference appends daily files in chunks, keeps a point-in-time snapshot
log, re-pulls a 14-day tail and keeps the daily pulse current.  Here:

* R1  ``read_ops_stream``: file-source stream with a fixed schema and
      ``maxFilesPerTrigger``; the C1–C14 projections are the batch ones.
* R2/R3 ``ops_sink_batch``: one ``foreachBatch`` appends the snapshot log, copies
      rows older than the 14-day late-data horizon to a late-rows table and
      replaces (day, source) deliveries in the touched ``ops_month`` partitions of
      the live table, as a kept manifest of deliveries decides.
* R4  ``pulse_stream``: event-time windows with a watermark (day labels are
      UTC days, independent of the session time zone), in update mode; ``start_pulse``
      upserts what changed into a table and logs what the state dropped.
* R8  every query has a checkpoint; ``run_available`` uses
      ``Trigger.AvailableNow`` so a restart processes only new files.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import lean_steps
from ..sinks import path_exists, remove_path
from ..sources.testdata import finish_ops_rows

LATE_HORIZON_DAYS = 14

RAW_OPS_SCHEMA = (
    "campaign string, ops_date date, records long, calls long, conversions long, kpi2_logins long, "
    "d_plus long, d_minus long, d_neutral long, tech_issues long, am long, dnc long, na long, dx long, wn long, "
    "hlrv long, twoxrv long, sa long, sd long, sf long, sp long, ev long, es long, ed long, eo long, ec long, "
    "ef long, optouts_all long, optout_call long, optout_sms long, optout_email long, _price decimal(22,2)")


#: How a file's path names its source and its delivery: ``…/source=<name>/delivery=<id>/…``.
SOURCE_FOLDER, DELIVERY_FOLDER = "source", "delivery"


def _folder(path: Column, name: str) -> Column:
    """The value of a ``name=value`` folder of a path, null without one."""
    return F.nullif(F.regexp_extract(path, f"/{name}=([^/]+)/", 1), F.lit(""))


def delivery_of(path: Column, modified: Column) -> Column:
    """(source, at, file): which source a file comes from, which of its deliveries it belongs to
    (ids sort by time; without one, the file's modification time), and the file."""
    at = F.coalesce(_folder(path, DELIVERY_FOLDER), F.lpad(F.unix_micros(modified).cast("string"), 20, "0"))
    return F.struct(_folder(path, SOURCE_FOLDER).alias("source"), at.alias("at"), path.alias("file"))


def read_ops_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 8) -> DataFrame:
    """Raw daily operations rows as a stream; a delivery is one or more files."""
    raw = (spark.readStream.schema(RAW_OPS_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
           .option("recursiveFileLookup", "true").parquet(path))
    return raw.withColumn("delivery", delivery_of(F.col("_metadata.file_path"), F.col("_metadata.file_modification_time")))


def parse_stream(raw: DataFrame) -> DataFrame:
    """The stateless batch projections (C1–C14, J4) applied to the stream's batches."""
    return finish_ops_rows(raw)


def read_manifest(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The manifest's entries, of the batches before one (a replayed batch sees the same)."""
    if not path_exists(spark, path):
        return None
    entries = spark.read.schema(MANIFEST_SCHEMA).parquet(path)
    return entries if before is None else entries.where(F.col("batch_id") < before)


MANIFEST_SCHEMA = "ops_date date, unit string, source string, at string, known_at string, status string, rows long, batch_id long, ops_month string"


def _unit() -> Column:
    """What a delivery replaces within a day: its source's rows, without a source its campaign's."""
    return F.coalesce(F.concat(F.lit("source "), "_source"), F.concat(F.lit("campaign "), "campaign_name"))


def judge_deliveries(heads: DataFrame, known: DataFrame | None) -> DataFrame:
    """``heads`` (the newest delivery of each (ops_date, unit) in a batch) with ``known_at``, the one
    that the manifest has, and a status: ``new``, ``newer``, ``same`` (more files of the known
    delivery) or ``stale`` (older than the known one)."""
    if known is None:
        judged = heads.withColumn("known_at", F.lit(None).cast("string"))
    else:
        latest = known.groupBy("ops_month", "ops_date", "unit").agg(F.max("at").alias("known_at"))
        judged = heads.join(latest, ["ops_month", "ops_date", "unit"], "left")
    status = (F.when(F.col("known_at").isNull(), "new").when(F.col("at") > F.col("known_at"), "newer")
              .when(F.col("at") == F.col("known_at"), "same").otherwise("stale"))
    return judged.withColumn("status", status)


def _stored(df: DataFrame, table: str, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` written once beside ``table`` and read back (a checkpoint computes its rows twice); a
    later batch or a replay writes over it."""
    path = f"{table.rstrip('/')}_{name}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Files of a month in the live table; beyond that, a batch that touches it gathers them.
FILES_A_MONTH = 16


def _crowded(spark: SparkSession, live_path: str, months: list[str]) -> bool:
    """Whether these months of the live table lie in too many files."""
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{live_path.rstrip('/')}/ops_month={{{','.join(months)}}}/part-*")
    found = files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(files)
    return len(found or ()) > FILES_A_MONTH * len(months)


#: What the live table holds once.
LIVE_KEY = ("ops_date", "campaign_name", "_source")


def newest_rows(rows: DataFrame, last: Column, table: str) -> DataFrame:
    """Of the rows of one ``LIVE_KEY`` the one of the largest ``last``.  Only hashes of keys are
    shuffled; whole rows move only where a hash comes twice."""
    rows = rows.withColumn("_key", F.xxhash64(*LIVE_KEY))
    twice = _stored(rows.groupBy("_key").count().where("count > 1").select("_key"), table, "twice")
    if twice.isEmpty():
        return rows.drop("_key")
    columns = [c for c in rows.columns if c != "_key"]
    newest = (rows.join(twice, "_key", "left_semi").groupBy(*LIVE_KEY)
              .agg(F.max_by(F.struct(*columns), last).alias("r")).select("r.*"))
    return rows.join(twice, "_key", "left_anti").select(*columns).unionByName(newest)


def ops_sink_batch(live_path: str, snapshot_path: str, late_path: str, horizon_days: int = LATE_HORIZON_DAYS,
                   manifest_path: str | None = None, parse: Callable[[DataFrame], DataFrame] | None = None):
    """R2 + R3 as a ``foreachBatch`` function; ``parse`` makes a batch's rows the fact's (without it
    they are).

    Several sources deliver a day, each as one or more files, and deliver it again when late
    numbers arrive.  The live table holds, for each (day, source), the rows of its newest
    delivery and nothing else: a newer delivery replaces the source's rows of that day, so
    campaigns that it drops are gone; more files of the same delivery add to it; an older one is
    only logged.  Other sources' rows stay.  So the live table is the same however files are
    spread over triggers and in whatever order they come.

    * A file whose source is not known replaces campaign by campaign (the unit of replacement is
      the campaign instead of the source), so no row of another file is lost.
    * Of several rows of one campaign, day and source in a delivery, the one of the last file
      counts (in a file: the one of the largest hash).
    * The manifest keeps every judged delivery: (day, unit, source, delivery, status, rows), by
      month and batch.  Only the entries and live rows of the months in a batch are read.
    * Rows older than the horizon, which trails the newest day that earlier batches accepted, go
      to the live table like all others and, as an audit copy, to ``late_path`` (so that copy,
      unlike the live table, depends on the batches).
    * Rows without a date are logged in the snapshots alone.

    Every table is safe to replay: snapshots, late rows and manifest are replaced by batch id,
    and a batch first takes back what an earlier attempt of its own put into the live table.
    Only touched months are rewritten (dynamic partition overwrite).

    Whole rows are shuffled once, by month and before they are parsed; the parsed batch is then kept
    as files by month until the batch ends, and every table is written from these as they lie.  (They
    move again where deliveries are too many to broadcast, as campaigns without a source may be.)
    """
    manifest = manifest_path or live_path.rstrip("/") + "_manifest"

    def by_batch(df: DataFrame, epoch_id: int, path: str) -> None:
        (df.withColumn("batch_id", F.lit(epoch_id).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id", "ops_month").parquet(path))

    def ingest(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        month = F.date_format("ops_date", "yyyy-MM")
        # a month's rows together, large months in several tasks
        rows = batch.withColumn("_month", month).hint("rebalance", "_month").drop("_month")
        rows = parse(rows) if parse else rows
        given = {f.name for f in rows.schema["delivery"].dataType.fields} if "delivery" in rows.columns else set()
        meta = [(F.col(f"delivery.{c}") if c in given else F.lit(None)).cast("string").alias(f"_{c}") for c in ("source", "at", "file")]
        columns = [c for c in rows.columns if c != "delivery"]
        b = _stored(rows.select(*columns, *meta, month.alias("ops_month")).withColumn("_at", F.coalesce("_at", F.lit(""))),
                    live_path, "batch", ("ops_month",))
        entries = read_manifest(spark, manifest, epoch_id)
        seen = None if entries is None else entries.agg(F.max("ops_date")).first()[0]
        by_batch(b.select(*columns, "ops_month").withColumn("snapshot_timestamp", F.current_timestamp()), epoch_id, snapshot_path)
        dated = b.where(F.col("ops_date").isNotNull()).withColumn("unit", _unit())
        # Months in a batch: bounded by the calendar.
        months = sorted(r[0] for r in dated.select("ops_month").distinct().collect())
        if not months:
            return
        if seen is not None:
            by_batch(dated.where(F.col("ops_date") < F.date_sub(F.lit(seen), horizon_days)).select(*columns, "ops_month"),
                     epoch_id, late_path)
        # The largest text of many rows would sort them all: deliveries are counted first.
        heads = dated.groupBy("ops_month", "ops_date", "unit", "_source", "_at").count().groupBy("ops_month", "ops_date", "unit").agg(
            F.max("_at").alias("at"), F.first("_source").alias("source"), F.sum("count").alias("rows"))
        judged = judge_deliveries(heads, None if entries is None else entries.where(F.col("ops_month").isin(months)))
        judged = _stored(judged, live_path, "judged")
        accepted = dated.join(judged.where("status <> 'stale'").selectExpr("ops_date", "unit", "at _at"), ["ops_date", "unit", "_at"])
        live = accepted.select(*columns, "_source", "_at", "_file", "ops_month", F.lit(epoch_id).cast("long").alias("_batch"))
        kept, crowded = None, False
        if path_exists(spark, live_path):
            current = spark.read.schema(live.schema).parquet(live_path).where(
                F.col("ops_month").isin(months) & (F.col("_batch") != epoch_id)).withColumn("unit", _unit())
            status = judged.select("ops_date", "unit", "status")
            # Rows of a delivery of which more files came may meet the same keys again; other kept rows do not.
            same = current.join(status.where("status = 'same'"), ["ops_date", "unit"], "left_semi")
            kept = current.join(status.where("status <> 'stale'"), ["ops_date", "unit"], "left_anti").select(*live.columns)
            live = live.unionByName(same.select(*live.columns))
            crowded = _crowded(spark, live_path, months)
        live = newest_rows(live, F.struct("_at", "_file", F.xxhash64(*columns)), live_path)
        live = live if kept is None else live.unionByName(kept)
        # Spark swaps the months when all their rows are written.
        ((live.hint("rebalance", "ops_month") if crowded else live).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("ops_month").parquet(live_path))
        by_batch(judged.select("ops_date", "unit", "source", "at", "known_at", "status", "rows", "ops_month")
                 .hint("rebalance", "ops_month"), epoch_id, manifest)

    def fn(batch: DataFrame, epoch_id: int) -> None:
        try:
            with lean_steps(batch.sparkSession):
                ingest(batch, epoch_id)
        finally:
            remove_path(batch.sparkSession, live_path.rstrip("/") + "_batch")
    return fn


def start_ops_ingest(spark: SparkSession, source: str, out_root: str, checkpoint: str,
                     available_now: bool = True, max_files_per_trigger: int = 8):
    """R1–R3 end to end; returns the running query."""
    stream = read_ops_stream(spark, source, max_files_per_trigger)
    fn = ops_sink_batch(os.path.join(out_root, "ops_live"), os.path.join(out_root, "ops_snapshots"),
                        os.path.join(out_root, "ops_late"), parse=parse_stream)
    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def pulse_stream(events: DataFrame, ts: str = "event_ts", key: str = "engagement",
                 value_cols: tuple[str, ...] = ("records", "conversions", "kpi2_logins"),
                 watermark: str = f"{LATE_HORIZON_DAYS} days") -> DataFrame:
    """Daily pulse kept current with event-time windows and a watermark."""
    g = events.withWatermark(ts, watermark).groupBy(F.window(ts, "1 day").alias("day"), key)
    out = g.agg(F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(f"total_{c}") for c in value_cols])
    # Day windows align to UTC days; label them with the UTC epoch day so the
    # result does not depend on the session time zone.
    day = F.date_from_unix_date(F.floor(F.unix_micros(F.col("day.start")) / F.lit(86400000000)).cast("int"))
    return out.select(day.alias("day"), key, "rows", *[f"total_{c}" for c in value_cols])


def run_available(query) -> None:
    """Drain what is available (AvailableNow) and stop."""
    query.awaitTermination()


def event_pulse_stream(spark: SparkSession, events_path: str) -> DataFrame:
    """R4 on the ``events`` table read as a file stream (one row per event)."""
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    # A file stream watches a directory; a single table file is selected by name.
    folder, name = os.path.split(events_path.rstrip("/"))
    reader = spark.readStream.schema(schema)
    ev = reader.option("pathGlobFilter", name).parquet(folder) if name.endswith(".parquet") else reader.parquet(events_path)
    # Watermarks need TIMESTAMP; the feed's zone-less wall-clock times are read
    # as UTC instants whatever the session time zone is.
    ev = ev.withColumn("event_ts", F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone())) \
        .withColumnRenamed("event_type", "engagement")
    return pulse_stream(ev, value_cols=("value",))


def upsert_pulse(path: str, keys: tuple[str, ...] = ("day", "engagement")):
    """A ``foreachBatch`` function for an aggregate in update mode: rows of a batch replace the
    table's rows of the same keys, and only the months they fall in are read and rewritten.

    A batch holds the whole new value of each key it touches, so a replay writes the same rows.
    A key that the state has dropped keeps its last value in the table."""
    def fn(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        changed = batch.withColumn("month", F.date_format(keys[0], "yyyy-MM")).checkpoint(eager=True)
        # Months in a batch: bounded by the calendar.
        months = [r[0] for r in changed.select("month").distinct().collect()]
        if not months:
            return
        if path_exists(spark, path):
            current = spark.read.schema(changed.schema).parquet(path).where(F.col("month").isin(months))
            same = None
            for k in keys:
                equal = F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}"))
                same = equal if same is None else same & equal
            kept = current.alias("o").join(changed.select(*keys).alias("n"), same, "left_anti")
            changed = changed.unionByName(kept).checkpoint(eager=True)
        (changed.hint("rebalance", "month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("month").parquet(path))
    return fn


def start_pulse(pulse: DataFrame, path: str, checkpoint: str, available_now: bool = True, keys: tuple[str, ...] = ("day", "engagement")):
    """Keep the pulse table at ``path`` current; returns the running query.  State is evicted
    behind the watermark."""
    w = pulse.writeStream.outputMode("update").foreachBatch(upsert_pulse(path, keys)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def state_report(query) -> list[dict]:
    """Per batch: event-time watermark, rows held in state, rows evicted, and late rows that
    arrived behind the watermark and are not in the result."""
    out = []
    for p in query.recentProgress:
        states = p["stateOperators"] if isinstance(p, dict) else [o for o in p.stateOperators]
        get = (lambda o, k: o[k]) if isinstance(p, dict) else getattr
        row = {"batch_id": p["batchId"], "input_rows": p["numInputRows"], "watermark": dict(p["eventTime"]).get("watermark")}
        for name in ("numRowsTotal", "numRowsRemoved", "numRowsDroppedByWatermark"):
            row[name] = sum(get(o, name) for o in states)
        out.append(row)
    return out


def run_pulse(pulse: DataFrame, path: str, checkpoint: str, keys: tuple[str, ...] = ("day", "engagement")) -> DataFrame:
    """Drain a pulse into its table and return the table."""
    query = start_pulse(pulse, path, checkpoint, keys=keys)
    query.awaitTermination()
    return pulse.sparkSession.read.parquet(path).drop("month")
