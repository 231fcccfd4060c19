"""Player-journey tracking (R5–R7) — specified in the reference's design notes,
not implemented there; built here as Spark jobs over the contact-event feed.

R5  de-duplication on (box, contact, type, time): ``dropDuplicatesWithinWatermark``
    for the stream, ``dropDuplicates`` for batch.
R6  funnel per campaign: calls → logins → registrations → deposits (distinct
    contacts per step) and ROI = GGR of depositing accounts / campaign cost.
R7  time to convert: first event per step per contact, hours between steps,
    exact median per step and a 24-hour-bucket histogram.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from ..functions.core import MONEY, money_sum

DEDUP_KEYS = ["box_id", "contact_id", "event_type", "event_at"]
# The funnel steps in order.
FUNNEL_STEPS = ["call", "login", "register", "deposit"]


def dedup_batch(events: DataFrame) -> DataFrame:
    """R5 (batch): of the deliveries of one key, the one with the smallest ``event_id``
    stays (ties and feeds without that id: the smallest of the other columns)."""
    rest = sorted((c for c in events.columns if c not in DEDUP_KEYS), key=lambda c: (c != "event_id", c))
    if not rest:
        return events.distinct()
    first = events.groupBy(*DEDUP_KEYS).agg(F.min(F.struct(*rest)).alias("_first"))
    return first.select(*[F.col(c) if c in DEDUP_KEYS else F.col(f"_first.{c}").alias(c) for c in events.columns])


def dedup_stream(events: DataFrame, watermark: str = "14 days") -> DataFrame:
    """R5 (stream): of the events of one key the first to arrive stays; a later one within the
    watermark is dropped.  The state holds the keys of the watermark's span alone.

    Zone-less event times count as UTC instants, whatever the session time zone is."""
    ts = "event_at"
    if isinstance(events.schema[ts].dataType, TimestampNTZType):
        ts = "_event_ts"
        events = events.withColumn(ts, F.from_utc_timestamp(F.col("event_at").cast("timestamp"), F.current_timezone()))
    return events.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(DEDUP_KEYS).drop("_event_ts")


def read_event_stream(spark: SparkSession, path: str, schema: StructType, max_files_per_trigger: int = 8) -> DataFrame:
    """The contact-event feed, files below ``path`` in the order of their arrival."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .option("recursiveFileLookup", "true").parquet(path))


def start_dedup(events: DataFrame, path: str, checkpoint: str, watermark: str = "14 days", available_now: bool = True):
    """Append the de-duplicated feed to the event log at ``path``, partitioned by event day;
    returns the running query.  File sink and checkpoint make a restart exactly-once."""
    kept = dedup_stream(events, watermark).withColumn("event_day", F.date_format("event_at", "yyyy-MM-dd"))
    w = kept.writeStream.format("parquet").outputMode("append").partitionBy("event_day").option("path", path).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def funnel(events: DataFrame, pa: DataFrame | None = None) -> DataFrame:
    """Distinct contacts per step and campaign; step conversion rates;
    cost = value of call events; GGR of the depositing accounts (joined to the
    player facts on the account number) and ROI = GGR / cost."""
    e = dedup_batch(events)
    g = e.groupBy("campaign_id").agg(
        *[F.countDistinct(F.when(F.col("event_type") == s, F.col("contact_id"))).alias(f"{s}_contacts")
          for s in FUNNEL_STEPS],
        F.sum(F.when(F.col("event_type") == "call", F.col("value"))).cast(MONEY).alias("cost"))
    for a, b in zip(FUNNEL_STEPS, FUNNEL_STEPS[1:]):
        g = g.withColumn(f"{a}_to_{b}_pct", F.when(F.col(f"{a}_contacts") > 0,
                                                   F.col(f"{b}_contacts") / F.col(f"{a}_contacts") * 100.0)
                         .otherwise(F.lit(0.0)))
    if pa is not None:
        depositors = e.where(F.col("event_type") == "deposit").select("campaign_id", "account_number").distinct()
        ggr = pa.groupBy(F.col("id").alias("account_number")).agg(money_sum("revenue").alias("ggr"))
        per = depositors.join(ggr, "account_number").groupBy("campaign_id").agg(F.sum("ggr").cast(MONEY).alias("ggr"))
        g = g.join(per, "campaign_id", "left").withColumn("ggr", F.coalesce("ggr", F.lit(0).cast(MONEY)))
        g = g.withColumn("roi", F.when(F.col("cost") > 0, F.col("ggr").cast("double") / F.col("cost").cast("double")))
    return g


def _hours(a: str, b: str):
    """Hours from step ``a`` to step ``b`` (microsecond precision)."""
    us = (F.unix_micros(F.col(f"t_{b}").cast("timestamp")) - F.unix_micros(F.col(f"t_{a}").cast("timestamp")))
    return us.cast("double") / F.lit(1000000.0) / F.lit(3600.0)


def first_step_times(events: DataFrame) -> DataFrame:
    """First time each contact reached each step (one row per contact)."""
    e = dedup_batch(events)
    return e.groupBy("contact_id").agg(
        *[F.min(F.when(F.col("event_type") == s, F.col("event_at"))).alias(f"t_{s}") for s in FUNNEL_STEPS])


def exact_medians(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, contacts, median) of a double column, exact, with no group in one buffer.

    Counts per distinct value give a histogram of whole units; the bucket (or two) that
    holds the middle ranks is found on it, and only its values are ordered."""
    counts = rows.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n")).withColumn("_bucket", F.floor(value))
    group = Window.partitionBy(key)
    below = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    hist = (counts.groupBy(key, "_bucket").agg(F.sum("_n").alias("_in"))
            .withColumn("_all", F.sum("_in").over(group))
            .withColumn("_below", F.coalesce(F.sum("_in").over(below), F.lit(0))))
    low, high = F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2)
    middle = hist.where((F.col("_below") <= high) & (F.col("_below") + F.col("_in") > low))
    smaller = Window.partitionBy(key, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    at = counts.join(middle, [key, "_bucket"]).withColumn(
        "_rank", F.col("_below") + F.coalesce(F.sum("_n").over(smaller), F.lit(0)))

    def ranked(rank):
        return F.max(F.when((F.col("_rank") <= rank) & (rank < F.col("_rank") + F.col("_n")), F.col(value)))

    return at.groupBy(key, F.col("_all").alias("contacts")).agg((ranked(low) * 0.5 + ranked(high) * 0.5).alias("median"))


def time_to_convert(events: DataFrame) -> DataFrame:
    """Per step transition, contacts that made it (later step after the
    earlier one) and the exact median hours, from one pass over the contacts."""
    t = first_step_times(events)
    made = F.array(*[F.struct(F.lit(f"{a}_to_{b}").alias("step"), F.when(F.col(f"t_{b}") >= F.col(f"t_{a}"), _hours(a, b)).alias("hours"))
                     for a, b in zip(FUNNEL_STEPS, FUNNEL_STEPS[1:])])
    rows = t.select(F.explode(made).alias("m")).select("m.step", "m.hours").where(F.col("hours").isNotNull())
    return exact_medians(rows, "step", "hours").select("step", "contacts", F.round("median", 6).alias("median_hours"))


def time_to_convert_histogram(events: DataFrame) -> DataFrame:
    """Contacts per 24-hour bucket of the call → deposit time."""
    t = first_step_times(events)
    h = _hours("call", "deposit")
    x = t.where(F.col("t_call").isNotNull() & F.col("t_deposit").isNotNull() & (F.col("t_deposit") >= F.col("t_call")))
    return x.groupBy(F.floor(h / 24).cast("bigint").alias("day_bucket")).agg(F.count(F.lit(1)).alias("contacts"))
