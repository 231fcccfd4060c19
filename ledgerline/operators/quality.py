"""Data quality and completeness (Q1–Q10).

Calendars (brand × month, date ranges) are generated per entity with
``explode(sequence(...))`` from small aggregated tables and compared to the
facts with anti/left joins; nothing is collected to the driver except the
strict-mode assertion in ``assert_no_gaps``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.core import month_from_index, month_index


def scalar(df: DataFrame) -> Column:
    return df.scalar()


def _brand_month_spine(pa: DataFrame) -> DataFrame:
    ents = pa.where(F.col("brand").isNotNull() & F.col("report_month").isNotNull()).groupBy("brand").agg(
        F.min(month_index("report_month")).alias("_lo"), F.max(month_index("report_month")).alias("_hi"))
    allw = Window.partitionBy()  # over the per-brand table only (one row per brand)
    ents = ents.withColumn("_glo", F.min("_lo").over(allw)).withColumn("_ghi", F.max("_hi").over(allw))
    return ents.select("brand", F.explode(F.sequence("_glo", "_ghi")).alias("_mi")) \
        .select("brand", month_from_index("_mi").alias("report_month"))


def registry_gaps(pa: DataFrame) -> DataFrame:
    """Q1: every brand must hold every month between the global min and max."""
    loaded = pa.select("brand", "report_month").distinct()
    return _brand_month_spine(pa).join(loaded, ["brand", "report_month"], "left_anti")


def assert_no_gaps(pa: DataFrame, limit: int = 20) -> None:
    """Q1 strict mode: fail the run when any gap exists (bounded sample in the message)."""
    sample = registry_gaps(pa).orderBy("brand", "report_month").limit(limit).collect()
    if sample:
        raise ValueError("missing (brand, month): " + ", ".join(f"{r.brand} {r.report_month}" for r in sample))


def compliance_grid(pa: DataFrame) -> DataFrame:
    """Q2: month × brand → IMPORTED / PENDING (long form; pivot for display)."""
    loaded = pa.select("brand", "report_month").distinct().withColumn("_ok", F.lit(True))
    g = _brand_month_spine(pa).join(loaded, ["brand", "report_month"], "left")
    return g.select("report_month", "brand",
                    F.when(F.col("_ok"), "IMPORTED").otherwise("PENDING").alias("status"))


def unmapped_tags(ops: DataFrame, mapping: DataFrame) -> DataFrame:
    """Brand tags seen in operations but absent from the registry."""
    tags = ops.select("tag").where((F.col("tag") != "UNKNOWN") & F.col("tag").isNotNull()).distinct()
    return tags.join(F.broadcast(mapping.select(F.col("brand_code").alias("tag"))), "tag", "left_anti")


def client_health(mapping: DataFrame, sla: DataFrame, ops: DataFrame, pa: DataFrame) -> DataFrame:
    """Union of client names from the registry, the SLA table and the
    operations fact; brands registered, SLAs configured, last ops date, last
    financial month and registration status."""
    names = (mapping.select(F.col("client_name").alias("client"))
             .union(sla.select(F.col("client_name").alias("client")))
             .union(ops.select(F.col("ops_client").alias("client")))
             .union(pa.select(F.col("client").alias("client")))
             .where(F.col("client").isNotNull() & (F.trim("client") != "") & (F.col("client") != "UNKNOWN"))
             .distinct())
    brands = mapping.groupBy(F.col("client_name").alias("client")).agg(F.count(F.lit(1)).alias("brands_registered"))
    slas = sla.groupBy(F.col("client_name").alias("client")).agg(F.count(F.lit(1)).alias("slas_configured"))
    last_ops = ops.groupBy(F.col("ops_client").alias("client")).agg(F.max("ops_date").alias("last_ops_date"))
    last_fin = pa.groupBy("client").agg(F.max("report_month").alias("last_fin_month"))
    x = names.join(brands, "client", "left").join(slas, "client", "left").join(last_ops, "client", "left") \
        .join(last_fin, "client", "left")
    return x.select("client", F.coalesce("brands_registered", F.lit(0)).cast("bigint").alias("brands_registered"),
                    F.coalesce("slas_configured", F.lit(0)).cast("bigint").alias("slas_configured"),
                    "last_ops_date", "last_fin_month",
                    F.when(F.col("brands_registered").isNotNull(), "Registered").otherwise("Unregistered").alias("status"))


def ops_completeness(ops: DataFrame, pa: DataFrame | None = None, as_of: str | None = None) -> DataFrame:
    """Q5 (+Q6): per ops month, distinct days vs the expected count (current
    month: day − 1, future: 0, else days in month) and the financial status."""
    ref = F.to_date(F.lit(as_of)) if as_of else scalar(ops.select(F.max("ops_date")))
    g = ops.groupBy(F.date_format("ops_date", "yyyy-MM").alias("month")).agg(
        F.countDistinct("ops_date").alias("actual_days"), F.sum("records").cast("bigint").alias("records"),
        F.sum("kpi2_logins").cast("bigint").alias("logins"), F.sum("conversions").cast("bigint").alias("conversions"),
        F.sum("calls").cast("bigint").alias("calls"))
    mstart = F.to_date(F.concat(F.col("month"), F.lit("-01")))
    expected = (F.when(F.trunc(ref, "month") == mstart, F.greatest(F.dayofmonth(ref) - 1, F.lit(0)))
                .when(mstart > ref, F.lit(0)).otherwise(F.dayofmonth(F.last_day(mstart))))
    g = g.withColumn("expected_days", expected.cast("int"))
    e, a = F.col("expected_days"), F.col("actual_days")
    status = (F.when(e == 0, F.lit("N/A (Future)")).when(a == 0, F.lit("Incomplete"))
              .when(a >= e, F.lit("Complete"))
              .when(e - a <= 2, F.format_string("Warning (%d/%d days)", a, e))
              .otherwise(F.format_string("Partial (%d/%d days)", a, e)))
    g = g.withColumn("ops_status", status)
    if pa is not None:
        fin = pa.select(F.col("report_month").alias("month")).distinct().withColumn("_fin", F.lit(True))
        g = g.join(fin, "month", "left")
        diff = month_index(F.date_format(ref, "yyyy-MM")) - month_index("month")
        g = g.withColumn("financial_status", F.when(F.col("_fin"), "Complete").when(diff <= 0, "Pending")
                         .when(diff == 1, "Warning (Missing Last Month)").otherwise("Issue (Missing +2 Months)")).drop("_fin")
    return g


def daily_drilldown(ops: DataFrame, month: str | None = None) -> DataFrame:
    """Q7: sums per day of one month (default: the latest month)."""
    m = F.lit(month) if month else scalar(ops.select(F.date_format(F.max("ops_date"), "yyyy-MM")))
    return ops.where(F.date_format("ops_date", "yyyy-MM") == m).groupBy("ops_date").agg(
        F.sum("records").cast("bigint").alias("records"), F.sum("kpi2_logins").cast("bigint").alias("logins"),
        F.sum("conversions").cast("bigint").alias("conversions"), F.sum("calls").cast("bigint").alias("calls"))


def date_gaps(ops: DataFrame, through: str | None = None) -> DataFrame:
    """Q8: days without data between the first date and ``through`` (default the
    last date) — inner holes included."""
    bounds = ops.agg(F.min("ops_date").alias("_lo"), F.max("ops_date").alias("_hi"))
    if through:
        bounds = bounds.withColumn("_hi", F.to_date(F.lit(through)))
    spine = bounds.select(F.explode(F.sequence("_lo", "_hi")).alias("ops_date"))
    return spine.join(ops.select("ops_date").distinct(), "ops_date", "left_anti")


def sync_check(raw: DataFrame, materialized: DataFrame) -> DataFrame:
    """Q9: min/max dates of the raw and the materialized table side by side."""
    a = raw.agg(F.min("ops_date").alias("raw_min"), F.max("ops_date").alias("raw_max"))
    return a.select("raw_min", "raw_max",
                    scalar(materialized.select(F.min("ops_date"))).alias("mat_min"),
                    scalar(materialized.select(F.max("ops_date"))).alias("mat_max")) \
        .withColumn("in_sync", (F.col("raw_min") == F.col("mat_min")) & (F.col("raw_max") == F.col("mat_max")))


def post_load_check(ops: DataFrame, target_date: str | None = None) -> DataFrame:
    """Q10: rows loaded for the target date (default the latest) and the verdict."""
    d = F.to_date(F.lit(target_date)) if target_date else scalar(ops.select(F.max("ops_date")))
    return ops.where(F.col("ops_date") == d).agg(F.count(F.lit(1)).alias("rows")) \
        .select(d.alias("target_date"), "rows", (F.col("rows") > 0).alias("ok"))
