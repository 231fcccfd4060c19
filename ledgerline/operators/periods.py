"""Filters, predicates and period arithmetic.

Filters are plain ``where`` conjunctions so Catalyst pushes them into the
parquet scan; period helpers are date expressions relative to an explicit
``as_of`` argument.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import half_end, half_label, half_start, last_thursday, week_start_friday


def scalar(df: DataFrame) -> Column:
    return df.scalar()


ALL = "All"


@dataclass
class FilterSpec:
    """Optional equality filters; ``All`` (or None) switches one off."""
    client: str | None = None
    brand: str | None = None
    country: str | None = None
    lifecycle: str | None = None
    segment: str | None = None
    engagement: str | None = None
    product: str | None = None
    campaign: str | None = None      # case-insensitive substring
    start: str | None = None         # inclusive dates
    end: str | None = None
    months: tuple[str, str] | None = None  # financial month range
    allowed_clients: list[str] = field(default_factory=lambda: [ALL])


def _on(v) -> bool:
    return v is not None and v != ALL


def filter_ops(ops: DataFrame, f: FilterSpec, snapshot: bool = False) -> DataFrame:
    """P1 on the operations fact (snapshots honour client, brand, product,
    campaign and date only)."""
    conds = []
    if _on(f.client):
        conds.append(F.col("ops_client") == f.client)
    if _on(f.brand):
        conds.append(F.col("ops_brand") == f.brand)
    if _on(f.product):
        conds.append(F.col("extracted_product") == f.product)
    if not snapshot:
        if _on(f.country):
            conds.append(F.upper("country") == f.country.upper())
        if _on(f.lifecycle):
            conds.append(F.col("extracted_lifecycle") == f.lifecycle)
        if _on(f.segment):
            conds.append(F.col("extracted_segment") == f.segment)
        if _on(f.engagement):
            conds.append(F.col("extracted_engagement") == f.engagement)
    if _on(f.campaign):
        conds.append(F.lower("campaign_name").contains(f.campaign.lower()))
    if f.start:
        conds.append(F.col("ops_date") >= F.to_date(F.lit(f.start)))
    if f.end:
        conds.append(F.col("ops_date") <= F.to_date(F.lit(f.end)))
    out = ops
    for c in conds:
        out = out.where(c)
    return client_visibility(out, f.allowed_clients, "ops_client")


def filter_financial(pa: DataFrame, f: FilterSpec) -> DataFrame:
    """P1 on the financial fact: client, brand and month range only."""
    out = pa
    if _on(f.client):
        out = out.where(F.col("client") == f.client)
    if _on(f.brand):
        out = out.where(F.col("brand") == f.brand)
    if f.months:
        out = out.where(F.col("report_month").between(f.months[0], f.months[1]))
    return client_visibility(out, f.allowed_clients, "client")


def client_visibility(df: DataFrame, allowed: list[str] | None, col: str) -> DataFrame:
    """Keep allowed clients unless the list contains ``All``."""
    if not allowed or ALL in allowed:
        return df
    return df.where(F.col(col).isin(list(allowed)))


def _clean(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c) != "") & (F.upper(c) != "UNKNOWN")


def filter_domains(ops: DataFrame, pa: DataFrame) -> DataFrame:
    """Distinct values per filter dimension, UNKNOWN/null/blank removed;
    clients and brands are the union over both facts."""
    of_ops = {"client": "ops_client", "brand": "ops_brand", "country": F.upper("country"), "lifecycle": "extracted_lifecycle",
              "segment": "extracted_segment", "engagement": "extracted_engagement", "product": "extracted_product"}

    def values(df: DataFrame, of: dict) -> DataFrame:
        """(dimension, value) from one pass over a fact: its distinct combinations first, then their values."""
        each = df.select(*[(F.col(c) if isinstance(c, str) else c).alias(d) for d, c in of.items()]).distinct()
        pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in of])
        return each.select(F.explode(pairs).alias("_p")).select("_p.dimension", "_p.value")

    u = values(ops, of_ops).union(values(pa, {"client": "client", "brand": "brand"}))
    return u.where(_clean(F.col("value"))).distinct()


def date_bounds(ops: DataFrame, pa: DataFrame) -> DataFrame:
    """Global min/max over ops dates and financial months (a month's max
    is its last day)."""
    o = ops.agg(F.min("ops_date").alias("ops_min"), F.max("ops_date").alias("ops_max"))
    fmin = scalar(pa.select(F.to_date(F.concat(F.min("report_month"), F.lit("-01")))))
    fmax = scalar(pa.select(F.last_day(F.to_date(F.concat(F.max("report_month"), F.lit("-01"))))))
    return o.select(F.least("ops_min", fmin).alias("min_date"), F.greatest("ops_max", fmax).alias("max_date"))


PRESETS = ["Yesterday", "Last 7 Days", "Last 14 Days", "Last 30 Days", "Last 90 Days", "Current Month", "Last Month"]


def period_presets(ops: DataFrame, as_of: str | None = None) -> DataFrame:
    """Preset ranges relative to the latest date, clamped to the bounds."""
    b = ops.agg(F.min("ops_date").alias("lo"), F.max("ops_date").alias("hi"))
    ref = F.to_date(F.lit(as_of)) if as_of else F.col("hi")
    first_this = F.trunc(ref, "month")
    last_month_end = F.date_sub(first_this, 1)
    rows = [("Yesterday", ref, ref)]
    for n in (7, 14, 30, 90):
        rows.append((f"Last {n} Days", F.date_sub(ref, n - 1), ref))
    rows += [("Current Month", first_this, ref), ("Last Month", F.trunc(last_month_end, "month"), last_month_end)]
    arr = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(n).alias("preset"),
                             F.greatest(s, F.col("lo")).alias("start_date"), F.least(e, F.col("hi")).alias("end_date"))
                    for i, (n, s, e) in enumerate(rows)])
    return b.select(F.explode(arr).alias("r")).select("r.*")


def completed_halves(ops: DataFrame, as_of: str | None = None) -> DataFrame:
    """P5: half-years that hold data and ended before ``as_of``."""
    ref = F.to_date(F.lit(as_of)) if as_of else scalar(ops.select(F.max("ops_date")))
    g = ops.groupBy(half_label("ops_date").alias("half"), half_start("ops_date").alias("start_date"),
                    half_end("ops_date").alias("end_date")).agg(F.countDistinct("ops_date").alias("days_with_data"))
    return g.where(F.col("end_date") < ref)


def completed_weeks(ops: DataFrame, as_of: str | None = None) -> DataFrame:
    """Fri→Thu weeks ending on or before the latest Thursday."""
    ref = F.to_date(F.lit(as_of)) if as_of else scalar(ops.select(F.max("ops_date")))
    x = ops.where(F.col("ops_date") <= last_thursday(ref))
    return x.groupBy(week_start_friday("ops_date").alias("week_start")).agg(
        F.countDistinct("ops_date").alias("days_with_data"), F.sum("records").cast("bigint").alias("records")) \
        .withColumn("week_end", F.date_add("week_start", 6))


def search_page(df: DataFrame, text_col: str, needle: str | None, order: list[str], page: int,
                page_size: int = 1000) -> DataFrame:
    """Substring search, then rows [(p−1)·size, p·size) of the sorted result."""
    x = df
    if needle:
        x = x.where(F.lower(F.col(text_col)).contains(needle.lower()))
    return x.orderBy(*order).offset((page - 1) * page_size).limit(page_size)
