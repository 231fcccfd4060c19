"""The report registry (named, parametrised reports over the stored fact) and distinct-player sketches.

A report is ``REPORTS[name](fact, params) -> {tab: DataFrame}``.  Its parameters are a month
range; the fact is stored by month, so the range is a partition filter and other months are
not listed, let alone read.

Distinct players are not additive, so a stored total for each month says nothing about a
quarter.  The sketch store keeps one mergeable sketch (HyperLogLog) a month and cell of the
breakdowns; the players of any period and breakdown are the union of its sketches, without
reading the fact again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sinks
from .operators import crm as K
from .operators import financial as FIN

Tabs = dict[str, DataFrame]
REPORTS: dict[str, Callable[[DataFrame, dict], Tabs]] = {}


def report(name: str):
    """Register a report under ``name``."""
    def named(fn: Callable[[DataFrame, dict], Tabs]) -> Callable[[DataFrame, dict], Tabs]:
        REPORTS[name] = fn
        return fn
    return named


def in_months(fact: DataFrame, params: dict) -> DataFrame:
    """The months ``start_month`` to ``end_month``; without both, all of them."""
    start, end = params.get("start_month"), params.get("end_month")
    return fact.where(F.col("report_month").between(start, end)) if start and end else fact


@report("full_financial_export")
def full_financial_export(fact: DataFrame, params: dict) -> Tabs:
    summary = FIN.monthly_brand_summary(fact).persist()  # a row a brand and month, read by two tabs
    return {"brands": summary, "both_business": FIN.both_business_summary(summary), "segmentation": FIN.segmentation(fact),
            "cohorts": K.cohort_retention_matrix(fact)}


@report("player_master_list")
def player_master_list(fact: DataFrame, params: dict) -> Tabs:
    return {"players": K.player_master_list(fact)}


@report("cohort_matrix")
def cohort_matrix(fact: DataFrame, params: dict) -> Tabs:
    return {"cohorts": K.cohort_retention_matrix(fact)}


@report("vip_churn_radar")
def vip_churn_radar(fact: DataFrame, params: dict) -> Tabs:
    return {"players": K.vip_churn_radar(fact)}


def compute(spark: SparkSession, name: str, fact_path: str, params: dict | None = None) -> Tabs:
    """A registered report over the fact stored by month at ``fact_path``; an empty range gives empty tabs."""
    if name not in REPORTS:
        raise KeyError(f"unknown report {name}; there are {', '.join(sorted(REPORTS))}")
    schema = spark.read.parquet(fact_path).schema
    fields = ", ".join(f"`{f.name}` {'string' if f.name == 'report_month' else f.dataType.simpleString()}" for f in schema)
    return REPORTS[name](in_months(spark.read.schema(fields).parquet(fact_path), params or {}), params or {})


def store_report(spark: SparkSession, name: str, fact_path: str, root: str, params: dict | None = None) -> dict[str, str]:
    """Compute a report and write its tabs to the report store (W6), below its name."""
    tabs = compute(spark, name, fact_path, params)
    try:
        return {tab: sinks.write_report(FIN.as_report(df), f"{root.rstrip('/')}/{name}", tab) for tab, df in tabs.items()}
    finally:
        for df in tabs.values():
            df.unpersist()


# ---------------------------------------------------------------------------
# Distinct players by sketches
# ---------------------------------------------------------------------------

#: Breakdowns of F13-F15 and K13 that the store serves, and log2 of a sketch's registers
#: (4 KB; standard error 1.04 / sqrt(2 ** 12) = 1.6 %).
SKETCH_CELLS = ["brand", "country", "segment", "wb_tag"]
LG_REGISTERS = 12


def standard_error(lg_registers: int = LG_REGISTERS) -> float:
    return 1.04 / 2 ** (lg_registers / 2)


def write_player_sketches(pa: DataFrame, path: str, lg_registers: int = LG_REGISTERS) -> None:
    """One sketch of the players of each month and cell.  Months in ``pa`` replace their own."""
    cells = pa.where(F.col("id").isNotNull()).groupBy("report_month", *SKETCH_CELLS).agg(F.hll_sketch_agg("id", lg_registers).alias("players"))
    (cells.hint("rebalance", "report_month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("report_month").parquet(path))


def read_player_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(", ".join(f"{c} string" for c in SKETCH_CELLS) + ", players binary, report_month string").parquet(path)


def distinct_players(sketches: DataFrame, by: list, start: str | None = None, end: str | None = None) -> DataFrame:
    """(by, players): approximate distinct players of a period, by any of the cells' columns (or
    expressions of them and the month), from the union of their sketches."""
    some = in_months(sketches, {"start_month": start, "end_month": end})
    return some.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("players")).alias("players"))
