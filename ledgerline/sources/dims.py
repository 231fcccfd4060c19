"""Dimension tables (client registry, SLA minimums, per-signature targets).

In production these are small maintained tables (hundreds of rows) read from
the catalog; for the driver's test data they are the literal registries below.
Their size is bounded by the number of contracted brands, which is why the
operators broadcast them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Registry rows: brand_code, brand_name, client_name, financial_format.
CLIENT_MAPPING = [
    ("LM", "Lumen Vale", "Northwind Gaming", "detailed"),
    ("RJ", "Red Juniper", "Northwind Gaming", "detailed"),
    ("LT", "Lattice Bet", "Harbor Play", "basic"),
    ("YU", "Yuzu Spins", "Harbor Play", "sheet_cohort"),
    ("BHL", "Bahia Luck", "Orchid Media", "detailed"),
    ("KO", "Kobalt Casino", "Orchid Media", "Standard"),
]

# SLA rows: client_name, brand_code, lifecycle, monthly_minimum_records.
CONTRACTUAL_VOLUMES = [
    ("Northwind Gaming", "LM", "WB", 1200),
    ("Northwind Gaming", "LM", "RND", 900),
    ("Northwind Gaming", "RJ", "WB", 800),
    ("Harbor Play", "LT", "CS", 600),
    ("Harbor Play", "YU", "RND", 700),
    ("Orchid Media", "BHL", "ROC", 500),
    ("Orchid Media", "KO", "FD", 400),
    ("Orchid Media", "KO", "CHU", 300),
    # brand ALL: minimums of the client as a whole
    ("Northwind Gaming", "ALL", "WB", 300),
    ("Orchid Media", "ALL", "ROC", 200),
]


def client_mapping(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        CLIENT_MAPPING, "brand_code string, brand_name string, client_name string, financial_format string")


def contractual_volumes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        CONTRACTUAL_VOLUMES,
        "client_name string, brand_code string, lifecycle string, monthly_minimum_records int")


def granular_benchmarks(ops: DataFrame) -> DataFrame:
    """Per-signature targets.  Derived deterministically from the signatures that
    occur in the operations fact (one row per distinct signature)."""
    from ..functions.campaign import campaign_signature

    sigs = ops.select(F.col("ops_client").alias("client_name"), F.col("tag").alias("brand_code"),
                      campaign_signature("campaign_name").alias("campaign_signature")).distinct()
    n = F.length("campaign_signature")
    return sigs.select(
        "client_name", "brand_code", "campaign_signature",
        (F.lit(0.02) + (n % 5) * F.lit(0.01)).alias("target_conv_pct"),
        (F.lit(0.10) + (n % 7) * F.lit(0.01)).alias("target_li_pct"),
        (F.lit(20.0) + (n % 11)).alias("target_cac_usd"),
    )
