"""Small reference tables.

Each table is a fixed list of a few rows, so its size bound is proven by
construction and broadcasting it is always safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Premium-rate number prefixes.
PREMIUM_PREFIXES = ["1-900", "809", "876"]
# High-cost destination countries.
HIGH_COST_COUNTRIES = ["CU", "SO", "LY", "AF"]
# Registered type allocation codes of the device fixture.
REGISTERED_TACS = ["35332510", "35391805", "35875604", "01326300", "35925406"]


def premium_prefixes(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(p,) for p in PREMIUM_PREFIXES], "prefix string"))


def high_cost_countries(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(p,) for p in HIGH_COST_COUNTRIES], "country string"))


def tac_registry(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(t,) for t in REGISTERED_TACS], "tac_code string"))


def is_premium(number_col) -> "F.Column":
    """Prefix test against the fixed premium list (no join needed)."""
    out = None
    for p in PREMIUM_PREFIXES:
        cond = number_col.startswith(p)
        out = cond if out is None else (out | cond)
    return out
