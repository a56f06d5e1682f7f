"""Star-schema builds (M01-M11) and warehouse loading.

Dimensions and facts are narrow projections of the batch files; the only
join is profiles LEFT JOIN behavior on customer_id (J01), which Catalyst
plans as a broadcast hash join when behavior's runtime size is under the
broadcast threshold and as a sort-merge join otherwise (AQE).  Loading is a
distributed ``write.mode("overwrite")`` per table — no rows pass through the
driver — and the row-count check reads the written tables back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..sources import fixtures as fx
from ..sources.schemas import WAREHOUSE
from ..sources.tables import Tables

c = F.col

# Column lists of the wide builds (reference order).
DIM_CUSTOMER_COLUMNS = [
    "customer_id", "age", "gender", "region", "marital_status", "education_level",
    "employment_status", "income", "preferred_language", "monthly_online_purchases",
    "avg_cart_value", "most_purchased_category", "preferred_contact_channel", "offer_response_rate"]
DIM_DEVICE_COLUMNS = ["customer_id", "device_type", "num_devices_registered", "device_age_months",
                      "network_generation", "os_type", "uses_5g", "device_security_patch"]
DIM_LOCATION_COLUMNS = ["tower_id", "city", "state", "zip_code", "latitude", "longitude",
                        "urbanization_level"]
FACT_CDR_COLUMNS = ["customer_id", "monthly_call_count", "monthly_call_duration",
                    "international_call_duration", "call_drop_count", "sms_usage_per_month"]
FACT_PAYMENTS_COLUMNS = ["customer_id", "monthly_spending", "credit_score", "payment_method",
                         "avg_payment_delay", "payment_behavior_index", "credit_limit"]
FACT_COMPLAINTS_COLUMNS = ["customer_id", "customer_satisfaction_score", "customer_complaints",
                           "technical_support_rating", "churn_risk_score", "has_contacted_support"]
FACT_INTERNET_COLUMNS = ["customer_id", "internet_usage_gb", "internet_speed_avg_mbps", "latency_ms",
                         "peak_usage_hour", "weekend_data_ratio"]
FACT_NETWORK_COLUMNS = ["tower_id", "signal_strength_avg", "network_downtime_minutes",
                        "network_congestion_level", "avg_signal_strength"]
FACT_SECURITY_COLUMNS = ["customer_id", "num_failed_logins", "num_fraud_attempts", "encryption_type",
                         "biometric_auth", "two_factor_auth"]


def dim_customer(profiles: DataFrame, behavior: DataFrame) -> DataFrame:
    """Profiles LEFT JOIN behavior on customer_id, 14 columns."""
    return profiles.join(behavior, "customer_id", "left").select(*DIM_CUSTOMER_COLUMNS)


def dim_device(devices: DataFrame) -> DataFrame:
    return devices.select(*DIM_DEVICE_COLUMNS)


def dim_location(towers: DataFrame) -> DataFrame:
    """Distinct tower rows."""
    return towers.select(*DIM_LOCATION_COLUMNS).distinct()


def date_series(start: Column, end: Column) -> Column:
    """One date per day from ``start`` to ``end`` inclusive (exploded)."""
    return F.explode(F.sequence(F.to_date(start), F.to_date(end), F.expr("INTERVAL 1 DAY")))


def dim_time(dates: DataFrame, col: str = "date_id") -> DataFrame:
    """Calendar attributes; weekend = Sunday or Saturday."""
    d = c(col)
    return dates.select(
        d.alias("date_id"), F.year(d).alias("year"), F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"), F.quarter(d).alias("quarter"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"))


def dim_time_between(spark: SparkSession, start: Column, end: Column) -> DataFrame:
    return dim_time(spark.range(1).select(date_series(start, end).alias("date_id")))


def dim_time_covering(df: DataFrame, ts_col: str) -> DataFrame:
    """Date dimension spanning the facts' own date range (bounds from one aggregate)."""
    bounds = df.agg(F.min(ts_col).alias("lo"), F.max(ts_col).alias("hi"))
    return dim_time(bounds.select(date_series(c("lo"), c("hi")).alias("date_id")))


def fact(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared names, types and order; missing columns NULL."""
    have = set(df.columns)
    return df.select(*[
        (c(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def build(t: Tables) -> dict[str, DataFrame]:
    """The ten wide warehouse tables (reference column sets)."""
    return {
        "dim_customer": dim_customer(fx.profiles(t), fx.behavior(t)),
        "dim_device": dim_device(fx.devices(t)),
        "dim_location": dim_location(fx.towers(t)),
        "dim_time": dim_time_covering(t.orders, "o_orderdate"),
        "fact_cdr": fact(fx.cdr(t), FACT_CDR_COLUMNS),
        "fact_payments": fact(fx.billing(t), FACT_PAYMENTS_COLUMNS),
        "fact_complaints": fact(fx.complaint_scores(t), FACT_COMPLAINTS_COLUMNS),
        "fact_internet_usage": fact(fx.internet_usage(t), FACT_INTERNET_COLUMNS),
        "fact_network_metrics": fact(fx.network_metrics(t), FACT_NETWORK_COLUMNS),
        "fact_security": fact(fx.security_profile(t), FACT_SECURITY_COLUMNS),
    }


def build_conformed(t: Tables) -> dict[str, DataFrame]:
    """The declared (narrow) views of the ten tables."""
    return {name: conform(df, WAREHOUSE[name]) for name, df in build(t).items()}


def load(tables: dict[str, DataFrame], base: str, fmt: str = "parquet") -> dict[str, str]:
    """Truncate-and-reload every table with one distributed write each."""
    paths = {}
    for name, df in tables.items():
        path = f"{base.rstrip('/')}/{name}"
        df.write.mode("overwrite").format(fmt).save(path)
        paths[name] = path
    return paths


def verify_counts(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """Row count of every written table, read back from storage."""
    parts = [spark.read.format(fmt).load(p).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count") for name, p in paths.items()]
    return reduce(DataFrame.unionByName, parts)
