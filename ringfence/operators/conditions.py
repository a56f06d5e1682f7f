"""Alert conditions, classification and actions.

Conditions are tumbling-window counts, gap detection and threshold checks
over panel metrics; classification tables (severity policy, pattern ->
action, taxonomy) are fixed reference tables joined by broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.exprs import pattern_prefix, severity
from .sequences import epoch_seconds

c = F.col


def burst_windows(alerts: DataFrame, minutes: int = 5, threshold: int = 100,
                  alert_type_prefix: str | None = None) -> DataFrame:
    """Alert counts per tumbling window, fired above ``threshold``."""
    df = alerts if alert_type_prefix is None else alerts.filter(c("alert_type").startswith(alert_type_prefix))
    w = F.window(c("timestamp"), f"{minutes} minutes")
    g = df.groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("alerts"))
    return g.select(c("w.start").cast("timestamp_ntz").alias("window_start"),
                    c("w.end").cast("timestamp_ntz").alias("window_end"), "alerts",
                    (c("alerts") > threshold).alias("fired"))


#: Buckets of one level that share a partition of the next.
SPAN = 3600


def silence_gaps(alerts: DataFrame, seconds: int = 120, bucket_seconds: int = 3600) -> DataFrame:
    """L02 (batch): gaps longer than ``seconds`` between consecutive alerts.

    Alerts are reduced to the first and last time of each second in the map tasks.  Gaps
    inside a time bucket come from ``lead`` per bucket; those from a bucket's last alert to
    the next occupied bucket from a table of buckets (first and last alert), which is
    cut into spans of ``SPAN`` buckets in its turn, and these again: four levels, the
    last of which reaches over more years than a timestamp has.
    """
    second = F.floor(epoch_seconds("timestamp")).cast("long")
    now = (alerts.filter(c("timestamp").isNotNull()).groupBy(second.alias("k"))
           .agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("z")))
    found, width = None, bucket_seconds
    for _ in range(4):
        now = now.withColumn("g", F.floor(c("k") / width).cast("long"))
        pairs = now.select(c("z").alias("gap_start"), F.lead("a").over(Window.partitionBy("g").orderBy("k")).alias("gap_end"))
        found = pairs if found is None else found.unionByName(pairs)
        now = now.groupBy(c("g").alias("k")).agg(F.min("a").alias("a"), F.max("z").alias("z"))
        width = SPAN
    gap = F.floor(epoch_seconds("gap_end")) - F.floor(epoch_seconds("gap_start"))
    return found.withColumn("gap_seconds", gap.cast("long")).filter(c("gap_seconds") > seconds)


def latency_sla(latency: DataFrame, breach: float = 30.0, warn: float = 10.0) -> DataFrame:
    """P95 detection age against the SLA (over the Q13 output)."""
    p95 = latency.filter(c("metric") == "P95")
    status = F.when(c("value_sec") > breach, F.lit("BREACH")).when(c("value_sec") > warn, F.lit("WARN")) \
        .otherwise(F.lit("OK"))
    return p95.select("metric", "value_sec", status.alias("status"))


def threshold_checks(metrics: DataFrame) -> DataFrame:
    """Operational conditions over a one-row metrics table
    (value_24h, alerts_last_hour, freshness_sec, alerts_per_min)."""
    specs = [("value_24h_above_10000", c("value_24h"), c("value_24h") > 10000),
             ("alerts_per_hour_above_100", c("alerts_last_hour").cast("double"), c("alerts_last_hour") > 100),
             ("freshness_above_60s", c("freshness_sec").cast("double"), c("freshness_sec") > 60),
             ("rate_below_5_per_min", c("alerts_per_min"), c("alerts_per_min") < 5)]
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("condition"), v.cast("double").alias("value"),
                                        cond.alias("fired")) for n, v, cond in specs]))
    return metrics.select(rows.alias("x")).select("x.*")


def new_types(alerts: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """Alert types seen in the last ``hours`` but never before (anti join)."""
    cut = as_of - F.expr(f"INTERVAL {hours} HOURS")
    recent = alerts.filter(c("timestamp") >= cut).select("alert_type").distinct()
    earlier = alerts.filter(c("timestamp") < cut).select("alert_type").distinct()
    return recent.join(earlier, "alert_type", "left_anti")


# Panel colour thresholds (lower bound inclusive -> colour).
PANEL_THRESHOLDS = {
    "blocked_value": [(None, "green"), (1000, "yellow"), (5000, "red")],
    "success_rate": [(None, "red"), (70, "yellow"), (90, "green")],
    "alerts_last_hour": [(None, "green"), (10, "yellow"), (50, "red")],
    "data_freshness": [(None, "green"), (10, "yellow"), (60, "red")],
    "latency_p95": [(None, "green"), (5, "yellow"), (10, "orange"), (20, "red")],
}


def colour(metric: str, value: Column) -> Column:
    """Dashboard threshold colour of a value."""
    steps = PANEL_THRESHOLDS[metric]
    out = F.lit(steps[0][1])
    for lo, name in steps[1:]:
        out = F.when(value >= lo, F.lit(name)).otherwise(out)
    return out


# Severity label -> response policy.
SEVERITY_POLICY = [("Critical", "block"), ("High", "notify"), ("Medium", "monitor"), ("Low", "log")]


def severity_policy(alerts: DataFrame) -> DataFrame:
    """Severity from the bracketed label and its policy (block/notify/monitor/log)."""
    sev = severity("alert_type")
    level = F.when(sev.startswith("Critical"), F.lit("Critical")).when(sev.startswith("High"), F.lit("High")) \
        .when(sev.startswith("Medium"), F.lit("Medium")).otherwise(F.lit("Low"))
    pol = None
    for lvl, p in SEVERITY_POLICY:
        pol = F.when(level == lvl, F.lit(p)) if pol is None else pol.when(level == lvl, F.lit(p))
    return alerts.withColumn("severity", level).withColumn("policy", pol)


def action_records(alerts: DataFrame) -> DataFrame:
    """Action-topic record per alert: target id, reason, missing-id warning."""
    target = F.coalesce(c("caller_number"), c("call_id"))
    return alerts.select(target.alias("target_id"),
                         F.coalesce(c("alert_type"), F.lit("Unknown Fraud")).alias("reason"),
                         target.isNull().alias("missing_id"),
                         F.to_json(F.struct(*[c(n) for n in alerts.columns])).alias("payload"))


# Fraud coverage matrix (pattern, stream, detection, action).
ACTION_MATRIX = [
    ("SIM Box", "CDR", "High call volume", "Block immediately"),
    ("Wangiri", "CDR", "Short call pattern", "Block + investigate"),
    ("IRSF", "CDR", "International abuse", "Block int'l calls"),
    ("SS7 Attack", "SDR", "Signaling anomaly", "Security alert"),
    ("SIM Swap", "SDR", "IMSI changes", "Freeze account"),
    ("Credit Abuse", "Payments", "Negative balance", "Limit services"),
    ("VAS Fraud", "Payments", "Subscription abuse", "Cancel VAS"),
    ("Device Cloning", "Location", "Impossible travel", "Verify identity"),
    ("Roaming Fraud", "Location", "Excessive updates", "Limit roaming"),
    ("Data Abuse", "Network", "High data usage", "Throttle data"),
    ("DDoS", "Network", "Network attack", "Rate limit"),
    ("Account Takeover", "Security", "Failed logins", "Lock account"),
    ("API Abuse", "Security", "Bot attack", "Ban IP"),
    ("Premium Fraud", "Service Usage", "Premium abuse", "Block premium"),
    ("Subscription Fraud", "Service Usage", "Unauthorized subs", "Cancel all"),
]

# Alert-type prefix -> coverage-matrix pattern.
TYPE_TO_PATTERN = [
    ("SIM Box", "SIM Box"), ("Wangiri", "Wangiri"), ("IRSF", "IRSF"), ("SS7", "SS7 Attack"),
    ("SIM Swap", "SIM Swap"), ("Credit Abuse", "Credit Abuse"), ("VAS", "VAS Fraud"),
    ("Card Testing", "Credit Abuse"), ("Device Cloning", "Device Cloning"), ("Int'l Roaming", "Roaming Fraud"),
    ("Data Abuse", "Data Abuse"), ("DDoS", "DDoS"), ("Account Takeover", "Account Takeover"),
    ("API Abuse", "API Abuse"), ("Premium Rate", "Premium Fraud"), ("Unauthorized Subscription",
                                                                    "Subscription Fraud"),
    ("Call Volume", "Subscription Fraud"), ("Subscription Fraud", "Subscription Fraud"),
]


def pattern_of(alert_type: Column) -> Column:
    out = None
    for prefix, pat in TYPE_TO_PATTERN:
        cond = alert_type.startswith(prefix)
        out = F.when(cond, F.lit(pat)) if out is None else out.when(cond, F.lit(pat))
    return out


def action_matrix(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(ACTION_MATRIX, "pattern string, stream string, detection string, "
                                                            "action string"))


def with_actions(spark: SparkSession, alerts: DataFrame) -> DataFrame:
    """Join each alert with its pattern's action (bounded broadcast table)."""
    return alerts.withColumn("pattern", pattern_of(c("alert_type"))).join(action_matrix(spark), "pattern", "left")


# Taxonomy per pattern — victim, perpetrator, detection level.
TAXONOMY = [
    ("SIM Box", "Revenue", "External", 1), ("Wangiri", "Customer", "External", 1),
    ("IRSF", "Revenue", "External", 2), ("SS7 Attack", "Customer", "External", 3),
    ("SIM Swap", "Customer", "External", 2), ("Credit Abuse", "Revenue", "Subscriber", 1),
    ("VAS Fraud", "Third-Party", "External", 2), ("Device Cloning", "Customer", "External", 2),
    ("Roaming Fraud", "Revenue", "Subscriber", 2), ("Data Abuse", "Revenue", "Subscriber", 1),
    ("DDoS", "Revenue", "External", 2), ("Account Takeover", "Customer", "External", 2),
    ("API Abuse", "Customer", "External", 2), ("Premium Fraud", "Third-Party", "External", 1),
    ("Subscription Fraud", "Revenue", "Subscriber", 2),
]


def with_taxonomy(spark: SparkSession, alerts: DataFrame) -> DataFrame:
    """Victim / perpetrator / detection-difficulty dimensions per alert."""
    tax = F.broadcast(spark.createDataFrame(TAXONOMY, "pattern string, victim string, perpetrator string, "
                                                      "difficulty_level int"))
    return alerts.withColumn("pattern", pattern_of(c("alert_type"))).join(tax, "pattern", "left")


def with_planned_columns(alerts: DataFrame, rate: float = 0.05, detection_ts: Column | None = None) -> DataFrame:
    """fraud_value_estimate, detection_timestamp (default now) and action_taken='PENDING'."""
    return (alerts.withColumn("fraud_value_estimate", c("duration_min") * rate)
            .withColumn("detection_timestamp", detection_ts if detection_ts is not None else F.current_timestamp())
            .withColumn("action_taken", F.lit("PENDING")))


def type_lifecycle(pattern_stats: DataFrame, as_of: Column, stopped_days: int = 5) -> DataFrame:
    """Emerging (first seen on the as-of day) / stopped (not seen for N days) / active."""
    day = F.to_date(as_of)
    state = (F.when(F.to_date("first_seen") == day, F.lit("emerging"))
             .when(F.datediff(day, F.to_date("last_seen")) >= stopped_days, F.lit("stopped"))
             .otherwise(F.lit("active")))
    return pattern_stats.select("alert_type", "first_seen", "last_seen", state.alias("lifecycle"))


def pattern_counts(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy(pattern_prefix("alert_type").alias("fraud_pattern")).count()


def union_all(dfs: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)
