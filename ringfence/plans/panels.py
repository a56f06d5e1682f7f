"""The serving queries (dashboard panels Q01-Q20 and the alert monitor A05).

Each panel is ``f(alerts, as_of) -> DataFrame`` over the alert table
(``call_id, caller_number, receiver_number, duration_min, timestamp,
alert_type``).  ``as_of`` replaces ``now()``: pass ``F.current_timestamp()``
(or a literal) in production; tests pass the latest alert time as a scalar
subquery so results are reproducible.

Scale notes: every panel is a rolling-window filter (pushed into the scan
when ``as_of`` is a literal and the table is date partitioned) followed by a
partial/final hash aggregate on a small key.  List-valued columns are built
from a pre-aggregate per (key, alert_type), so a caller or receiver holding a
third of all alerts still yields a list bounded by the number of alert types,
never a list of all its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exprs import (hour_of, minute_of, pattern_prefix, r, seconds_between,
                               since, weekday_mon1)

c = F.col
VALUE_RATE = 0.05  # fixed value: estimated $ per alert minute


def _value() -> Column:
    return c("duration_min") * VALUE_RATE


def window(alerts: DataFrame, as_of: Column, interval: str) -> DataFrame:
    return alerts.filter(since(as_of, "timestamp", interval))


def q01_alerts_per_minute_by_type(alerts, as_of):
    return (window(alerts, as_of, "1 HOUR")
            .groupBy(minute_of("timestamp").alias("time"), "alert_type")
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy("time", "alert_type"))


def q02_total_last_hour(alerts, as_of):
    return window(alerts, as_of, "1 HOUR").agg(F.count(F.lit(1)).alias("alerts_last_hour"))


def q03_alerts_by_type(alerts, as_of):
    return (window(alerts, as_of, "24 HOURS").groupBy("alert_type")
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "alert_type"))


def _typed_counts(df: DataFrame, key: str) -> DataFrame:
    """Pre-aggregate per (key, alert_type): bounded rows per key."""
    return df.groupBy(key, "alert_type").agg(F.count(F.lit(1)).alias("n"))


def q04_top_callers(alerts, as_of, k: int = 10):
    """Top callers with their alert types as a multiset ``type xN``, sorted."""
    per_type = _typed_counts(window(alerts, as_of, "24 HOURS"), "caller_number")
    return (per_type.groupBy("caller_number")
            .agg(F.sum("n").alias("alert_count"),
                 F.array_join(F.sort_array(F.collect_list(
                     F.concat(c("alert_type"), F.lit(" x"), c("n").cast("string")))), "; ").alias("fraud_types"))
            .orderBy(F.desc("alert_count"), "caller_number").limit(k))


def q05_latest_alerts(alerts, as_of, k: int = 100):
    return (alerts.orderBy(F.desc("timestamp"), F.desc("call_id")).limit(k)
            .select("timestamp", "caller_number", "alert_type", "duration_min"))


def q06_value_blocked(alerts, as_of):
    return window(alerts, as_of, "24 HOURS").agg(r(F.sum(_value())).alias("blocked_value"))


def q07_last_hour_share(alerts, as_of):
    """1 h count as % of the 24 h count, one scan (conditional count)."""
    day = window(alerts, as_of, "24 HOURS")
    return day.agg(r(F.try_divide(F.count_if(since(as_of, "timestamp", "1 HOUR")) * 100.0,
                                  F.count(F.lit(1)).cast("double"))).alias("success_rate"))


def q08_value_per_hour(alerts, as_of):
    return (window(alerts, as_of, "24 HOURS").groupBy(hour_of("timestamp").alias("time"))
            .agg(r(F.sum(_value())).alias("value")).orderBy("time"))


def q09_top_types_by_value(alerts, as_of, k: int = 10):
    return (window(alerts, as_of, "24 HOURS").groupBy("alert_type")
            .agg(r(F.sum(_value())).alias("fraud_value"))
            .orderBy(F.desc("fraud_value"), "alert_type").limit(k))


def q10_top_fraudsters_by_value(alerts, as_of, k: int = 15):
    return (window(alerts, as_of, "24 HOURS").groupBy("caller_number")
            .agg(F.count(F.lit(1)).alias("fraud_count"), r(F.sum(_value())).alias("total_value"),
                 F.max("timestamp").alias("last_seen"))
            .orderBy(F.desc("total_value"), "caller_number").limit(k))


def q11_data_freshness(alerts, as_of):
    return alerts.agg(seconds_between(F.max("timestamp"), as_of).alias("data_freshness"))


def q12_alerts_per_minute(alerts, as_of):
    return (window(alerts, as_of, "1 HOUR").groupBy(minute_of("timestamp").alias("time"))
            .agg(F.count(F.lit(1)).alias("alerts_per_minute")).orderBy("time"))


# Latency metric labels.
LATENCY_METRICS = [("P50 (Median)", 0.50), ("P95", 0.95), ("P99", 0.99)]


def q13_detection_latency(alerts, as_of):
    """P50/P95/P99 age in seconds, one scan (exact, interpolated percentiles)."""
    age = seconds_between("timestamp", as_of).cast("double")
    pct = (window(alerts, as_of, "1 HOUR")
           .agg(F.percentile(age, [p for _, p in LATENCY_METRICS]).alias("p")))
    labels = F.array(*[F.lit(m) for m, _ in LATENCY_METRICS])
    return (pct.select(F.posexplode(labels).alias("i", "metric"), "p")
            .select("metric", r(F.element_at("p", c("i") + 1)).alias("value_sec")))


def q14_activity_per_minute(alerts, as_of):
    return (window(alerts, as_of, "6 HOURS").groupBy(minute_of("timestamp").alias("time"))
            .agg(F.count_distinct("caller_number").alias("unique_users"),
                 F.count(F.lit(1)).alias("total_alerts")).orderBy("time"))


def q15_daily_summary(alerts, as_of):
    return window(alerts, as_of, "24 HOURS").agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.count_distinct("caller_number").alias("unique_fraudsters"),
        F.count_distinct("alert_type").alias("fraud_types"),
        r(F.sum("duration_min")).alias("total_minutes"))


def q16_heatmap(alerts, as_of):
    return (window(alerts, as_of, "7 DAYS")
            .groupBy(F.hour("timestamp").alias("hour"), weekday_mon1("timestamp").alias("day"))
            .agg(F.count(F.lit(1)).alias("fraud_count")).orderBy("day", "hour"))


def q17_top_receivers(alerts, as_of, k: int = 15):
    day = window(alerts, as_of, "24 HOURS").filter(c("receiver_number") != "N/A")
    counts = day.groupBy("receiver_number").agg(
        F.count(F.lit(1)).alias("call_count"),
        F.count_distinct("caller_number").alias("unique_callers"))
    types = (day.select("receiver_number", "alert_type").distinct()
             .groupBy("receiver_number")
             .agg(F.array_join(F.sort_array(F.collect_list("alert_type")), "; ").alias("fraud_types")))
    top = counts.orderBy(F.desc("call_count"), "receiver_number").limit(k)
    return (top.join(types, "receiver_number", "left")
            .select("receiver_number", "call_count", "unique_callers", "fraud_types")
            .orderBy(F.desc("call_count"), "receiver_number"))


def q18_pattern_breakdown(alerts, as_of, k: int = 10):
    return (window(alerts, as_of, "24 HOURS").groupBy(pattern_prefix("alert_type").alias("fraud_pattern"))
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "fraud_pattern").limit(k))


def q19_hourly_type_trend(alerts, as_of):
    return (window(alerts, as_of, "24 HOURS")
            .groupBy(hour_of("timestamp").alias("time"), "alert_type")
            .agg(F.count(F.lit(1)).alias("count")).orderBy("time", "alert_type"))


def q20_pattern_analytics(alerts, as_of):
    return (window(alerts, as_of, "7 DAYS").groupBy("alert_type")
            .agg(F.count(F.lit(1)).alias("total_cases"), r(F.avg("duration_min")).alias("avg_duration"),
                 F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen"))
            .orderBy(F.desc("total_cases"), "alert_type"))


def a05_latest_with_total(alerts, as_of, k: int = 5):
    """Alert monitor: total count next to the latest ``k`` alerts."""
    total = alerts.agg(F.count(F.lit(1))).scalar()
    return (alerts.orderBy(F.desc("timestamp"), F.desc("call_id")).limit(k)
            .select(total.alias("total_alerts"), "timestamp", "caller_number", "alert_type",
                    "duration_min"))


def a06_today_vs_yesterday(alerts, as_of):
    """Per hour of day: alerts on the as_of day and on the day before (48 h)."""
    day = F.to_date(as_of)
    d = F.to_date("timestamp")
    return (window(alerts, as_of, "48 HOURS").groupBy(F.hour("timestamp").alias("hour"))
            .agg(F.count_if(d == day).alias("today"),
                 F.count_if(d == F.date_sub(day, 1)).alias("yesterday"))
            .orderBy("hour"))


def a07_prevention_rate(alerts, as_of):
    h = window(alerts, as_of, "1 HOUR")
    return h.agg(F.count_if(c("alert_type") != "").alias("fraud_detected"),
                 F.count(F.lit(1)).alias("total_calls"),
                 r(F.try_divide(F.count_if(c("alert_type") != "") * 100.0,
                                F.count(F.lit(1)).cast("double"))).alias("prevention_rate"))


def a08_daily_fraud_metrics(alerts_ext: DataFrame):
    """Daily ``fraud_metrics`` table: count, value, response time, active-minute share."""
    resp = seconds_between("timestamp", "detection_timestamp").cast("double")
    return (alerts_ext.groupBy(F.to_date("timestamp").alias("metric_date"))
            .agg(F.count(F.lit(1)).alias("total_fraud_blocked"),
                 r(F.sum("fraud_value_estimate")).alias("total_value_blocked"),
                 r(F.avg(resp)).alias("avg_response_time_sec"),
                 r(F.count_distinct(minute_of("timestamp")) * 100.0 / 1440).alias("system_uptime_pct"))
            .orderBy("metric_date"))


PANELS = {
    "q01": q01_alerts_per_minute_by_type, "q02": q02_total_last_hour, "q03": q03_alerts_by_type,
    "q04": q04_top_callers, "q05": q05_latest_alerts, "q06": q06_value_blocked,
    "q07": q07_last_hour_share, "q08": q08_value_per_hour, "q09": q09_top_types_by_value,
    "q10": q10_top_fraudsters_by_value, "q11": q11_data_freshness, "q12": q12_alerts_per_minute,
    "q13": q13_detection_latency, "q14": q14_activity_per_minute, "q15": q15_daily_summary,
    "q16": q16_heatmap, "q17": q17_top_receivers, "q18": q18_pattern_breakdown,
    "q19": q19_hourly_type_trend, "q20": q20_pattern_analytics,
    "a05": a05_latest_with_total, "a06": a06_today_vs_yesterday, "a07": a07_prevention_rate,
}
