"""Registered queries: fraud rules (R01-R20) and serving panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import latest_ts
from ..operators.detect import detect, detect_all
from ..operators.rules import RULES_BY_ID
from ..sources import fixtures as fx
from ..sources.tables import Tables
from . import panels
from .catalog import register

# --------------------------------------------------------------- rules --

# Oracle predicates (relaxed profile), written as plain SQL.
RULE_SQL = {
    "r01": ("cdr", "'N/A'", "monthly_call_duration",
            "monthly_call_duration > 200 AND monthly_call_count > 100 AND sms_usage_per_month < 20 "
            "AND CAST(call_drop_count AS DOUBLE) / NULLIF(monthly_call_count, 0) > 0.10 "
            "AND ((hour(event_ts) BETWEEN 2 AND 6) "
            "OR international_call_duration / NULLIF(monthly_call_duration, 0) > 0.3)"),
    "r02": ("cdr", "'N/A'", "monthly_call_duration",
            "monthly_call_count > 50 AND monthly_call_duration / NULLIF(monthly_call_count, 0) < 1.0 "
            "AND monthly_call_duration < 80 AND international_call_duration > 3"),
    "r03": ("cdr", "'International'", "international_call_duration",
            "international_call_duration > 50 "
            "AND international_call_duration / NULLIF(monthly_call_duration, 0) > 0.4 "
            "AND monthly_call_duration > 100 AND monthly_call_count < 150"),
    "r04": ("cdr", "'N/A'", "monthly_call_count",
            "monthly_call_count > 150 AND monthly_call_duration / NULLIF(monthly_call_count, 0) < 3 "
            "AND international_call_duration / NULLIF(monthly_call_duration, 0) < 0.3"),
    "r05": ("sdr", "'N/A'", "ss7_requests",
            "(ss7_requests > 40 OR failed_auth_attempts > 3) AND (diameter_messages > 25 OR location_updates > 15)"),
    "r06": ("sdr", "'N/A'", "imsi_changes",
            "imsi_changes >= 1 AND (failed_auth_attempts > 2 OR location_updates > 40 OR ss7_requests > 50)"),
    "r07": ("payments", "'N/A'", "abs(wallet_balance)",
            "wallet_balance < -20 AND (monthly_recharge_amount > 150 OR failed_payment_attempts > 2)"),
    "r08": ("payments", "'N/A'", "vas_spending",
            "vas_spending > 75 AND (vas_spending / (monthly_recharge_amount + 0.01) > 0.5 "
            "OR (monthly_recharge_amount < 75 AND vas_spending > 50))"),
    "r09": ("payments", "'N/A'", "failed_payment_attempts",
            "failed_payment_attempts > 5 AND monthly_recharge_amount < 100"),
    "r10": ("location", "cell_tower_id", "distance_traveled_km",
            "distance_traveled_km > 150 AND location_update_count < 10"),
    "r11": ("location", "cell_tower_id", "location_update_count",
            "location_update_count > 40 AND distance_traveled_km > 50"),
    "r12": ("network", "'N/A'", "data_usage_gb",
            "(data_usage_gb > 40 OR upload_gb > 20) "
            "AND (upload_gb / (download_gb + 0.01) > 0.3 OR download_gb > 75)"),
    "r13": ("network", "'N/A'", "packet_loss_pct",
            "packet_loss_pct > 15 AND average_latency_ms > 400 AND upload_gb > 20"),
    "r14": ("security", "'N/A'", "failed_login_attempts",
            "(failed_login_attempts > 3 OR (password_changes >= 1 AND account_changes >= 2)) "
            "AND (suspicious_ips > 0 OR hour(event_ts) BETWEEN 1 AND 6)"),
    "r15": ("security", "'N/A'", "api_abuse_count",
            "(api_abuse_count > 80 OR suspicious_ips > 3) AND (failed_login_attempts > 1 OR account_changes > 0)"),
    "r16": ("service", "'Premium Services'", "premium_calls_min",
            "(premium_sms_count > 35 OR premium_calls_min > 80) "
            "AND (international_sms > 10 OR subscription_services > 5)"),
    "r17": ("service", "'VAS Services'", "roaming_charges",
            "subscription_services > 8 AND (roaming_charges > 150 OR premium_sms_count > 20)"),
    "r18": ("billing", "'N/A'", "monthly_spending",
            "monthly_spending > 400 AND credit_score < 550 AND avg_payment_delay > 5"),
    "r19": ("billing", "'N/A'", "monthly_spending", "monthly_spending > credit_limit"),
}


def rule_select_sql(rid: str) -> str:
    view, recv, value, pred = RULE_SQL[rid]
    alert_type = RULES_BY_ID[rid].alert_type.replace("'", "''")
    return (f"SELECT customer_id AS call_id, customer_id AS caller_number, {recv} AS receiver_number, "
            f"CAST({value} AS DOUBLE) AS duration_min, date_trunc('second', event_ts) AS timestamp, "
            f"'{alert_type}' AS alert_type, '{rid}' AS rule_id FROM {view} WHERE {pred}")


def _rule_query(rid: str):
    stream = RULES_BY_ID[rid].stream

    def run(spark, sf_dir):
        t = Tables(spark, sf_dir)
        return detect(fx.stream(t, stream), stream, "relaxed", rule_ids=[rid])
    run.__doc__ = f"{RULES_BY_ID[rid].alert_type} (relaxed thresholds)"
    return run


for _rid, (_view, *_rest) in RULE_SQL.items():
    register(_rid, rule_select_sql(_rid), views=(_view,))(_rule_query(_rid))


@register("r20", "\nUNION ALL\n".join(rule_select_sql(f"r{i:02d}") for i in range(1, 18)),
          views=fx.EVENT_STREAMS)
def r20_all_alerts(spark, sf_dir):
    """All alerts of the 17 event rules over the 7 streams, one pass per stream."""
    t = Tables(spark, sf_dir)
    return detect_all({s: fx.stream(t, s) for s in fx.EVENT_STREAMS}, "relaxed")


@register("s04_strict_counts", """
SELECT rule_id, CAST(count(*) AS BIGINT) AS alerts FROM (
  SELECT 'r01' AS rule_id FROM cdr WHERE monthly_call_duration > 800 AND monthly_call_count > 400
    AND sms_usage_per_month < 10 AND CAST(call_drop_count AS DOUBLE) / NULLIF(monthly_call_count, 0) > 0.15
    AND ((hour(event_ts) BETWEEN 2 AND 6) OR international_call_duration / NULLIF(monthly_call_duration, 0) > 0.5)
  UNION ALL SELECT 'r02' FROM cdr WHERE monthly_call_count > 80
    AND monthly_call_duration / NULLIF(monthly_call_count, 0) < 0.5 AND monthly_call_duration < 50
    AND international_call_duration > 5
  UNION ALL SELECT 'r03' FROM cdr WHERE international_call_duration > 150
    AND international_call_duration / NULLIF(monthly_call_duration, 0) > 0.6 AND monthly_call_duration > 200
    AND monthly_call_count < 100
  UNION ALL SELECT 'r04' FROM cdr WHERE monthly_call_count > 300
    AND monthly_call_duration / NULLIF(monthly_call_count, 0) < 2
    AND international_call_duration / NULLIF(monthly_call_duration, 0) < 0.2
  UNION ALL SELECT 'r05' FROM sdr WHERE (ss7_requests > 80 OR failed_auth_attempts > 5)
    AND (diameter_messages > 50 OR location_updates > 30)
  UNION ALL SELECT 'r07' FROM payments WHERE wallet_balance < -50
    AND (monthly_recharge_amount > 300 OR failed_payment_attempts > 3)
  UNION ALL SELECT 'r08' FROM payments WHERE vas_spending > 150
    AND (vas_spending / (monthly_recharge_amount + 0.01) > 0.7 OR (monthly_recharge_amount < 50 AND vas_spending > 100))
  UNION ALL SELECT 'r10' FROM location WHERE distance_traveled_km > 300 AND location_update_count < 8
  UNION ALL SELECT 'r11' FROM location WHERE location_update_count > 80 AND distance_traveled_km > 100
  UNION ALL SELECT 'r12' FROM network WHERE (data_usage_gb > 80 OR upload_gb > 40)
    AND (upload_gb / (download_gb + 0.01) > 0.4 OR download_gb > 150)
) GROUP BY rule_id""", views=("cdr", "sdr", "payments", "location", "network"))
def s04_strict_counts(spark, sf_dir):
    """Profile switch: alert counts per rule under the strict thresholds (rules that differ)."""
    t = Tables(spark, sf_dir)
    differing = ["r01", "r02", "r03", "r04", "r05", "r07", "r08", "r10", "r11", "r12"]
    alerts = detect_all({s: fx.stream(t, s) for s in ("cdr", "sdr", "payments", "location", "network")},
                        "strict")
    return (alerts.filter(F.col("rule_id").isin(differing)).groupBy("rule_id")
            .agg(F.count(F.lit(1)).alias("alerts")))


# -------------------------------------------------------------- panels --

ASOF = "(SELECT max(timestamp) FROM alerts)"


def _w(interval: str) -> str:
    return f"timestamp >= {ASOF} - INTERVAL {interval}"


PANEL_SQL = {
    "q01": f"""SELECT date_trunc('minute', timestamp) AS time, alert_type, count(*) AS count
        FROM alerts WHERE {_w('1 HOUR')} GROUP BY 1, 2""",
    "q02": f"SELECT count(*) AS alerts_last_hour FROM alerts WHERE {_w('1 HOUR')}",
    "q03": f"SELECT alert_type, count(*) AS count FROM alerts WHERE {_w('24 HOUR')} GROUP BY 1",
    "q04": f"""WITH d AS (SELECT caller_number, alert_type, count(*) AS n FROM alerts
                          WHERE {_w('24 HOUR')} GROUP BY 1, 2)
        SELECT caller_number, CAST(sum(n) AS BIGINT) AS alert_count,
               string_agg(alert_type || ' x' || CAST(n AS VARCHAR), '; '
                          ORDER BY alert_type || ' x' || CAST(n AS VARCHAR)) AS fraud_types
        FROM d GROUP BY 1 ORDER BY alert_count DESC, caller_number LIMIT 10""",
    "q05": """SELECT timestamp, caller_number, alert_type, duration_min FROM alerts
        ORDER BY timestamp DESC, call_id DESC LIMIT 100""",
    "q06": f"SELECT round(sum(duration_min * 0.05), 4) AS blocked_value FROM alerts WHERE {_w('24 HOUR')}",
    "q07": f"""SELECT round(CAST(count(*) FILTER (WHERE {_w('1 HOUR')}) AS DOUBLE) * 100
                     / NULLIF(count(*), 0), 4) AS success_rate
        FROM alerts WHERE {_w('24 HOUR')}""",
    "q08": f"""SELECT date_trunc('hour', timestamp) AS time, round(sum(duration_min * 0.05), 4) AS value
        FROM alerts WHERE {_w('24 HOUR')} GROUP BY 1""",
    "q09": f"""SELECT alert_type, round(sum(duration_min * 0.05), 4) AS fraud_value FROM alerts
        WHERE {_w('24 HOUR')} GROUP BY 1 ORDER BY fraud_value DESC, alert_type LIMIT 10""",
    "q10": f"""SELECT caller_number, count(*) AS fraud_count, round(sum(duration_min * 0.05), 4) AS total_value,
               max(timestamp) AS last_seen
        FROM alerts WHERE {_w('24 HOUR')} GROUP BY 1 ORDER BY total_value DESC, caller_number LIMIT 15""",
    "q11": f"SELECT date_diff('second', max(timestamp), {ASOF}) AS data_freshness FROM alerts",
    "q12": f"""SELECT date_trunc('minute', timestamp) AS time, count(*) AS alerts_per_minute
        FROM alerts WHERE {_w('1 HOUR')} GROUP BY 1""",
    "q13": f"""WITH a AS (SELECT CAST(date_diff('second', timestamp, {ASOF}) AS DOUBLE) AS age
                          FROM alerts WHERE {_w('1 HOUR')})
        SELECT 'P50 (Median)' AS metric, round(quantile_cont(age, 0.50), 4) AS value_sec FROM a
        UNION ALL SELECT 'P95', round(quantile_cont(age, 0.95), 4) FROM a
        UNION ALL SELECT 'P99', round(quantile_cont(age, 0.99), 4) FROM a""",
    "q14": f"""SELECT date_trunc('minute', timestamp) AS time, count(DISTINCT caller_number) AS unique_users,
               count(*) AS total_alerts FROM alerts WHERE {_w('6 HOUR')} GROUP BY 1""",
    "q15": f"""SELECT count(*) AS total_alerts, count(DISTINCT caller_number) AS unique_fraudsters,
               count(DISTINCT alert_type) AS fraud_types, round(sum(duration_min), 4) AS total_minutes
        FROM alerts WHERE {_w('24 HOUR')}""",
    "q16": f"""SELECT CAST(hour(timestamp) AS INTEGER) AS hour, CAST(isodow(timestamp) AS INTEGER) AS day,
               count(*) AS fraud_count FROM alerts WHERE {_w('7 DAY')} GROUP BY 1, 2""",
    "q17": f"""WITH d AS (SELECT * FROM alerts WHERE {_w('24 HOUR')} AND receiver_number <> 'N/A')
        SELECT receiver_number, count(*) AS call_count, count(DISTINCT caller_number) AS unique_callers,
               string_agg(DISTINCT alert_type, '; ' ORDER BY alert_type) AS fraud_types
        FROM d GROUP BY 1 ORDER BY call_count DESC, receiver_number LIMIT 15""",
    "q18": f"""SELECT split_part(alert_type, '/', 1) AS fraud_pattern, count(*) AS count FROM alerts
        WHERE {_w('24 HOUR')} GROUP BY 1 ORDER BY count DESC, fraud_pattern LIMIT 10""",
    "q19": f"""SELECT date_trunc('hour', timestamp) AS time, alert_type, count(*) AS count FROM alerts
        WHERE {_w('24 HOUR')} GROUP BY 1, 2""",
    "q20": f"""SELECT alert_type, count(*) AS total_cases, round(avg(duration_min), 4) AS avg_duration,
               min(timestamp) AS first_seen, max(timestamp) AS last_seen
        FROM alerts WHERE {_w('7 DAY')} GROUP BY 1""",
    "a05": """SELECT (SELECT count(*) FROM alerts) AS total_alerts, timestamp, caller_number, alert_type,
               duration_min FROM alerts ORDER BY timestamp DESC, call_id DESC LIMIT 5""",
    "a06": f"""SELECT CAST(hour(timestamp) AS INTEGER) AS hour,
               count(*) FILTER (WHERE CAST(timestamp AS DATE) = CAST({ASOF} AS DATE)) AS today,
               count(*) FILTER (WHERE CAST(timestamp AS DATE) = CAST({ASOF} AS DATE) - 1) AS yesterday
        FROM alerts WHERE {_w('48 HOUR')} GROUP BY 1""",
    "a07": f"""SELECT count(*) FILTER (WHERE alert_type <> '') AS fraud_detected, count(*) AS total_calls,
               round(CAST(count(*) FILTER (WHERE alert_type <> '') AS DOUBLE) * 100 / NULLIF(count(*), 0), 4)
                 AS prevention_rate
        FROM alerts WHERE {_w('1 HOUR')}""",
}


def _panel_query(qid: str):
    fn = panels.PANELS[qid]

    def run(spark, sf_dir):
        alerts = fx.alerts(Tables(spark, sf_dir))
        return fn(alerts, latest_ts(alerts))
    run.__doc__ = fn.__doc__ or fn.__name__
    return run


for _qid, _sql in PANEL_SQL.items():
    register(_qid, _sql, views=("alerts",))(_panel_query(_qid))


# ------------------------------------------------------- time predicates --

@register("p02", """
SELECT customer_id, event_ts, CAST(hour(event_ts) AS INTEGER) AS hour_of_day,
       CAST(dayofweek(event_ts) + 1 AS INTEGER) AS day_of_week, CAST(isodow(event_ts) AS INTEGER) AS weekday_mon1
FROM security""", views=("security",))
def p02_time_parts(spark, sf_dir):
    """Derived time parts: hour, day of week (Sunday = 1) and weekday (Monday = 1)."""
    from ..functions.exprs import weekday_mon1
    s = fx.security(Tables(spark, sf_dir))
    return s.select("customer_id", "event_ts", F.hour("event_ts").alias("hour_of_day"),
                    F.dayofweek("event_ts").alias("day_of_week"), weekday_mon1("event_ts").alias("weekday_mon1"))


@register("p08", """
SELECT customer_id, event_ts, hour(event_ts) BETWEEN 2 AND 6 AS night_2_6,
       hour(event_ts) BETWEEN 1 AND 6 AS night_1_6, hour(event_ts) >= 22 OR hour(event_ts) <= 6 AS night_22_6
FROM security""", views=("security",))
def p08_night_predicates(spark, sf_dir):
    """Inclusive night-hour predicates 2-6 and 1-6, and the wrap-around 22-6."""
    from ..operators.rules import hour_between
    s = fx.security(Tables(spark, sf_dir))
    return s.select("customer_id", "event_ts", hour_between(2, 6).alias("night_2_6"),
                    hour_between(1, 6).alias("night_1_6"), hour_between(22, 6).alias("night_22_6"))
