"""DuckDB SQL for the fixture projections, used by the oracle queries.

These are written independently of the Spark projections in
``sources/fixtures.py`` (plain SQL over the pre-registered driver views), so
that the oracle checks the Spark code rather than re-running it.
"""

from __future__ import annotations

import re

VIEWS = {
    "cdr": """
SELECT CAST(l_orderkey AS VARCHAR) AS customer_id,
       CAST((l_partkey*17 + l_orderkey) % 600 AS INTEGER) AS monthly_call_count,
       CAST((l_orderkey*31 + l_partkey*7) % 10000 AS DOUBLE) / 10 AS monthly_call_duration,
       CAST((l_orderkey*13 + l_suppkey*7) % 5000 AS DOUBLE) / 10 AS international_call_duration,
       CAST((l_orderkey + l_linenumber*11) % 90 AS INTEGER) AS call_drop_count,
       CAST((l_partkey*3 + l_linenumber) % 60 AS INTEGER) AS sms_usage_per_month,
       l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS event_ts
FROM lineitem""",
    "sdr": """
SELECT CAST(o_custkey AS VARCHAR) AS customer_id,
       CAST((o_orderkey*7) % 100 AS INTEGER) AS ss7_requests,
       CAST((o_orderkey*3 + o_custkey) % 60 AS INTEGER) AS diameter_messages,
       CAST(o_custkey % 8 AS INTEGER) AS failed_auth_attempts,
       CAST((o_orderkey + o_custkey*5) % 80 AS INTEGER) AS location_updates,
       CAST(CASE WHEN o_orderkey % 10 = 0 THEN 1 + o_custkey % 3 ELSE 0 END AS INTEGER) AS imsi_changes,
       o_orderdate AS event_ts
FROM orders""",
    "payments": """
SELECT CAST(o_custkey AS VARCHAR) AS customer_id,
       CAST(o_orderkey % 400 - 100 AS DOUBLE) AS wallet_balance,
       CAST((o_custkey*7 + o_orderkey) % 400 AS DOUBLE) AS monthly_recharge_amount,
       CAST(o_orderkey % 9 AS INTEGER) AS failed_payment_attempts,
       CAST((o_orderkey*11 + o_custkey) % 250 AS DOUBLE) AS vas_spending,
       o_orderdate AS event_ts
FROM orders""",
    "location": """
SELECT CAST(user_id AS VARCHAR) AS customer_id,
       CAST((event_id*37) % 180 - 90 AS DOUBLE) AS latitude,
       CAST((event_id*91) % 360 - 180 AS DOUBLE) AS longitude,
       'T' || CAST(event_id % 50 AS VARCHAR) AS cell_tower_id,
       CAST((event_id*7) % 90 AS INTEGER) AS location_update_count,
       value * 2 AS distance_traveled_km,
       ts AS event_ts
FROM events""",
    "network": """
SELECT CAST(l_orderkey AS VARCHAR) AS customer_id,
       CAST(l_orderkey % 120 AS DOUBLE) AS data_usage_gb,
       CAST(l_partkey % 50 AS DOUBLE) AS upload_gb,
       CAST((l_partkey*3 + l_orderkey) % 200 AS DOUBLE) AS download_gb,
       CAST((l_orderkey*3 + l_suppkey*10) % 700 AS DOUBLE) AS average_latency_ms,
       CAST((l_suppkey + l_orderkey) % 30 AS DOUBLE) AS packet_loss_pct,
       l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS event_ts
FROM lineitem""",
    "security": """
SELECT CAST(user_id AS VARCHAR) AS customer_id,
       CAST(event_id % 7 AS INTEGER) AS failed_login_attempts,
       CAST(user_id % 3 AS INTEGER) AS password_changes,
       CAST((event_id // 7) % 6 AS INTEGER) AS suspicious_ips,
       CAST((event_id*3 + user_id) % 140 AS INTEGER) AS api_abuse_count,
       CAST((event_id // 3) % 4 AS INTEGER) AS account_changes,
       ts AS event_ts
FROM events""",
    "service": """
SELECT CAST(o_custkey AS VARCHAR) AS customer_id,
       CAST(o_orderkey % 60 AS INTEGER) AS premium_sms_count,
       CAST((o_orderkey*7 + o_custkey) % 150 AS DOUBLE) AS premium_calls_min,
       CAST(o_custkey % 14 AS INTEGER) AS subscription_services,
       CAST((o_orderkey*3 + o_custkey) % 300 AS DOUBLE) AS roaming_charges,
       CAST((o_orderkey // 5) % 25 AS INTEGER) AS international_sms,
       o_orderdate AS event_ts
FROM orders""",
    "alerts": """
SELECT CAST(event_id AS VARCHAR) AS call_id,
       CAST(user_id AS VARCHAR) AS caller_number,
       CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) % 3 = 0 THEN 'N/A'
            ELSE 'R' || CAST(CAST(json_extract(props, '$.k') AS INTEGER) % 20 AS VARCHAR) END AS receiver_number,
       value AS duration_min,
       date_trunc('second', ts) AS timestamp,
       CASE event_type
         WHEN 'click' THEN 'Wangiri (One Ring Scam) [Medium Confidence]'
         WHEN 'error' THEN 'SIM Box / Gateway Bypass [High Confidence]'
         WHEN 'purchase' THEN 'Credit Abuse / Payment Fraud [High Risk]'
         WHEN 'signup' THEN 'SIM Swap Fraud [Critical - Immediate Block]'
         WHEN 'view' THEN 'IRSF (International Fraud) [High Confidence]' END AS alert_type
FROM events""",
    "login_failures": """
SELECT user_id % 20 AS customer_id,
       TIMESTAMP '2024-01-01 00:00:00' + to_seconds(event_id * 2) AS ts,
       event_id,
       event_type = 'error' AS is_failure
FROM events""",
    "security_events": """
SELECT user_id AS customer_id, event_id, ts,
       CASE event_type WHEN 'error' THEN 'Login_Failure' WHEN 'click' THEN 'Login_Success'
            WHEN 'purchase' THEN 'Password_Reset' WHEN 'signup' THEN 'SIM_Swap_Request'
            WHEN 'view' THEN 'Device_Change' END AS event_type,
       '10.0.' || CAST(CAST(json_extract(props, '$.k') AS INTEGER) % 8 AS VARCHAR) || '.'
              || CAST(user_id % 16 AS VARCHAR) AS ip_address,
       'G' || CAST(CAST(json_extract(props, '$.k') AS INTEGER) % 5 AS VARCHAR) AS geo_location
FROM events""",
    "fixes": """
SELECT user_id AS customer_id, event_id,
       CAST((event_id*37) % 180 - 90 AS DOUBLE) AS lat,
       CAST((event_id*91) % 360 - 180 AS DOUBLE) AS lon,
       'T' || CAST(event_id % 50 AS VARCHAR) AS cell_tower_id,
       ts
FROM events""",
    "day_calls": """
SELECT CAST(CASE WHEN o_orderkey % 10 < 8 THEN 900 ELSE 901 + o_custkey % 50 END AS BIGINT) AS customer_id,
       TIMESTAMP '1999-01-01 00:00:00'
         + to_minutes(CAST(o_orderkey % 1400 - CASE WHEN o_orderkey % 11 = 0 THEN 2880 ELSE 0 END AS INTEGER)) AS ts,
       CASE WHEN o_orderkey % 97 = 0 THEN '1-900-' || (o_orderkey % 100) ELSE '44-' || o_orderkey END AS dialed_number
FROM orders""",
    "addresses": """
SELECT DISTINCT 'address' AS kind, CAST(o_custkey * 7919 % 700 AS VARCHAR) AS value, CAST(o_custkey AS VARCHAR) AS account FROM orders""",
    "busy_calls": """
SELECT l_suppkey % 25 AS customer_id, TIMESTAMP '1999-01-01' + to_minutes(CAST((l_orderkey*7 + l_linenumber*13) % 20160 AS INTEGER)) AS ts,
       CAST(l_quantity AS DOUBLE) AS call_duration, l_orderkey AS call_seq, l_linenumber,
       CASE l_partkey % 8 WHEN 0 THEN '1-900' WHEN 1 THEN '20' WHEN 2 THEN '809' WHEN 3 THEN '44'
            WHEN 4 THEN '876' WHEN 5 THEN '1-212' WHEN 6 THEN '33' ELSE '49' END
         || '-' || lpad(CAST(l_partkey % 3 AS VARCHAR), 4, '0') AS dialed_number
FROM lineitem""",
    "campaign_alerts": """
SELECT CAST(event_id AS VARCHAR) AS call_id, date_trunc('second', ts) AS timestamp,
       CASE event_type
         WHEN 'click' THEN 'Wangiri (One Ring Scam) [Medium Confidence]'
         WHEN 'error' THEN 'SIM Box / Gateway Bypass [High Confidence]'
         WHEN 'purchase' THEN 'Credit Abuse / Payment Fraud [High Risk]'
         WHEN 'signup' THEN 'SIM Swap Fraud [Critical - Immediate Block]'
         WHEN 'view' THEN 'IRSF (International Fraud) [High Confidence]' END || ' campaign ' || CAST(CAST(ts AS DATE) AS VARCHAR) AS alert_type
FROM events""",
    "monthly_cdr": """
SELECT CAST(l_orderkey % 150 AS VARCHAR) AS customer_id,
       CAST((l_partkey*17 + l_orderkey) % 600 AS INTEGER) AS monthly_call_count,
       CAST((l_orderkey*31 + l_partkey*7) % 10000 AS DOUBLE) / 10 * 2 AS monthly_call_duration
FROM lineitem""",
    "home_location": """
SELECT CAST(user_id AS VARCHAR) AS customer_id,
       'T' || CAST(user_id AS VARCHAR) || '-' || CAST((event_id*7) % 90 % 2 AS VARCHAR) AS cell_tower_id, ts AS event_ts
FROM events""",
    "calls": """
SELECT l_suppkey % 25 AS customer_id,
       CASE WHEN (l_suppkey % 25) % 4 = 0 THEN 'Business' ELSE 'Consumer' END AS customer_segment,
       l_partkey % 25 AS destination_country,
       l_shipdate + to_minutes(CAST(l_orderkey % 1440 AS INTEGER)) AS ts,
       CAST(CASE WHEN (l_suppkey % 25) % 2 = 1 THEN l_quantity
            ELSE floor(pow(10.0, 2 * ((l_orderkey*7 + l_partkey) % 1000) / 1000.0)) END AS DOUBLE) AS call_duration,
       l_orderkey AS call_seq, l_linenumber,
       CASE l_partkey % 8 WHEN 0 THEN '1-900' WHEN 1 THEN '20' WHEN 2 THEN '809' WHEN 3 THEN '44'
            WHEN 4 THEN '876' WHEN 5 THEN '1-212' WHEN 6 THEN '33' ELSE '49' END
         || '-' || lpad(CAST(l_partkey % 9973 AS VARCHAR), 4, '0') AS dialed_number,
       ['US','GB','DE','FR','EG','CU','SO','LY','AF','IN','CN','BR','MX','NG','PK','RU','JP','KR','IT',
        'ES','CA','AU','ZA','SA','TR'][l_partkey % 25 + 1] AS destination_iso,
       l_extendedprice AS call_cost_raw
FROM lineitem""",
    "profiles": """
SELECT c_custkey AS customer_id, c_name AS customer_name,
       CAST(18 + c_custkey % 60 AS INTEGER) AS age,
       CASE c_custkey % 2 WHEN 0 THEN 'Female' ELSE 'Male' END AS gender,
       'N' || CAST(c_nationkey AS VARCHAR) AS region,
       c_mktsegment AS plan_type,
       c_acctbal AS income,
       CAST((c_custkey*29) % 1000 AS DOUBLE) AS monthly_spending,
       CAST(300 + (c_custkey*37) % 551 AS INTEGER) AS credit_score,
       CAST(50 + (c_custkey*13) % 950 AS DOUBLE) AS credit_limit,
       CASE c_custkey % 4 WHEN 0 THEN 'Credit Card' WHEN 1 THEN 'Cash' WHEN 2 THEN 'Bank Transfer'
            ELSE 'Mobile Wallet' END AS payment_method,
       CAST((c_custkey*7) % 30 AS INTEGER) AS avg_payment_delay,
       CAST((c_custkey*11) % 50 AS DOUBLE) / 10 AS payment_behavior_index,
       DATE '2023-01-01' + CAST(c_custkey % 730 AS INTEGER) AS account_creation_date,
       CAST(c_custkey % 4 AS INTEGER) AS kyc_level,
       c_custkey % 3 <> 0 AS kyc_verified,
       CAST((c_custkey*17) % 120 AS INTEGER) AS days_in_roaming,
       CASE c_custkey % 3 WHEN 0 THEN 'Single' WHEN 1 THEN 'Married' ELSE 'Divorced' END AS marital_status,
       CASE c_custkey % 4 WHEN 0 THEN 'High School' WHEN 1 THEN 'Bachelor' WHEN 2 THEN 'Master'
            ELSE 'PhD' END AS education_level,
       CASE c_custkey % 5 WHEN 0 THEN 'Employed' WHEN 1 THEN 'Self-Employed' WHEN 2 THEN 'Unemployed'
            WHEN 3 THEN 'Student' ELSE 'Retired' END AS employment_status,
       CASE c_custkey % 3 WHEN 0 THEN 'Arabic' WHEN 1 THEN 'English' ELSE 'French' END AS preferred_language,
       CASE c_custkey % 3 WHEN 0 THEN 'Basic' WHEN 1 THEN 'Unlimited' ELSE 'Standard' END AS requested_plan,
       CASE (c_custkey // 2) % 2 WHEN 0 THEN 'Online' ELSE 'Store' END AS registration_channel,
       c_custkey % 4 <> 1 AS address_verified
FROM customer""",
    "billing": """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
       CAST((c_custkey*29) % 1000 AS DOUBLE) AS monthly_spending,
       CAST(300 + (c_custkey*37) % 551 AS INTEGER) AS credit_score,
       CASE c_custkey % 4 WHEN 0 THEN 'Credit Card' WHEN 1 THEN 'Cash' WHEN 2 THEN 'Bank Transfer'
            ELSE 'Mobile Wallet' END AS payment_method,
       CAST((c_custkey*7) % 30 AS INTEGER) AS avg_payment_delay,
       CAST((c_custkey*11) % 50 AS DOUBLE) / 10 AS payment_behavior_index,
       CAST(50 + (c_custkey*13) % 950 AS DOUBLE) AS credit_limit,
       CAST(DATE '2023-01-01' + CAST(c_custkey % 730 AS INTEGER) AS TIMESTAMP) AS event_ts
FROM customer""",
    "behavior": """
SELECT c_custkey AS customer_id,
       CAST(c_custkey % 12 AS INTEGER) AS monthly_online_purchases,
       CAST((c_custkey*17) % 5000 AS DOUBLE) / 10 AS avg_cart_value,
       CASE c_custkey % 4 WHEN 0 THEN 'Electronics' WHEN 1 THEN 'Fashion' WHEN 2 THEN 'Grocery'
            ELSE 'Travel' END AS most_purchased_category,
       CASE c_custkey % 4 WHEN 0 THEN 'Email' WHEN 1 THEN 'SMS' WHEN 2 THEN 'App'
            ELSE 'Call' END AS preferred_contact_channel,
       CAST((c_custkey*7) % 100 AS DOUBLE) / 100 AS offer_response_rate
FROM customer WHERE c_custkey % 5 <> 0""",
    "devices": """
WITH d AS (
  SELECT c_custkey,
         CASE c_custkey % 7 WHEN 0 THEN '35332510' WHEN 1 THEN '35391805' WHEN 2 THEN '35875604'
              WHEN 3 THEN '01326300' WHEN 4 THEN '35925406' WHEN 5 THEN '86473603' ELSE '99000000' END
         || lpad(CAST(((c_custkey % 500) * 7919) % 10000000 AS VARCHAR), 7, '0') AS full_imei
  FROM customer)
SELECT c_custkey AS device_id, c_custkey AS customer_id,
       CASE c_custkey % 4 WHEN 0 THEN 'Smartphone' WHEN 1 THEN 'Feature Phone' WHEN 2 THEN 'Tablet'
            ELSE 'Router' END AS device_type,
       CASE c_custkey % 5 WHEN 0 THEN 'Generic GSM Phone' WHEN 1 THEN 'Galaxy A12' WHEN 2 THEN 'iPhone 12'
            WHEN 3 THEN 'Redmi 9' ELSE 'Generic Feature Phone' END AS device_model,
       CAST(1 + c_custkey % 4 AS INTEGER) AS num_devices_registered,
       CAST(c_custkey % 60 AS INTEGER) AS device_age_months,
       CASE c_custkey % 3 WHEN 0 THEN '3G' WHEN 1 THEN '4G' ELSE '5G' END AS network_generation,
       CASE c_custkey % 3 WHEN 0 THEN 'Android' WHEN 1 THEN 'iOS' ELSE 'Other' END AS os_type,
       c_custkey % 3 = 2 AS uses_5g,
       CASE c_custkey % 3 WHEN 0 THEN 'Up-to-date' WHEN 1 THEN 'Outdated' ELSE 'Unknown' END
            AS device_security_patch,
       CASE WHEN c_custkey % 37 = 0 THEN substr(full_imei, 1, 14) ELSE full_imei END AS imei,
       substr(CASE WHEN c_custkey % 37 = 0 THEN substr(full_imei, 1, 14) ELSE full_imei END, 1, 8) AS tac_code,
       CASE WHEN c_custkey % 23 = 0 THEN 'blacklisted' WHEN c_custkey % 29 = 0 THEN 'stolen'
            ELSE 'active' END AS device_status
FROM d""",
    "towers": """
SELECT s_suppkey AS tower_id,
       'City' || CAST(s_nationkey AS VARCHAR) AS city,
       'S' || CAST(s_nationkey % 5 AS VARCHAR) AS state,
       CAST(10000 + s_suppkey % 90000 AS INTEGER) AS zip_code,
       CAST((s_suppkey*37) % 180 - 90 AS DOUBLE) AS latitude,
       CAST((s_suppkey*91) % 360 - 180 AS DOUBLE) AS longitude,
       CASE s_suppkey % 3 WHEN 0 THEN 'Urban' WHEN 1 THEN 'Suburban' ELSE 'Rural' END AS urbanization_level,
       CAST(s_suppkey % 100 AS INTEGER) AS signal_strength_raw
FROM supplier""",
    "complaints": """
SELECT o_orderkey AS complaint_id, o_custkey AS customer_id,
       CASE (o_orderkey // 7) % 4 WHEN 0 THEN 'Billing' WHEN 1 THEN 'Network' WHEN 2 THEN 'Fraud'
            ELSE 'Service' END AS complaint_category,
       CASE o_orderkey % 3 WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' ELSE 'High' END AS severity,
       CAST(o_orderkey % 96 AS INTEGER) AS resolution_time_hours,
       CASE WHEN o_orderkey % 3 = 0 THEN 'open' ELSE 'closed' END AS complaint_status,
       o_orderdate AS created_at
FROM orders WHERE o_orderkey % 7 = 0""",
    "profile_changes": """
SELECT CAST(o_custkey AS VARCHAR) AS customer_id,
       CAST(o_orderkey % 2000 AS DOUBLE) AS credit_limit,
       CAST(300 + (o_orderkey*37) % 551 AS INTEGER) AS credit_score,
       o_orderdate AS updated_at,
       o_orderkey AS change_seq,
       'u' AS __op, 'telecom' AS __db, 'customer_profiles' AS __table,
       CASE WHEN o_orderkey % 50 = 0 THEN 'true' ELSE 'false' END AS __deleted
FROM orders""",
    "complaint_scores": """
SELECT c_custkey AS customer_id,
       CAST((c_custkey*13) % 50 AS DOUBLE) / 10 AS customer_satisfaction_score,
       CAST(c_custkey % 6 AS INTEGER) AS customer_complaints,
       CAST(1 + c_custkey % 5 AS INTEGER) AS technical_support_rating,
       CAST((c_custkey*7) % 100 AS DOUBLE) / 100 AS churn_risk_score,
       c_custkey % 2 = 0 AS has_contacted_support
FROM customer""",
    "internet_usage": """
SELECT c_custkey AS customer_id,
       CAST((c_custkey*13) % 500 AS DOUBLE) / 10 AS internet_usage_gb,
       CAST((c_custkey*7) % 1000 AS DOUBLE) / 10 AS internet_speed_avg_mbps,
       CAST((c_custkey*3) % 200 AS DOUBLE) AS latency_ms,
       CAST(c_custkey % 24 AS INTEGER) AS peak_usage_hour,
       CAST((c_custkey*11) % 100 AS DOUBLE) / 100 AS weekend_data_ratio,
       CAST((c_custkey*19) % 40 AS INTEGER) AS voice_minutes
FROM customer""",
    "network_metrics": """
SELECT p_partkey % 100 AS tower_id,
       CAST(-50 - p_size AS DOUBLE) AS signal_strength_avg,
       CAST((p_size*3) % 60 AS INTEGER) AS network_downtime_minutes,
       CASE p_size % 3 WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' ELSE 'High' END AS network_congestion_level,
       -50 - CAST(p_size AS DOUBLE) / 2 AS avg_signal_strength
FROM part""",
    "security_profile": """
SELECT c_custkey AS customer_id,
       CAST(c_custkey % 10 AS INTEGER) AS num_failed_logins,
       CAST((c_custkey*3) % 5 AS INTEGER) AS num_fraud_attempts,
       CASE c_custkey % 3 WHEN 0 THEN 'AES-256' WHEN 1 THEN 'AES-128' ELSE 'None' END AS encryption_type,
       CASE c_custkey % 2 WHEN 0 THEN 'Yes' ELSE 'No' END AS biometric_auth,
       c_custkey % 2 = 1 AS two_factor_auth
FROM customer""",
    "device_sightings": """
SELECT user_id AS customer_id, event_id, ts,
       '3533251' || lpad(CAST((user_id*7 + event_id // 200) % 1000 AS VARCHAR), 8, '0') AS imei
FROM events""",
    "sessions": """
SELECT user_id AS customer_id, event_id, ts, CAST(hour(ts) AS INTEGER) AS hour,
       'G' || CAST(CAST(json_extract(props, '$.k') AS INTEGER) % 5 AS VARCHAR) AS location,
       [['Social','Streaming','Gaming','Banking','Maps','Shopping'][CAST(json_extract(props, '$.k') AS INTEGER) % 6 + 1],
        ['Social','Streaming','Gaming','Banking','Maps','Shopping'][(CAST(json_extract(props, '$.k') AS INTEGER) * 7 + 1) % 6 + 1]]
         AS apps,
       value AS data_usage,
       CASE event_type WHEN 'error' THEN 'Login_Failure' WHEN 'click' THEN 'Login_Success'
            WHEN 'purchase' THEN 'Password_Reset' WHEN 'signup' THEN 'SIM_Swap_Request'
            WHEN 'view' THEN 'Device_Change' END AS first_action
FROM events""",
    "alerts_ext": """
SELECT a.*, CAST(json_extract(e.props, '$.k') AS INTEGER) % 10 = 0 AS false_positive,
       a.duration_min * 0.05 AS fraud_value_estimate,
       a.timestamp + to_seconds(CAST((e.event_id * 7) % 30 AS INTEGER)) AS detection_timestamp,
       'PENDING' AS action_taken
FROM alerts a JOIN events e ON a.call_id = CAST(e.event_id AS VARCHAR)""",
}


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs it needs (dependency order kept)."""
    if not names:
        names = tuple(n for n in VIEWS if re.search(rf"\b{n}\b", body))
    body = body.strip()
    if not names:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in names)
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
