"""Deterministic projections of the driver tables onto the reference shapes.

The reference ships no data; FIXTURES.md (part B) specifies how each stream,
batch and change table is derived from the driver tables.  Every projection is
a narrow ``select`` over one scan (plus, at most, a join to a bounded
dimension), so it costs one pass and keeps parquet column pruning.

Integer arithmetic is on non-negative keys, measures are doubles (``x / 10.0``
is double division here and in the SQL oracle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .tables import Tables

c = F.col

# Alert type per driver event type (panel fixture).
EVENT_ALERT_TYPE = {
    "click": "Wangiri (One Ring Scam) [Medium Confidence]",
    "error": "SIM Box / Gateway Bypass [High Confidence]",
    "purchase": "Credit Abuse / Payment Fraud [High Risk]",
    "signup": "SIM Swap Fraud [Critical - Immediate Block]",
    "view": "IRSF (International Fraud) [High Confidence]",
}

# Security event type per driver event type.
SECURITY_EVENT_TYPE = {
    "error": "Login_Failure",
    "click": "Login_Success",
    "purchase": "Password_Reset",
    "signup": "SIM_Swap_Request",
    "view": "Device_Change",
}


def _map(col: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v))
    return out.otherwise(F.lit(default))


def _str(col: Column) -> Column:
    return col.cast("string")


def _int(col: Column) -> Column:
    return col.cast("int")


def _tenth(col: Column) -> Column:
    return col.cast("double") / 10.0


def _props_k() -> Column:
    return F.get_json_object(c("props"), "$.k").cast("int")


# ---------------------------------------------------------------- streams --

def cdr(t: Tables) -> DataFrame:
    ok, pk, sk, ln = c("l_orderkey"), c("l_partkey"), c("l_suppkey"), c("l_linenumber")
    return t.lineitem.select(
        _str(ok).alias("customer_id"),
        _int((pk * 17 + ok) % 600).alias("monthly_call_count"),
        _tenth((ok * 31 + pk * 7) % 10000).alias("monthly_call_duration"),
        _tenth((ok * 13 + sk * 7) % 5000).alias("international_call_duration"),
        _int((ok + ln * 11) % 90).alias("call_drop_count"),
        _int((pk * 3 + ln) % 60).alias("sms_usage_per_month"),
        F.timestamp_add("HOUR", ok % 24, c("l_shipdate")).alias("event_ts"),
    )


def sdr(t: Tables, with_key: bool = False) -> DataFrame:
    ok, ck = c("o_orderkey"), c("o_custkey")
    return t.orders.select(
        *([ok] if with_key else []),
        _str(ck).alias("customer_id"),
        _int((ok * 7) % 100).alias("ss7_requests"),
        _int((ok * 3 + ck) % 60).alias("diameter_messages"),
        _int(ck % 8).alias("failed_auth_attempts"),
        _int((ok + ck * 5) % 80).alias("location_updates"),
        _int(F.when(ok % 10 == 0, 1 + ck % 3).otherwise(0)).alias("imsi_changes"),
        c("o_orderdate").alias("event_ts"),
    )


def payments(t: Tables) -> DataFrame:
    ok, ck = c("o_orderkey"), c("o_custkey")
    return t.orders.select(
        _str(ck).alias("customer_id"),
        (ok % 400 - 100).cast("double").alias("wallet_balance"),
        ((ck * 7 + ok) % 400).cast("double").alias("monthly_recharge_amount"),
        _int(ok % 9).alias("failed_payment_attempts"),
        ((ok * 11 + ck) % 250).cast("double").alias("vas_spending"),
        c("o_orderdate").alias("event_ts"),
    )


def location(t: Tables) -> DataFrame:
    eid = c("event_id")
    return t.events.select(
        _str(c("user_id")).alias("customer_id"),
        ((eid * 37) % 180 - 90).cast("double").alias("latitude"),
        ((eid * 91) % 360 - 180).cast("double").alias("longitude"),
        F.concat(F.lit("T"), _str(eid % 50)).alias("cell_tower_id"),
        _int((eid * 7) % 90).alias("location_update_count"),
        (c("value") * 2).alias("distance_traveled_km"),
        c("ts").alias("event_ts"),
    )


def network(t: Tables) -> DataFrame:
    ok, pk, sk = c("l_orderkey"), c("l_partkey"), c("l_suppkey")
    return t.lineitem.select(
        _str(ok).alias("customer_id"),
        (ok % 120).cast("double").alias("data_usage_gb"),
        (pk % 50).cast("double").alias("upload_gb"),
        ((pk * 3 + ok) % 200).cast("double").alias("download_gb"),
        ((ok * 3 + sk * 10) % 700).cast("double").alias("average_latency_ms"),
        ((sk + ok) % 30).cast("double").alias("packet_loss_pct"),
        F.timestamp_add("HOUR", ok % 24, c("l_shipdate")).alias("event_ts"),
    )


def security(t: Tables) -> DataFrame:
    eid, uid = c("event_id"), c("user_id")
    return t.events.select(
        _str(uid).alias("customer_id"),
        _int(eid % 7).alias("failed_login_attempts"),
        _int(uid % 3).alias("password_changes"),
        _int(F.floor(eid / 7) % 6).alias("suspicious_ips"),
        _int((eid * 3 + uid) % 140).alias("api_abuse_count"),
        _int(F.floor(eid / 3) % 4).alias("account_changes"),
        c("ts").alias("event_ts"),
    )


def service(t: Tables) -> DataFrame:
    ok, ck = c("o_orderkey"), c("o_custkey")
    return t.orders.select(
        _str(ck).alias("customer_id"),
        _int(ok % 60).alias("premium_sms_count"),
        ((ok * 7 + ck) % 150).cast("double").alias("premium_calls_min"),
        _int(ck % 14).alias("subscription_services"),
        ((ok * 3 + ck) % 300).cast("double").alias("roaming_charges"),
        _int(F.floor(ok / 5) % 25).alias("international_sms"),
        c("o_orderdate").alias("event_ts"),
    )


STREAMS = {
    "cdr": cdr, "sdr": sdr, "payments": payments, "location": location,
    "network": network, "security": security, "service": service,
}
EVENT_STREAMS = tuple(STREAMS)


def stream(t: Tables, name: str) -> DataFrame:
    return STREAMS[name](t)


def billing(t: Tables) -> DataFrame:
    """Monthly billing snapshot per customer (batch shape of the payments file)."""
    p = profiles(t)
    return p.select(
        p.customer_id.cast("string").alias("customer_id"), "monthly_spending", "credit_score",
        "payment_method", "avg_payment_delay", "payment_behavior_index", "credit_limit",
        F.to_timestamp_ntz(F.col("account_creation_date").cast("string")).alias("event_ts"))


STREAMS["billing"] = billing


# ------------------------------------------------------------ alert table --

def _alert_columns() -> list[Column]:
    k = _props_k()
    return [
        _str(c("event_id")).alias("call_id"),
        _str(c("user_id")).alias("caller_number"),
        F.when(k % 3 == 0, F.lit("N/A"))
         .otherwise(F.concat(F.lit("R"), _str(k % 20))).alias("receiver_number"),
        c("value").alias("duration_min"),
        F.date_trunc("second", c("ts")).cast("timestamp_ntz").alias("timestamp"),
        _map(c("event_type"), EVENT_ALERT_TYPE).alias("alert_type"),
    ]


def alerts(t: Tables) -> DataFrame:
    """Alert-store rows for the panel queries (one per driver event)."""
    return t.events.select(*_alert_columns())


# -------------------------------------------------- event-level histories --

def login_failures(t: Tables) -> DataFrame:
    """Security log: one row per attempt; failure when the event is an error."""
    return t.events.select(
        (c("user_id") % 20).alias("customer_id"),
        F.timestamp_add("SECOND", c("event_id") * 2,
                        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("ts"),
        c("event_id"),
        (c("event_type") == "error").alias("is_failure"),
    )


def security_events(t: Tables) -> DataFrame:
    """Typed security events (login failure, password reset, SIM swap...)."""
    k = _props_k()
    return t.events.select(
        c("user_id").alias("customer_id"), c("event_id"), c("ts"),
        _map(c("event_type"), SECURITY_EVENT_TYPE).alias("event_type"),
        F.concat(F.lit("10.0."), _str(k % 8), F.lit("."), _str(c("user_id") % 16)).alias("ip_address"),
        F.concat(F.lit("G"), _str(k % 5)).alias("geo_location"),
    )


def fixes(t: Tables) -> DataFrame:
    eid = c("event_id")
    return t.events.select(
        c("user_id").alias("customer_id"), eid,
        ((eid * 37) % 180 - 90).cast("double").alias("lat"),
        ((eid * 91) % 360 - 180).cast("double").alias("lon"),
        F.concat(F.lit("T"), _str(eid % 50)).alias("cell_tower_id"),
        c("ts"),
    )


# Dial prefixes and ISO country codes of the call fixture
# (destination_country k maps to COUNTRY_CODES[k]).
DIAL_PREFIXES = ["1-900", "20", "809", "44", "876", "1-212", "33", "49"]
COUNTRY_CODES = ["US", "GB", "DE", "FR", "EG", "CU", "SO", "LY", "AF", "IN", "CN", "BR", "MX",
                 "NG", "PK", "RU", "JP", "KR", "IT", "ES", "CA", "AU", "ZA", "SA", "TR"]


def calls(t: Tables) -> DataFrame:
    ok, pk, sk = c("l_orderkey"), c("l_partkey"), c("l_suppkey")
    cust = sk % 25
    skewed = F.floor(F.pow(F.lit(10.0), 2 * ((ok * 7 + pk) % 1000) / 1000.0))
    return t.lineitem.select(
        cust.alias("customer_id"),
        F.when(cust % 4 == 0, F.lit("Business")).otherwise(F.lit("Consumer")).alias("customer_segment"),
        (pk % 25).alias("destination_country"),
        F.timestamp_add("MINUTE", ok % 1440, c("l_shipdate")).alias("ts"),
        F.when(cust % 2 == 1, c("l_quantity")).otherwise(skewed).cast("double").alias("call_duration"),
        ok.alias("call_seq"), c("l_linenumber"),
        F.concat(_pick(DIAL_PREFIXES, pk), F.lit("-"), F.lpad(_str(pk % 9973), 4, "0")).alias("dialed_number"),
        _pick(COUNTRY_CODES, pk).alias("destination_iso"),
        c("l_extendedprice").alias("call_cost_raw"),
    )


def addresses(t: Tables) -> DataFrame:
    """Postal addresses of accounts that have ordered, some of them shared."""
    ck = c("o_custkey")
    return t.orders.select(F.lit("address").alias("kind"), _str(ck * 7919 % 700).alias("value"), _str(ck).alias("account")).distinct()


def busy_calls(t: Tables) -> DataFrame:
    """Two weeks of calls of 25 customers to few numbers: hours with many calls, redials, callbacks."""
    ok, pk, ln = c("l_orderkey"), c("l_partkey"), c("l_linenumber")
    return t.lineitem.select(
        (c("l_suppkey") % 25).alias("customer_id"),
        F.timestamp_add("MINUTE", ((ok * 7 + ln * 13) % 20160).cast("int"), F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")).alias("ts"),
        c("l_quantity").cast("double").alias("call_duration"), ok.alias("call_seq"), ln,
        F.concat(_pick(DIAL_PREFIXES, pk), F.lit("-"), F.lpad(_str(pk % 3), 4, "0")).alias("dialed_number"),
    )


def campaign_alerts(t: Tables) -> DataFrame:
    """Alerts whose type names the campaign of their day."""
    return alerts(t).withColumn("alert_type", F.concat("alert_type", F.lit(" campaign "), F.to_date("timestamp").cast("string")))


def monthly_cdr(t: Tables) -> DataFrame:
    """Call records of the customers that location events have, in longer months."""
    return cdr(t).withColumn("customer_id", _str(c("customer_id").cast("long") % 150)) \
        .withColumn("monthly_call_duration", c("monthly_call_duration") * 2)


def home_location(t: Tables) -> DataFrame:
    """Location events of customers who stay at one or two towers."""
    return location(t).withColumn("cell_tower_id", F.concat(F.lit("T"), c("customer_id"), F.lit("-"), _str(c("location_update_count") % 2)))


def day_calls(t: Tables) -> DataFrame:
    """Calls of one day and the days before it: customer 900 dials thousands of numbers,
    the others few, some of them premium-rate; a row in eleven is two days older."""
    ok = c("o_orderkey")
    return t.orders.select(
        F.when(ok % 10 < 8, F.lit(900)).otherwise(901 + c("o_custkey") % 50).cast("long").alias("customer_id"),
        F.timestamp_add("MINUTE", (ok % 1400 - F.when(ok % 11 == 0, 2880).otherwise(0)).cast("int"),
                        F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")).alias("ts"),
        F.when(ok % 97 == 0, F.concat(F.lit("1-900-"), _str(ok % 100))).otherwise(F.concat(F.lit("44-"), _str(ok)))
        .alias("dialed_number"),
    )


# ------------------------------------------------------- master / batch --

# Payment methods and plan/label vocabularies of the fixtures.
PAYMENT_METHODS = ["Credit Card", "Cash", "Bank Transfer", "Mobile Wallet"]
GENDERS = ["Female", "Male"]


def _pick(values: list, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx % len(values) + 1).cast("int"))


def profiles(t: Tables) -> DataFrame:
    ck = c("c_custkey")
    return t.customer.select(
        ck.alias("customer_id"),
        c("c_name").alias("customer_name"),
        _int(18 + ck % 60).alias("age"),
        _pick(GENDERS, ck).alias("gender"),
        F.concat(F.lit("N"), _str(c("c_nationkey"))).alias("region"),
        c("c_mktsegment").alias("plan_type"),
        c("c_acctbal").alias("income"),
        ((ck * 29) % 1000).cast("double").alias("monthly_spending"),
        _int(300 + (ck * 37) % 551).alias("credit_score"),
        (50 + (ck * 13) % 950).cast("double").alias("credit_limit"),
        _pick(PAYMENT_METHODS, ck).alias("payment_method"),
        _int((ck * 7) % 30).alias("avg_payment_delay"),
        _tenth((ck * 11) % 50).alias("payment_behavior_index"),
        F.date_add(F.lit("2023-01-01").cast("date"), _int(ck % 730)).alias("account_creation_date"),
        _int(ck % 4).alias("kyc_level"),
        (ck % 3 != 0).alias("kyc_verified"),
        _int((ck * 17) % 120).alias("days_in_roaming"),
        _pick(["Single", "Married", "Divorced"], ck).alias("marital_status"),
        _pick(["High School", "Bachelor", "Master", "PhD"], ck).alias("education_level"),
        _pick(["Employed", "Self-Employed", "Unemployed", "Student", "Retired"], ck).alias("employment_status"),
        _pick(["Arabic", "English", "French"], ck).alias("preferred_language"),
        _pick(["Basic", "Unlimited", "Standard"], ck).alias("requested_plan"),
        _pick(["Online", "Store"], F.floor(ck / 2)).alias("registration_channel"),
        (ck % 4 != 1).alias("address_verified"),
    )


def behavior(t: Tables) -> DataFrame:
    ck = c("c_custkey")
    return t.customer.filter(ck % 5 != 0).select(
        ck.alias("customer_id"),
        _int(ck % 12).alias("monthly_online_purchases"),
        _tenth((ck * 17) % 5000).alias("avg_cart_value"),
        _pick(["Electronics", "Fashion", "Grocery", "Travel"], ck).alias("most_purchased_category"),
        _pick(["Email", "SMS", "App", "Call"], ck).alias("preferred_contact_channel"),
        (((ck * 7) % 100) / 100.0).alias("offer_response_rate"),
    )


# Type allocation codes used by the device fixture (first five registered).
TACS = ["35332510", "35391805", "35875604", "01326300", "35925406", "86473603", "99000000"]


def devices(t: Tables) -> DataFrame:
    """Device registry: IMEI = TAC + serial; serials collide every 500 customers,
    every 37th IMEI is one digit short, two of seven TACs are unregistered."""
    ck = c("c_custkey")
    full = F.concat(_pick(TACS, ck), F.lpad(_str(((ck % 500) * 7919) % 10000000), 7, "0"))
    body = F.when(ck % 37 == 0, F.substring(full, 1, 14)).otherwise(full)
    return t.customer.select(
        ck.alias("device_id"), ck.alias("customer_id"),
        _pick(["Smartphone", "Feature Phone", "Tablet", "Router"], ck).alias("device_type"),
        _pick(["Generic GSM Phone", "Galaxy A12", "iPhone 12", "Redmi 9", "Generic Feature Phone"], ck)
        .alias("device_model"),
        _int(1 + ck % 4).alias("num_devices_registered"),
        _int(ck % 60).alias("device_age_months"),
        _pick(["3G", "4G", "5G"], ck).alias("network_generation"),
        _pick(["Android", "iOS", "Other"], ck).alias("os_type"),
        (ck % 3 == 2).alias("uses_5g"),
        _pick(["Up-to-date", "Outdated", "Unknown"], ck).alias("device_security_patch"),
        body.alias("imei"),
        F.substring(body, 1, 8).alias("tac_code"),
        F.when(ck % 23 == 0, F.lit("blacklisted")).when(ck % 29 == 0, F.lit("stolen"))
         .otherwise(F.lit("active")).alias("device_status"),
    )


def towers(t: Tables) -> DataFrame:
    sk = c("s_suppkey")
    return t.supplier.select(
        sk.alias("tower_id"),
        F.concat(F.lit("City"), _str(c("s_nationkey"))).alias("city"),
        F.concat(F.lit("S"), _str(c("s_nationkey") % 5)).alias("state"),
        _int(10000 + sk % 90000).alias("zip_code"),
        ((sk * 37) % 180 - 90).cast("double").alias("latitude"),
        ((sk * 91) % 360 - 180).cast("double").alias("longitude"),
        _pick(["Urban", "Suburban", "Rural"], sk).alias("urbanization_level"),
        _int(sk % 100).alias("signal_strength_raw"),
    )


def complaints(t: Tables) -> DataFrame:
    ok, ck = c("o_orderkey"), c("o_custkey")
    return t.orders.filter(ok % 7 == 0).select(
        ok.alias("complaint_id"), ck.alias("customer_id"),
        _pick(["Billing", "Network", "Fraud", "Service"], F.floor(ok / 7)).alias("complaint_category"),
        _pick(["Low", "Medium", "High"], ok).alias("severity"),
        _int(ok % 96).alias("resolution_time_hours"),
        F.when(ok % 3 == 0, F.lit("open")).otherwise(F.lit("closed")).alias("complaint_status"),
        c("o_orderdate").alias("created_at"),
    )


def profile_changes(t: Tables) -> DataFrame:
    """Flattened change events keyed by customer (one version per order)."""
    ok = c("o_orderkey")
    return t.orders.select(
        _str(c("o_custkey")).alias("customer_id"),
        (ok % 2000).cast("double").alias("credit_limit"),
        _int(300 + (ok * 37) % 551).alias("credit_score"),
        c("o_orderdate").alias("updated_at"),
        ok.alias("change_seq"),
        F.lit("u").alias("__op"), F.lit("telecom").alias("__db"),
        F.lit("customer_profiles").alias("__table"),
        F.when(ok % 50 == 0, F.lit("true")).otherwise(F.lit("false")).alias("__deleted"),
    )


# ------------------------------------------------- batch (warehouse) files --

def complaint_scores(t: Tables) -> DataFrame:
    ck = c("c_custkey")
    return t.customer.select(
        ck.alias("customer_id"),
        _tenth((ck * 13) % 50).alias("customer_satisfaction_score"),
        _int(ck % 6).alias("customer_complaints"),
        _int(1 + ck % 5).alias("technical_support_rating"),
        (((ck * 7) % 100) / 100.0).alias("churn_risk_score"),
        (ck % 2 == 0).alias("has_contacted_support"),
    )


def internet_usage(t: Tables) -> DataFrame:
    ck = c("c_custkey")
    return t.customer.select(
        ck.alias("customer_id"),
        _tenth((ck * 13) % 500).alias("internet_usage_gb"),
        _tenth((ck * 7) % 1000).alias("internet_speed_avg_mbps"),
        ((ck * 3) % 200).cast("double").alias("latency_ms"),
        _int(ck % 24).alias("peak_usage_hour"),
        (((ck * 11) % 100) / 100.0).alias("weekend_data_ratio"),
        _int((ck * 19) % 40).alias("voice_minutes"),
    )


def network_metrics(t: Tables) -> DataFrame:
    """Per-tower network measurements; towers repeat, so rows can repeat."""
    pk, sz = c("p_partkey"), c("p_size")
    return t.part.select(
        (pk % 100).alias("tower_id"),
        (-50 - sz).cast("double").alias("signal_strength_avg"),
        _int((sz * 3) % 60).alias("network_downtime_minutes"),
        _pick(["Low", "Medium", "High"], sz).alias("network_congestion_level"),
        (-50 - sz / 2.0).alias("avg_signal_strength"),
    )


def security_profile(t: Tables) -> DataFrame:
    ck = c("c_custkey")
    return t.customer.select(
        ck.alias("customer_id"),
        _int(ck % 10).alias("num_failed_logins"),
        _int((ck * 3) % 5).alias("num_fraud_attempts"),
        _pick(["AES-256", "AES-128", "None"], ck).alias("encryption_type"),
        _pick(["Yes", "No"], ck).alias("biometric_auth"),
        (ck % 2 == 1).alias("two_factor_auth"),
    )


def device_sightings(t: Tables) -> DataFrame:
    """Device seen on each customer event; the IMEI rotates every 200 events."""
    return t.events.select(
        c("user_id").alias("customer_id"), c("event_id"), c("ts"),
        F.concat(F.lit("3533251"),
                 F.lpad(_str((c("user_id") * 7 + F.floor(c("event_id") / 200)) % 1000), 8, "0")).alias("imei"),
    )


# App vocabulary of the session fixture.
APPS = ["Social", "Streaming", "Gaming", "Banking", "Maps", "Shopping"]


def sessions(t: Tables) -> DataFrame:
    """App sessions (one per driver event) with hour, location, apps and data use."""
    k = _props_k()
    return t.events.select(
        c("user_id").alias("customer_id"), c("event_id"), c("ts"),
        F.hour("ts").alias("hour"),
        F.concat(F.lit("G"), _str(k % 5)).alias("location"),
        F.array(_pick(APPS, k), _pick(APPS, k * 7 + 1)).alias("apps"),
        c("value").alias("data_usage"),
        _map(c("event_type"), SECURITY_EVENT_TYPE).alias("first_action"),
    )


def alerts_ext(t: Tables) -> DataFrame:
    """Alert rows with the planned extra columns and a review outcome."""
    eid = c("event_id")
    return (t.events.select(*_alert_columns(), ((eid * 7) % 30).alias("_lag"), (_props_k() % 10 == 0).alias("false_positive"))
            .withColumn("fraud_value_estimate", c("duration_min") * 0.05)
            .withColumn("detection_timestamp", F.timestamp_add("SECOND", c("_lag"), c("timestamp")))
            .withColumn("action_taken", F.lit("PENDING")).drop("_lag"))
