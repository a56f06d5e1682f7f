"""Declarative fraud-rule registry.

A rule is data: an id, the stream it reads, the exact alert type, how to fill
the alert's receiver and value, and a predicate *form* that turns a threshold
dict into a boolean ``Column``.  A profile picks, per rule, a form and its
thresholds, so switching generations of constants never touches code, and the
same registry drives batch and streaming detection.

NULL semantics follow Spark's three-valued logic: a NULL predicate drops the
row.  Ratios use ``try_divide`` (a zero denominator gives NULL, as in the
lenient engine the reference ran on), never a raised ``DIVIDE_BY_ZERO``.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, functions as F

c = F.col


def ratio(num: str | Column, den: str | Column) -> Column:
    num = c(num) if isinstance(num, str) else num
    den = c(den) if isinstance(den, str) else den
    return F.try_divide(num.cast("double"), den.cast("double"))


def hour_between(lo: int, hi: int, ts: str = "event_ts") -> Column:
    """Inclusive hour range; wraps past midnight when lo > hi (22..6)."""
    h = F.hour(c(ts))
    if lo <= hi:
        return (h >= lo) & (h <= hi)
    return (h >= lo) | (h <= hi)


@dataclass(frozen=True)
class Rule:
    rule_id: str
    stream: str
    alert_type: str
    receiver: Callable[[], Column]
    value: Callable[[], Column]
    forms: dict  # form name -> fn(params) -> Column


def _lit(s: str) -> Callable[[], Column]:
    return lambda: F.lit(s)


def _col(name: str) -> Callable[[], Column]:
    return lambda: c(name)


def _fcol(name: str) -> Callable[[], Column]:
    return lambda: c(name).cast("double")


def _gt(col: str, p: dict, key: str) -> Column | None:
    return None if p.get(key) is None else c(col) > p[key]


def _and(*cols: Column | None) -> Column:
    out = None
    for x in cols:
        if x is None:
            continue
        out = x if out is None else (out & x)
    return out


def _or(*cols: Column | None) -> Column:
    out = None
    for x in cols:
        if x is None:
            continue
        out = x if out is None else (out | x)
    return out


# ------------------------------------------------------------------- CDR --

def _r01_enhanced(p):
    return _and(c("monthly_call_duration") > p["duration"], c("monthly_call_count") > p["calls"],
                c("sms_usage_per_month") < p["sms"],
                ratio("call_drop_count", "monthly_call_count") > p["drop_rate"],
                hour_between(*p["night"]) | (ratio("international_call_duration", "monthly_call_duration") > p["intl_ratio"]))


def _r01_simple(p):
    return _and(c("monthly_call_duration") > p["duration"], c("monthly_call_count") > p["calls"])


def _r02_enhanced(p):
    return _and(c("monthly_call_count") > p["calls"],
                ratio("monthly_call_duration", "monthly_call_count") < p["avg_duration"],
                c("monthly_call_duration") < p["total_duration"],
                c("international_call_duration") > p["intl"])


def _r02_simple(p):
    return _and(c("monthly_call_count") > p["calls"],
                ratio("monthly_call_duration", "monthly_call_count") < p["avg_duration"])


def _r03_enhanced(p):
    return _and(c("international_call_duration") > p["intl"],
                ratio("international_call_duration", "monthly_call_duration") > p["intl_ratio"],
                c("monthly_call_duration") > p["total_duration"], c("monthly_call_count") < p["calls"])


def _r03_simple(p):
    r = p.get("intl_ratio")
    return _and(c("international_call_duration") > p["intl"],
                None if r is None else ratio("international_call_duration", "monthly_call_duration") > r)


def _r04_enhanced(p):
    return _and(c("monthly_call_count") > p["calls"],
                ratio("monthly_call_duration", "monthly_call_count") < p["avg_duration"],
                ratio("international_call_duration", "monthly_call_duration") < p["intl_ratio"])


# ------------------------------------------------------------------- SDR --

def _r05_enhanced(p):
    return _and(_or(c("ss7_requests") > p["ss7"], c("failed_auth_attempts") > p["failed_auth"]),
                _or(c("diameter_messages") > p["diameter"], c("location_updates") > p["location_updates"]))


def _r05_simple(p):
    return _or(c("ss7_requests") > p["ss7"], c("failed_auth_attempts") > p["failed_auth"])


def _r06_enhanced(p):
    return _and(c("imsi_changes") >= p["imsi_min"],
                _or(c("failed_auth_attempts") > p["failed_auth"], c("location_updates") > p["location_updates"],
                    c("ss7_requests") > p["ss7"]))


def _r06_simple(p):
    return _and(c("imsi_changes") > p["imsi"], c("location_updates") > p["location_updates"])


# -------------------------------------------------------------- payments --

def _r07_enhanced(p):
    return _and(c("wallet_balance") < p["balance"],
                _or(c("monthly_recharge_amount") > p["recharge"], c("failed_payment_attempts") > p["failed_payments"]))


def _r07_simple(p):
    return _and(c("wallet_balance") < p["balance"], c("monthly_recharge_amount") > p["recharge"])


def _vas_ratio():
    return ratio("vas_spending", c("monthly_recharge_amount") + 0.01)


def _r08_enhanced(p):
    return _and(c("vas_spending") > p["vas"],
                _or(_vas_ratio() > p["vas_ratio"],
                    (c("monthly_recharge_amount") < p["low_recharge"]) & (c("vas_spending") > p["low_vas"])))


def _r08_simple(p):
    return _and(c("vas_spending") > p["vas"], _vas_ratio() > p["vas_ratio"])


def _r09(p):
    return _and(c("failed_payment_attempts") > p["failed_payments"], c("monthly_recharge_amount") < p["recharge"])


# -------------------------------------------------------------- location --

def _r10(p):
    return _and(c("distance_traveled_km") > p["distance"], c("location_update_count") < p["updates"])


def _r11(p):
    return _and(c("location_update_count") > p["updates"], _gt("distance_traveled_km", p, "distance"))


# --------------------------------------------------------------- network --

def _r12_enhanced(p):
    return _and(_or(c("data_usage_gb") > p["data"], c("upload_gb") > p["upload"]),
                _or(ratio("upload_gb", c("download_gb") + 0.01) > p["up_down_ratio"],
                    c("download_gb") > p["download"]))


def _r12_simple(p):
    return _or(c("data_usage_gb") > p["data"], c("upload_gb") > p["upload"])


def _r13(p):
    return _and(c("packet_loss_pct") > p["loss"], c("average_latency_ms") > p["latency"],
                _gt("upload_gb", p, "upload"))


# -------------------------------------------------------------- security --

def _r14_enhanced(p):
    return _and(_or(c("failed_login_attempts") > p["failed_logins"],
                    (c("password_changes") >= p["password_changes"]) & (c("account_changes") >= p["account_changes"])),
                _or(c("suspicious_ips") > p["ips"], hour_between(*p["night"])))


def _r14_simple(p):
    return _or(c("failed_login_attempts") > p["failed_logins"],
               (c("password_changes") > p["password_changes"]) & (c("account_changes") > p["account_changes"]))


def _r15_enhanced(p):
    return _and(_or(c("api_abuse_count") > p["api"], c("suspicious_ips") > p["ips"]),
                _or(c("failed_login_attempts") > p["failed_logins"], c("account_changes") > p["account_changes"]))


def _r15_simple(p):
    return _or(c("api_abuse_count") > p["api"], c("suspicious_ips") > p["ips"])


# --------------------------------------------------------------- service --

def _r16_enhanced(p):
    return _and(_or(c("premium_sms_count") > p["premium_sms"], c("premium_calls_min") > p["premium_calls"]),
                _or(c("international_sms") > p["intl_sms"], c("subscription_services") > p["subscriptions"]))


def _r16_simple(p):
    return _or(c("premium_sms_count") > p["premium_sms"], c("premium_calls_min") > p["premium_calls"])


def _r17_enhanced(p):
    return _and(c("subscription_services") > p["subscriptions"],
                _or(c("roaming_charges") > p["roaming"], c("premium_sms_count") > p["premium_sms"]))


def _r17_simple(p):
    return _and(c("subscription_services") > p["subscriptions"], c("roaming_charges") > p["roaming"])


# ------------------------------------------------------ billing (monthly) --

def _r18(p):
    out = _and(c("monthly_spending") > p["spending"], c("credit_score") < p["credit_score"])
    if p.get("payment_delay") is not None:
        out = out & (c("avg_payment_delay") > p["payment_delay"])
    if p.get("call_duration") is not None:
        out = out & (c("monthly_call_duration") > p["call_duration"])
    return out


def _r19(p):
    return c("monthly_spending") > c("credit_limit") * p.get("limit_factor", 1.0)


# The exact alert type strings of the reference.
RULES = [
    Rule("r01", "cdr", "SIM Box / Gateway Bypass [High Confidence]", _lit("N/A"),
         _col("monthly_call_duration"), {"enhanced": _r01_enhanced, "simple": _r01_simple}),
    Rule("r02", "cdr", "Wangiri (One Ring Scam) [Medium Confidence]", _lit("N/A"),
         _col("monthly_call_duration"), {"enhanced": _r02_enhanced, "simple": _r02_simple}),
    Rule("r03", "cdr", "IRSF (International Fraud) [High Confidence]", _lit("International"),
         _col("international_call_duration"), {"enhanced": _r03_enhanced, "simple": _r03_simple}),
    Rule("r04", "cdr", "Call Volume Abuse [Medium Confidence]", _lit("N/A"),
         _fcol("monthly_call_count"), {"enhanced": _r04_enhanced}),
    Rule("r05", "sdr", "SS7 Attack / Signaling Abuse [Critical]", _lit("N/A"),
         _fcol("ss7_requests"), {"enhanced": _r05_enhanced, "simple": _r05_simple}),
    Rule("r06", "sdr", "SIM Swap Fraud [Critical - Immediate Block]", _lit("N/A"),
         _fcol("imsi_changes"), {"enhanced": _r06_enhanced, "simple": _r06_simple}),
    Rule("r07", "payments", "Credit Abuse / Payment Fraud [High Risk]", _lit("N/A"),
         lambda: F.abs(c("wallet_balance")), {"enhanced": _r07_enhanced, "simple": _r07_simple}),
    Rule("r08", "payments", "VAS Subscription Fraud [Medium Risk]", _lit("N/A"),
         _col("vas_spending"), {"enhanced": _r08_enhanced, "simple": _r08_simple}),
    Rule("r09", "payments", "Card Testing / Payment Fraud [Critical]", _lit("N/A"),
         _fcol("failed_payment_attempts"), {"enhanced": _r09}),
    Rule("r10", "location", "Device Cloning / Impossible Travel [Critical]", _col("cell_tower_id"),
         _col("distance_traveled_km"), {"enhanced": _r10, "simple": _r10}),
    Rule("r11", "location", "Int'l Roaming Fraud [High Risk]", _col("cell_tower_id"),
         _fcol("location_update_count"), {"enhanced": _r11, "simple": _r11}),
    Rule("r12", "network", "Data Abuse / Unauthorized Tethering [Medium Risk]", _lit("N/A"),
         _col("data_usage_gb"), {"enhanced": _r12_enhanced, "simple": _r12_simple}),
    Rule("r13", "network", "DDoS / Network Attack [Critical]", _lit("N/A"),
         _col("packet_loss_pct"), {"enhanced": _r13, "simple": _r13}),
    Rule("r14", "security", "Account Takeover [Critical - Lock Account]", _lit("N/A"),
         _fcol("failed_login_attempts"), {"enhanced": _r14_enhanced, "simple": _r14_simple}),
    Rule("r15", "security", "API Abuse / Bot Attack [High Risk]", _lit("N/A"),
         _fcol("api_abuse_count"), {"enhanced": _r15_enhanced, "simple": _r15_simple}),
    Rule("r16", "service", "Premium Rate Fraud [High Risk]", _lit("Premium Services"),
         _col("premium_calls_min"), {"enhanced": _r16_enhanced, "simple": _r16_simple}),
    Rule("r17", "service", "Unauthorized Subscription [Medium Risk]", _lit("VAS Services"),
         _col("roaming_charges"), {"enhanced": _r17_enhanced, "simple": _r17_simple}),
    Rule("r18", "billing", "Subscription Fraud (Bad Debt)", _lit("N/A"),
         _col("monthly_spending"), {"simple": _r18}),
    Rule("r19", "billing", "Credit Limit Abuse", _lit("N/A"),
         _col("monthly_spending"), {"simple": _r19}),
]
RULES_BY_ID = {r.rule_id: r for r in RULES}

# Threshold profiles (rule id -> (form, thresholds)).
# relaxed = the running code (default); strict = the documented "NEW" lines;
# old = the documented "OLD" 15-rule generation; basic = the 5-rule first design.
PROFILES = {
    "relaxed": {
        "r01": ("enhanced", dict(duration=200, calls=100, sms=20, drop_rate=0.10, night=(2, 6), intl_ratio=0.3)),
        "r02": ("enhanced", dict(calls=50, avg_duration=1.0, total_duration=80, intl=3)),
        "r03": ("enhanced", dict(intl=50, intl_ratio=0.4, total_duration=100, calls=150)),
        "r04": ("enhanced", dict(calls=150, avg_duration=3, intl_ratio=0.3)),
        "r05": ("enhanced", dict(ss7=40, failed_auth=3, diameter=25, location_updates=15)),
        "r06": ("enhanced", dict(imsi_min=1, failed_auth=2, location_updates=40, ss7=50)),
        "r07": ("enhanced", dict(balance=-20, recharge=150, failed_payments=2)),
        "r08": ("enhanced", dict(vas=75, vas_ratio=0.5, low_recharge=75, low_vas=50)),
        "r09": ("enhanced", dict(failed_payments=5, recharge=100)),
        "r10": ("enhanced", dict(distance=150, updates=10)),
        "r11": ("enhanced", dict(updates=40, distance=50)),
        "r12": ("enhanced", dict(data=40, upload=20, up_down_ratio=0.3, download=75)),
        "r13": ("enhanced", dict(loss=15, latency=400, upload=20)),
        "r14": ("enhanced", dict(failed_logins=3, password_changes=1, account_changes=2, ips=0, night=(1, 6))),
        "r15": ("enhanced", dict(api=80, ips=3, failed_logins=1, account_changes=0)),
        "r16": ("enhanced", dict(premium_sms=35, premium_calls=80, intl_sms=10, subscriptions=5)),
        "r17": ("enhanced", dict(subscriptions=8, roaming=150, premium_sms=20)),
    },
    "strict": {
        "r01": ("enhanced", dict(duration=800, calls=400, sms=10, drop_rate=0.15, night=(2, 6), intl_ratio=0.5)),
        "r02": ("enhanced", dict(calls=80, avg_duration=0.5, total_duration=50, intl=5)),
        "r03": ("enhanced", dict(intl=150, intl_ratio=0.6, total_duration=200, calls=100)),
        "r04": ("enhanced", dict(calls=300, avg_duration=2, intl_ratio=0.2)),
        "r05": ("enhanced", dict(ss7=80, failed_auth=5, diameter=50, location_updates=30)),
        "r06": ("enhanced", dict(imsi_min=1, failed_auth=2, location_updates=40, ss7=50)),
        "r07": ("enhanced", dict(balance=-50, recharge=300, failed_payments=3)),
        "r08": ("enhanced", dict(vas=150, vas_ratio=0.7, low_recharge=50, low_vas=100)),
        "r09": ("enhanced", dict(failed_payments=5, recharge=100)),
        "r10": ("enhanced", dict(distance=300, updates=8)),
        "r11": ("enhanced", dict(updates=80, distance=100)),
        "r12": ("enhanced", dict(data=80, upload=40, up_down_ratio=0.4, download=150)),
        "r13": ("enhanced", dict(loss=15, latency=400, upload=20)),
        "r14": ("enhanced", dict(failed_logins=3, password_changes=1, account_changes=2, ips=0, night=(1, 6))),
        "r15": ("enhanced", dict(api=80, ips=3, failed_logins=1, account_changes=0)),
        "r16": ("enhanced", dict(premium_sms=35, premium_calls=80, intl_sms=10, subscriptions=5)),
        "r17": ("enhanced", dict(subscriptions=8, roaming=150, premium_sms=20)),
    },
    "old": {
        "r01": ("simple", dict(duration=1000, calls=500)),
        "r02": ("simple", dict(calls=100, avg_duration=1.0)),
        "r03": ("simple", dict(intl=200, intl_ratio=0.7)),
        "r05": ("simple", dict(ss7=100, failed_auth=10)),
        "r06": ("simple", dict(imsi=2, location_updates=50)),
        "r07": ("simple", dict(balance=0, recharge=500)),
        "r08": ("simple", dict(vas=200, vas_ratio=0.8)),
        "r10": ("simple", dict(distance=500, updates=10)),
        "r11": ("simple", dict(updates=100, distance=None)),
        "r12": ("simple", dict(data=100, upload=50)),
        "r13": ("simple", dict(loss=20, latency=500, upload=None)),
        "r14": ("simple", dict(failed_logins=5, password_changes=2, account_changes=3)),
        "r15": ("simple", dict(api=100, ips=5)),
        "r16": ("simple", dict(premium_sms=50, premium_calls=100)),
        "r17": ("simple", dict(subscriptions=10, roaming=200)),
    },
    "basic": {
        "r01": ("simple", dict(duration=1000, calls=500)),
        "r02": ("simple", dict(calls=100, avg_duration=1.0)),
        "r03": ("simple", dict(intl=60, intl_ratio=None)),
        "r18": ("simple", dict(spending=400, credit_score=550, payment_delay=5)),
        "r19": ("simple", dict(limit_factor=1.0)),
    },
}

# Billing rules run in every profile that names them; relaxed/strict add the
# documented batch rules so the default registry covers R18/R19 too.
for _p in ("relaxed", "strict"):
    PROFILES[_p]["r18"] = ("simple", dict(spending=400, credit_score=550, payment_delay=5))
    PROFILES[_p]["r19"] = ("simple", dict(limit_factor=1.0))

# Enriched R18 variant (profile joined onto CDR): spending, score and call volume.
R18_ENRICHED = dict(spending=400, credit_score=600, payment_delay=None, call_duration=500)


def predicate(rule_id: str, profile: str = "relaxed", overrides: dict | None = None) -> Column:
    form, params = PROFILES[profile][rule_id]
    if overrides:
        params = {**params, **overrides}
    return RULES_BY_ID[rule_id].forms[form](params)


def rules_for(stream: str, profile: str = "relaxed") -> list[Rule]:
    return [r for r in RULES if r.stream == stream and r.rule_id in PROFILES[profile]]


def streams() -> list[str]:
    return sorted({r.stream for r in RULES})
