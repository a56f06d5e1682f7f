"""Registered queries: risk scores (X01-X16), aggregates (A08-A20) and
alert conditions / classification (L01-L13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import latest_ts, minute_of, r, seconds_between, since
from ..operators import aggregates as ag
from ..operators import conditions as cd
from ..operators import joins as jn
from ..operators import scores as sc
from ..operators.rules import predicate
from ..sources import fixtures as fx
from ..sources.tables import Tables
from . import panels
from .catalog import register
from .q_core import rule_select_sql

c = F.col


def _pts(cond: str, n: int) -> str:
    return f"CASE WHEN {cond} THEN {n} ELSE 0 END"


def _profiles_asof(t):
    p = fx.profiles(t)
    return p, latest_ts(p, "account_creation_date")


ASOF_CREATED = "(SELECT max(account_creation_date) FROM profiles)"
X01_SCORE = " + ".join([_pts("monthly_spending > 400", 40), _pts("credit_score < 550", 30),
                        _pts("avg_payment_delay > 5", 20),
                        _pts(f"{ASOF_CREATED} - account_creation_date < 30", 10)])


@register("x01", f"""SELECT customer_id, {X01_SCORE} AS score,
  CASE WHEN {X01_SCORE} >= 70 THEN 'HIGH_RISK' WHEN {X01_SCORE} >= 50 THEN 'MEDIUM_RISK' ELSE 'LOW_RISK' END
  AS risk_level FROM profiles""", views=("profiles",))
def x01_subscription_score(spark, sf_dir):
    """Subscription (bad-debt) score 40/30/20/10 with HIGH/MEDIUM/LOW bands."""
    p, as_of = _profiles_asof(Tables(spark, sf_dir))
    return sc.subscription_score(p, as_of)


X02_SCORE = " + ".join([_pts("credit_score < 600", 30), _pts("NOT kyc_verified", 40),
                        _pts("registration_channel = 'Online'", 20), _pts("requested_plan = 'Unlimited'", 10)])


@register("x02", f"SELECT customer_id, {X02_SCORE} AS score, {X02_SCORE} > 70 AS require_deposit FROM profiles",
          views=("profiles",))
def x02_signup_risk(spark, sf_dir):
    """Signup risk 30/40/20/10; deposit above 70."""
    return sc.signup_risk(fx.profiles(Tables(spark, sf_dir)))


X03_SCORE = " + ".join([_pts("credit_score < 600", 35),
                        _pts("requested_plan = 'Unlimited' AND credit_score < 650", 25),
                        _pts("registration_channel = 'Online'", 15), _pts("NOT kyc_verified", 20),
                        _pts("NOT address_verified", 15)])


@register("x03", f"""SELECT customer_id, {X03_SCORE} AS score,
  CASE WHEN {X03_SCORE} >= 80 THEN 'REJECT' WHEN {X03_SCORE} >= 60 THEN 'REQUIRE_DEPOSIT'
       WHEN {X03_SCORE} >= 40 THEN 'APPROVE_WITH_LIMIT' ELSE 'APPROVE' END AS decision FROM profiles""",
          views=("profiles",))
def x03_first_party(spark, sf_dir):
    """First-party fraud score 35/25/15/20/15 with REJECT/DEPOSIT/LIMIT/APPROVE decisions."""
    return sc.first_party_fraud(fx.profiles(Tables(spark, sf_dir)))


HIGH_COST_SQL = "destination_iso IN ('CU', 'SO', 'LY', 'AF')"
X04_SCORE = " + ".join([_pts(HIGH_COST_SQL, 50), _pts("call_duration > 60", 30),
                        _pts("hour(ts) < 6 OR hour(ts) > 22", 10), _pts("calls_last_hour > 5", 10)])


@register("x04", f"""
WITH w AS (SELECT *, count(*) OVER (PARTITION BY customer_id ORDER BY ts
           RANGE BETWEEN INTERVAL 3600 SECOND PRECEDING AND CURRENT ROW) AS calls_last_hour FROM calls)
SELECT customer_id, ts, call_seq, l_linenumber, destination_iso, {X04_SCORE} AS score,
       CASE WHEN {X04_SCORE} >= 80 THEN 'BLOCK' WHEN {X04_SCORE} >= 60 THEN 'ALERT' ELSE 'ALLOW' END AS action
FROM w""", views=("calls",))
def x04_irsf_score(spark, sf_dir):
    """IRSF call score 50/30/10/10 (high-cost, long, night, burst); BLOCK >= 80, ALERT >= 60."""
    return sc.irsf_call_score(fx.calls(Tables(spark, sf_dir)))


@register("x05", f"""SELECT customer_id, ts, call_seq, l_linenumber, destination_iso, call_duration FROM calls
WHERE call_duration > 60 AND {HIGH_COST_SQL} AND hour(ts) BETWEEN 0 AND 5""", views=("calls",))
def x05_irsf_night(spark, sf_dir):
    """Long calls to high-cost countries between midnight and 6 am."""
    return sc.irsf_night_rule(fx.calls(Tables(spark, sf_dir)))


MODES_SQL = """
hc AS (SELECT customer_id, hour, count(*) AS n FROM sessions GROUP BY 1, 2),
peak AS (SELECT customer_id, hour AS typical_peak_hour FROM (SELECT *, row_number() OVER (
         PARTITION BY customer_id ORDER BY n DESC, hour) AS rn FROM hc) WHERE rn = 1),
lc AS (SELECT customer_id, location, count(*) AS n FROM sessions GROUP BY 1, 2),
loc AS (SELECT customer_id, location AS typical_location FROM (SELECT *, row_number() OVER (
        PARTITION BY customer_id ORDER BY n DESC, location) AS rn FROM lc) WHERE rn = 1)"""
X06_SCORE = " + ".join([_pts("abs(s.hour - typical_peak_hour) > 6", 30),
                        _pts("s.location <> typical_location", 40),
                        _pts("len(list_intersect(coalesce(s.apps, []), coalesce(typical_apps, []))) < 1", 20),
                        _pts("s.data_usage / NULLIF(tdu, 0) > 3", 10)])


@register("x06", f"""
WITH {MODES_SQL},
dat AS (SELECT customer_id, avg(data_usage) AS tdu, count(*) AS t FROM sessions GROUP BY 1),
ac AS (SELECT customer_id, app, count(*) AS n FROM (SELECT customer_id, unnest(list_distinct(apps)) AS app FROM sessions)
       GROUP BY 1, 2),
apps AS (SELECT customer_id, list_sort(list(app)) AS typical_apps FROM ac JOIN dat USING (customer_id)
         WHERE n >= 0.05 * t GROUP BY 1)
SELECT s.customer_id, s.event_id, {X06_SCORE} AS score,
       CASE WHEN {X06_SCORE} > 60 THEN 'LIKELY_TAKEOVER' WHEN {X06_SCORE} > 40 THEN 'SUSPICIOUS'
            ELSE 'NORMAL' END AS verdict
FROM sessions s JOIN peak USING (customer_id) JOIN loc USING (customer_id) LEFT JOIN apps USING (customer_id)
JOIN dat USING (customer_id)""", views=("sessions",))
def x06_takeover_score(spark, sf_dir):
    """Session vs profile takeover score 30/40/20/10 (hour, location, apps, data)."""
    return sc.takeover_score(fx.sessions(Tables(spark, sf_dir)))


X07_SCORE = " + ".join([_pts("u.hour IS NULL", 25), _pts("s.location <> typical_location", 35),
                        _pts("s.first_action = 'SIM_Swap_Request'", 40)])


@register("x07", f"""
WITH {MODES_SQL},
tot AS (SELECT customer_id, count(*) AS t FROM sessions GROUP BY 1),
u AS (SELECT hc.customer_id, hc.hour FROM hc JOIN tot USING (customer_id) WHERE hc.n >= 0.05 * tot.t)
SELECT s.customer_id, s.event_id, {X07_SCORE} AS score,
       CASE WHEN {X07_SCORE} > 70 THEN 'TAKEOVER' ELSE 'NORMAL' END AS verdict
FROM sessions s LEFT JOIN u ON s.customer_id = u.customer_id AND s.hour = u.hour
JOIN loc ON s.customer_id = loc.customer_id""", views=("sessions",))
def x07_session_anomaly(spark, sf_dir):
    """Session anomaly 25/35/40 (unusual hour, location, SIM-swap first); > 70 takeover."""
    return sc.session_anomaly(fx.sessions(Tables(spark, sf_dir)))


@register("x08", """
SELECT customer_id, kyc_level,
       CASE kyc_level WHEN 0 THEN 20.0 WHEN 1 THEN 100.0 WHEN 2 THEN 500.0 END::DOUBLE AS spending_limit,
       monthly_spending,
       coalesce(monthly_spending > CASE kyc_level WHEN 0 THEN 20.0 WHEN 1 THEN 100.0 WHEN 2 THEN 500.0 END, false)
         AS violation
FROM profiles""", views=("profiles",))
def x08_kyc_limits(spark, sf_dir):
    """KYC level -> allowed monthly spending and violations."""
    return sc.kyc_limits(fx.profiles(Tables(spark, sf_dir)))


@register("x09", f"""
SELECT customer_id, CAST({ASOF_CREATED} - account_creation_date AS INTEGER) AS account_age_days,
       ({ASOF_CREATED} - account_creation_date < 30) AND monthly_spending > 400 AS new_high_usage,
       NOT kyc_verified AND monthly_spending > 400 AS unverified_high_spend FROM profiles""", views=("profiles",))
def x09_new_account(spark, sf_dir):
    """New account with high usage; unverified KYC with high spending."""
    p, as_of = _profiles_asof(Tables(spark, sf_dir))
    return sc.new_account_flags(p, as_of)


@register("x10", """SELECT customer_id, internet_usage_gb, voice_minutes FROM internet_usage
WHERE internet_usage_gb > 40 AND voice_minutes = 0""", views=("internet_usage",))
def x10_voip_bypass(spark, sf_dir):
    """Heavy data use with zero call minutes (VoIP bypass)."""
    return sc.voip_bypass(fx.internet_usage(Tables(spark, sf_dir)))


@register("x11", """
WITH f AS (SELECT customer_id, CAST(min(ts) AS DATE) AS day FROM security_events GROUP BY customer_id, ip_address),
n AS (SELECT customer_id, day, count(*) AS new_ips FROM f GROUP BY 1, 2),
d AS (SELECT customer_id, CAST(ts AS DATE) AS day, bool_or(event_type = 'SIM_Swap_Request') AS req,
             bool_or(event_type = 'Device_Change') AS dev FROM security_events GROUP BY 1, 2)
SELECT d.customer_id, d.day, n.new_ips FROM d JOIN n USING (customer_id, day) WHERE req AND dev AND n.new_ips > 0""",
          views=("security_events",))
def x11_esim(spark, sf_dir):
    """Same-day eSIM/SIM-swap request with a new IP and a device change."""
    return sc.esim_takeover(fx.security_events(Tables(spark, sf_dir)))


@register("x12", """SELECT customer_id, event_ts, call_drop_count,
  CASE WHEN call_drop_count > 30 THEN 'high' ELSE 'elevated' END AS drop_level FROM cdr WHERE call_drop_count > 20""",
          views=("cdr",))
def x12_drop_flags(spark, sf_dir):
    """Dropped-call flags above 20 / 30."""
    return sc.drop_flags(fx.cdr(Tables(spark, sf_dir)))


@register("x13", """SELECT customer_id, event_ts, premium_sms_count,
  CASE WHEN premium_sms_count > 40 THEN 'alert' ELSE 'watch' END AS level FROM service WHERE premium_sms_count > 20""",
          views=("service",))
def x13_premium_sms(spark, sf_dir):
    """Premium-SMS monitor (watch above 20, alert above 40)."""
    return sc.premium_sms_monitor(fx.service(Tables(spark, sf_dir)))


Q20_SQL = """SELECT alert_type, count(*) AS total_cases, round(avg(duration_min), 4) AS avg_duration,
       min(timestamp) AS first_seen, max(timestamp) AS last_seen
FROM alerts WHERE timestamp >= (SELECT max(timestamp) FROM alerts) - INTERVAL 7 DAY GROUP BY 1"""


@register("x14", f"""
WITH q AS ({Q20_SQL})
SELECT alert_type, total_cases, avg_duration,
       CASE WHEN total_cases > 10000 AND avg_duration > 10 THEN 'CRITICAL - Immediate blocking'
            WHEN total_cases > 10000 THEN 'Automate detection'
            WHEN total_cases < 1000 AND avg_duration > 10 THEN 'Manual investigation'
            WHEN total_cases < 1000 THEN 'Monitor only' ELSE 'Review' END AS action FROM q""", views=("alerts",))
def x14_decision_matrix(spark, sf_dir):
    """Cases x duration decision matrix over the 7-day pattern analytics."""
    a = fx.alerts(Tables(spark, sf_dir))
    return sc.decision_matrix(panels.q20_pattern_analytics(a, latest_ts(a)))


@register("x15", "SELECT count(*) AS rows_scored, true AS flags_match, true AS held_out_agrees FROM cdr", views=("cdr",))
def x15_random_forest(spark, sf_dir):
    """Random-forest fraud probability on CDR features (label: any CDR rule fired), fitted without a
    fifth of the rows: rows scored, flags as the threshold says, agreement of at least 80 % on that fifth (the larger class has 55 %)."""
    cdr = fx.cdr(Tables(spark, sf_dir))
    label = F.coalesce(predicate("r01") | predicate("r02") | predicate("r03") | predicate("r04"), F.lit(False))
    rows = cdr.withColumn("label", label.cast("double")).withColumn("call_id", F.concat_ws("|", *cdr.columns))
    scored = sc.random_forest_scores(rows, rows.filter(~sc.held_out(c("call_id"))))
    agrees = (c("fraud_probability") >= 0.5) == (c("label") == 1.0)
    return scored.agg(F.count(F.lit(1)).alias("rows_scored"),
                      F.min(c("flagged") == (c("fraud_probability") > 0.85)).alias("flags_match"),
                      (F.avg(F.when(sc.held_out(c("call_id")), agrees.cast("double"))) >= 0.8).alias("held_out_agrees"))


@register("x16", """SELECT customer_id, monthly_spending > 400 AS high_spending, credit_score < 550 AS poor_credit,
  payment_method = 'Cash' AS cash_payer, avg_payment_delay > 15 AS late_payer,
  payment_behavior_index < 3.0 AS unreliable_payer,
  CAST(monthly_spending > 400 AS INTEGER) + CAST(credit_score < 550 AS INTEGER) + CAST(payment_method = 'Cash' AS INTEGER)
  + CAST(avg_payment_delay > 15 AS INTEGER) + CAST(payment_behavior_index < 3.0 AS INTEGER) AS flag_count
FROM billing""", views=("billing",))
def x16_payment_flags(spark, sf_dir):
    """Payment risk flags (spending, score, cash, delay, behaviour index) and their count."""
    return sc.payment_flags(fx.billing(Tables(spark, sf_dir)))


# ------------------------------------------------------------ aggregates --

@register("a08", """SELECT CAST(timestamp AS DATE) AS metric_date, count(*) AS total_fraud_blocked,
  round(sum(fraud_value_estimate), 4) AS total_value_blocked,
  round(avg(CAST(date_diff('second', timestamp, detection_timestamp) AS DOUBLE)), 4) AS avg_response_time_sec,
  round(count(DISTINCT date_trunc('minute', timestamp)) * 100.0 / 1440, 4) AS system_uptime_pct
FROM alerts_ext GROUP BY 1""", views=("alerts", "alerts_ext"))
def a08_daily_metrics(spark, sf_dir):
    """Daily fraud_metrics table: count, value, response time, active-minute share."""
    return panels.a08_daily_fraud_metrics(fx.alerts_ext(Tables(spark, sf_dir)))


@register("a09", """SELECT customer_id, date_trunc('hour', ts) AS hour, count(*) AS calls,
  round(sum(call_duration), 4) AS minutes, count(DISTINCT destination_country) AS unique_destinations
FROM calls GROUP BY 1, 2""", views=("calls",))
def a09_hourly_usage(spark, sf_dir):
    """Hourly calls, minutes and distinct destinations per customer."""
    return ag.hourly_usage(fx.calls(Tables(spark, sf_dir)))


@register("a09_value", """SELECT customer_id, CAST(date_trunc('month', ts) AS DATE) AS month,
  round(sum(call_duration * 0.05), 4) AS value FROM calls GROUP BY 1, 2""", views=("calls",))
def a09_monthly_value(spark, sf_dir):
    """Monthly customer value."""
    return ag.monthly_value(fx.calls(Tables(spark, sf_dir)))


@register("a10", """SELECT customer_id, count(*) AS weekend_calls, round(sum(call_duration), 4) AS total_duration,
  count(DISTINCT destination_country) AS country_count FROM calls
WHERE customer_segment = 'Business' AND dayofweek(ts) IN (0, 6) AND (hour(ts) >= 22 OR hour(ts) <= 6)
GROUP BY 1 HAVING count(*) > 100 AND count(DISTINCT destination_country) > 10""", views=("calls",))
def a10_pbx(spark, sf_dir):
    """Compromised-PBX detection: business lines, weekend nights, > 100 calls, > 10 countries."""
    return ag.pbx_hacking(fx.calls(Tables(spark, sf_dir)))


@register("a11", """SELECT customer_id, count(DISTINCT cell_tower_id) AS unique_towers,
  count(DISTINCT cell_tower_id) < 3 AS stationary FROM location GROUP BY 1""", views=("location",))
def a11_tower_diversity(spark, sf_dir):
    """Distinct towers per customer (fewer than 3 = stationary)."""
    return ag.tower_diversity(fx.location(Tables(spark, sf_dir)))


@register("a12", """
WITH d AS (SELECT *, starts_with(dialed_number, '1-900') OR starts_with(dialed_number, '809')
                     OR starts_with(dialed_number, '876') AS is_premium
           FROM day_calls WHERE ts >= (SELECT max(ts) FROM day_calls) - INTERVAL 24 HOUR),
g AS (SELECT customer_id, count(DISTINCT dialed_number) AS unique_numbers, coalesce(bool_or(is_premium), false) AS premium
      FROM d GROUP BY 1)
SELECT customer_id, unique_numbers, premium,
  CASE WHEN unique_numbers > 1000 THEN 'mass dialer' WHEN premium THEN 'premium-rate' END AS warning FROM g""",
          views=("day_calls",))
def a12_mass_dialers(spark, sf_dir):
    """Calling customers in the last 24 h: distinct numbers reached, premium flag, warning."""
    calls = fx.day_calls(Tables(spark, sf_dir))
    return ag.mass_dialers(calls, latest_ts(calls, "ts"))


BENFORD_SQL = ", ".join(f"count(*) FILTER (WHERE d = {i}) AS d{i}" for i in range(1, 10))
CHI_SQL = " + ".join(f"(d{i} - n * {p}) * (d{i} - n * {p}) / (n * {p})" for i, p in enumerate(ag.BENFORD, 1))


@register("a13", f"""
WITH x AS (SELECT customer_id, CAST(substr(CAST(CAST(floor(call_duration) AS BIGINT) AS VARCHAR), 1, 1) AS INTEGER) AS d
           FROM calls WHERE call_duration > 0),
g AS (SELECT customer_id, count(*) AS n, {BENFORD_SQL} FROM x GROUP BY 1)
SELECT customer_id, n, round({CHI_SQL}, 4) AS chi2, {CHI_SQL} > 20.090 AS violates_benford FROM g WHERE n >= 30""",
          views=("calls",))
def a13_benford(spark, sf_dir):
    """Benford first-digit chi-square per customer (flag above 20.090, df 8, p < 0.01)."""
    return ag.benford(fx.calls(Tables(spark, sf_dir)))


@register("a14", """
WITH d AS (SELECT complaint_category, CAST(created_at AS DATE) AS day, count(*) AS n FROM complaints GROUP BY 1, 2),
t AS (SELECT a.complaint_category, a.day, a.n, round(coalesce(sum(b.n), 0) / 7.0, 4) AS trailing_mean
      FROM d a LEFT JOIN d b ON a.complaint_category = b.complaint_category AND b.day BETWEEN a.day - 7 AND a.day - 1
      GROUP BY 1, 2, 3)
SELECT * FROM t WHERE trailing_mean > 0 AND n > 2 * trailing_mean""", views=("complaints",))
def a14_complaint_spikes(spark, sf_dir):
    """Daily complaint counts per category above twice the trailing 7-day mean."""
    return ag.complaint_spikes(fx.complaints(Tables(spark, sf_dir)))


@register("a14_stale", """SELECT complaint_id, customer_id, resolution_time_hours, created_at FROM complaints
WHERE complaint_category = 'Fraud' AND complaint_status = 'open' AND resolution_time_hours > 48""",
          views=("complaints",))
def a14_stale_fraud(spark, sf_dir):
    """Open fraud complaints unresolved for more than 48 hours."""
    return ag.stale_fraud_complaints(fx.complaints(Tables(spark, sf_dir)))


@register("a15", """SELECT count(*) AS n, round(avg(monthly_spending), 4) AS mean,
  round(stddev_samp(monthly_spending), 4) AS std, round(quantile_cont(monthly_spending, 0.5), 4) AS median,
  round(quantile_cont(monthly_spending, 0.25), 4) AS p25, round(quantile_cont(monthly_spending, 0.75), 4) AS p75,
  count(*) FILTER (WHERE abs(monthly_spending - (SELECT avg(monthly_spending) FROM billing))
                         / (SELECT stddev_samp(monthly_spending) FROM billing) > 3) AS outliers
FROM billing""", views=("billing",))
def a15_population(spark, sf_dir):
    """Population statistics of monthly spending and the |z| > 3 outlier count."""
    return ag.population_outliers(fx.billing(Tables(spark, sf_dir)), "monthly_spending")


@register("a16", """SELECT customer_id, days_in_roaming, monthly_spending FROM profiles
WHERE days_in_roaming > 90 AND monthly_spending > 200""", views=("profiles",))
def a16_permanent_roamers(spark, sf_dir):
    """Permanent roamers: more than 90 days roaming and spending above 200."""
    return ag.permanent_roamers(fx.profiles(Tables(spark, sf_dir)))


@register("a17", """SELECT CAST(timestamp AS DATE) AS day, count(*) AS alerts,
  round(avg(fraud_value_estimate), 4) AS avg_value, round(avg(CAST(false_positive AS DOUBLE)), 4) AS false_positive_rate,
  round(avg(CAST(date_diff('second', timestamp, detection_timestamp) AS DOUBLE)), 4) AS avg_time_to_detect_sec
FROM alerts_ext GROUP BY 1""", views=("alerts", "alerts_ext"))
def a17_kpis(spark, sf_dir):
    """Daily KPIs: alerts, average value, false-positive rate, time to detect."""
    return ag.daily_kpis(fx.alerts_ext(Tables(spark, sf_dir)))


@register("a18", """
WITH g AS (SELECT customer_id, CAST(ts AS DATE) AS day,
                  sum(CASE WHEN destination_country <> customer_id THEN call_duration ELSE 0.0 END) AS im,
                  round(sum(call_cost_raw * CAST(0.001 AS DOUBLE)), 5) AS spend,
                  round(max(call_cost_raw * CAST(0.001 AS DOUBLE)), 5) AS max_call_cost
           FROM calls GROUP BY 1, 2),
t AS (SELECT a.customer_id, a.day, coalesce(sum(b.im), 0) / 30.0 AS tr FROM g a LEFT JOIN g b
      ON a.customer_id = b.customer_id AND b.day BETWEEN a.day - 30 AND a.day - 1 GROUP BY 1, 2)
SELECT customer_id, day, round(im, 4) AS intl_minutes, round(tr, 4) AS intl_trailing, spend, max_call_cost,
       spend > 100 AS over_daily_spend, max_call_cost > 10 AS expensive_call, tr > 0 AND im > 3 * tr AS intl_spike
FROM g JOIN t USING (customer_id, day) WHERE spend > 100 OR max_call_cost > 10 OR (tr > 0 AND im > 3 * tr)""", views=("calls",))
def a18_daily_spend(spark, sf_dir):
    """Per customer-day: international minutes above 3 x the trailing 30-day mean, spend > $100/day, calls costing > $10."""
    return ag.daily_spend_flags(fx.calls(Tables(spark, sf_dir)))


@register("a19", """
WITH g AS (SELECT CAST(date_trunc('week', timestamp) AS DATE) AS week, count(*) AS alerts,
                  sum(duration_min * 0.05) AS value, count(DISTINCT CAST(timestamp AS DATE)) AS active_days
           FROM alerts GROUP BY 1),
d AS (SELECT CAST(timestamp AS DATE) AS day, sum(duration_min * 0.05) AS value FROM alerts GROUP BY 1),
m AS (SELECT g.week, sum(d.value) AS v30 FROM g JOIN d ON d.day BETWEEN g.week - 23 AND g.week + 6 GROUP BY 1)
SELECT a.week, a.alerts, round(a.value, 4) AS value, round(a.value / a.active_days * 365, 4) AS annual_run_rate, round(m.v30, 4) AS value_30d,
       round(b.value, 4) AS prev_value, round((a.value - b.value) * 100.0 / NULLIF(b.value, 0), 4) AS wow_change_pct
FROM g a JOIN m USING (week) LEFT JOIN g b ON b.week = a.week - 7""", views=("alerts",))
def a19_run_rate(spark, sf_dir):
    """Weekly totals, the 30 days up to each week's end, annual run rate and week-over-week change."""
    return ag.weekly_run_rate(fx.alerts(Tables(spark, sf_dir)))


@register("a20", """
SELECT coalesce(r.r_name, 'UNKNOWN') AS region, count(*) AS alerts, round(avg(a.duration_min * 0.05), 4) AS avg_value
FROM alerts a LEFT JOIN customer cu ON CAST(cu.c_custkey AS VARCHAR) = a.caller_number
LEFT JOIN nation n ON cu.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY 1""", views=("alerts",))
def a20_by_region(spark, sf_dir):
    """Alerts and average fraud value by the caller's region."""
    t = Tables(spark, sf_dir)
    prof = t.customer.select(c("c_custkey").alias("customer_id"), "c_nationkey")
    return ag.alerts_by_region(jn.enrich_chain(fx.alerts(t), prof, t.nation, t.region))


# ------------------------------------------------------------ conditions --

ASOF = "(SELECT max(timestamp) FROM alerts)"


@register("l01", """SELECT time_bucket(INTERVAL 5 MINUTE, timestamp) AS window_start,
  time_bucket(INTERVAL 5 MINUTE, timestamp) + INTERVAL 5 MINUTE AS window_end, count(*) AS alerts,
  count(*) > 100 AS fired FROM alerts GROUP BY 1, 2""", views=("alerts",))
def l01_burst(spark, sf_dir):
    """More than 100 alerts in a 5-minute window."""
    return cd.burst_windows(fx.alerts(Tables(spark, sf_dir)), 5, 100)


@register("l02", """
WITH l AS (SELECT timestamp, lag(timestamp) OVER (ORDER BY timestamp, call_id) AS p FROM alerts)
SELECT p AS gap_start, timestamp AS gap_end, CAST(date_diff('second', p, timestamp) AS BIGINT) AS gap_seconds
FROM l WHERE date_diff('second', p, timestamp) > 120""", views=("alerts",))
def l02_silence(spark, sf_dir):
    """Gaps of more than 2 minutes without any alert."""
    return cd.silence_gaps(fx.alerts(Tables(spark, sf_dir)), 120)


@register("l03", """SELECT time_bucket(INTERVAL 10 MINUTE, timestamp) AS window_start,
  time_bucket(INTERVAL 10 MINUTE, timestamp) + INTERVAL 10 MINUTE AS window_end, count(*) AS alerts,
  count(*) > 20 AS fired FROM alerts WHERE starts_with(alert_type, 'SIM Box') GROUP BY 1, 2""", views=("alerts",))
def l03_simbox_spike(spark, sf_dir):
    """SIM-box alerts per 10-minute window, fired above 20."""
    return cd.burst_windows(fx.alerts(Tables(spark, sf_dir)), 10, 20, alert_type_prefix="SIM Box")


@register("l04", f"""
WITH a AS (SELECT CAST(date_diff('second', timestamp, {ASOF}) AS DOUBLE) AS age FROM alerts
           WHERE timestamp >= {ASOF} - INTERVAL 1 HOUR),
p AS (SELECT round(quantile_cont(age, 0.95), 4) AS v FROM a)
SELECT 'P95' AS metric, v AS value_sec, CASE WHEN v > 30 THEN 'BREACH' WHEN v > 10 THEN 'WARN' ELSE 'OK' END
       AS status FROM p""", views=("alerts",))
def l04_latency_sla(spark, sf_dir):
    """P95 detection age against the 30 s SLA (10 s warning)."""
    a = fx.alerts(Tables(spark, sf_dir))
    return cd.latency_sla(panels.q13_detection_latency(a, latest_ts(a)))


def _metrics(alerts, as_of):
    last_h = since(as_of, "timestamp", "1 HOUR")
    return alerts.agg(
        r(F.sum(F.when(since(as_of, "timestamp", "24 HOURS"), c("duration_min") * 0.05))).alias("value_24h"),
        F.count_if(last_h).alias("alerts_last_hour"),
        seconds_between(F.max("timestamp"), as_of).alias("freshness_sec"),
        r(F.count_if(last_h) / 60.0).alias("alerts_per_min"))


@register("l05", f"""
WITH m AS (SELECT round(sum(CASE WHEN timestamp >= {ASOF} - INTERVAL 24 HOUR THEN duration_min * 0.05 END), 4) AS v24,
                  count(*) FILTER (WHERE timestamp >= {ASOF} - INTERVAL 1 HOUR) AS h1,
                  date_diff('second', max(timestamp), {ASOF}) AS fr,
                  round(count(*) FILTER (WHERE timestamp >= {ASOF} - INTERVAL 1 HOUR) / 60.0, 4) AS pm FROM alerts)
SELECT 'value_24h_above_10000' AS condition, CAST(v24 AS DOUBLE) AS value, v24 > 10000 AS fired FROM m
UNION ALL SELECT 'alerts_per_hour_above_100', CAST(h1 AS DOUBLE), h1 > 100 FROM m
UNION ALL SELECT 'freshness_above_60s', CAST(fr AS DOUBLE), fr > 60 FROM m
UNION ALL SELECT 'rate_below_5_per_min', CAST(pm AS DOUBLE), pm < 5 FROM m""", views=("alerts",))
def l05_thresholds(spark, sf_dir):
    """Operational conditions: value 24 h, alerts per hour, freshness, alert rate."""
    a = fx.alerts(Tables(spark, sf_dir))
    return cd.threshold_checks(_metrics(a, latest_ts(a)))


@register("l06", """
SELECT DISTINCT alert_type FROM campaign_alerts WHERE timestamp >= (SELECT max(timestamp) FROM campaign_alerts) - INTERVAL 24 HOUR
EXCEPT SELECT DISTINCT alert_type FROM campaign_alerts WHERE timestamp < (SELECT max(timestamp) FROM campaign_alerts) - INTERVAL 24 HOUR""", views=("campaign_alerts",))
def l06_new_types(spark, sf_dir):
    """Alert types seen in the last 24 h and never before."""
    a = fx.campaign_alerts(Tables(spark, sf_dir))
    return cd.new_types(a, latest_ts(a))


@register("l07", f"""
WITH m AS (SELECT round(sum(duration_min * 0.05) FILTER (WHERE timestamp >= {ASOF} - INTERVAL 24 HOUR), 4) AS bv,
                  count(*) FILTER (WHERE timestamp >= {ASOF} - INTERVAL 1 HOUR) AS h1,
                  count(*) FILTER (WHERE timestamp >= {ASOF} - INTERVAL 24 HOUR) AS h24,
                  date_diff('second', max(timestamp), {ASOF}) AS fr,
                  round(quantile_cont(CAST(date_diff('second', timestamp, {ASOF}) AS DOUBLE), 0.95)
                        FILTER (WHERE timestamp >= {ASOF} - INTERVAL 1 HOUR), 4) AS p95 FROM alerts),
v AS (SELECT bv, round(h1 * 100.0 / NULLIF(h24, 0), 4) AS sr, h1, fr, p95 FROM m)
SELECT bv AS blocked_value, CASE WHEN bv >= 5000 THEN 'red' WHEN bv >= 1000 THEN 'yellow' ELSE 'green' END AS blocked_value_colour,
       sr AS success_rate, CASE WHEN sr >= 90 THEN 'green' WHEN sr >= 70 THEN 'yellow' ELSE 'red' END AS success_rate_colour,
       h1 AS alerts_last_hour, CASE WHEN h1 >= 50 THEN 'red' WHEN h1 >= 10 THEN 'yellow' ELSE 'green' END AS alerts_last_hour_colour,
       fr AS data_freshness, CASE WHEN fr >= 60 THEN 'red' WHEN fr >= 10 THEN 'yellow' ELSE 'green' END AS data_freshness_colour,
       p95 AS latency_p95, CASE WHEN p95 >= 20 THEN 'red' WHEN p95 >= 10 THEN 'orange' WHEN p95 >= 5 THEN 'yellow'
                                ELSE 'green' END AS latency_p95_colour FROM v""", views=("alerts",))
def l07_colours(spark, sf_dir):
    """Dashboard threshold colours of the headline panel values, one scan."""
    a = fx.alerts(Tables(spark, sf_dir))
    as_of = latest_ts(a)
    h1 = since(as_of, "timestamp", "1 HOUR")
    h24 = since(as_of, "timestamp", "24 HOURS")
    age = seconds_between("timestamp", as_of).cast("double")
    m = a.agg(r(F.sum(F.when(h24, c("duration_min") * 0.05))).alias("blocked_value"),
              r(F.try_divide(F.count_if(h1) * 100.0, F.count_if(h24).cast("double"))).alias("success_rate"),
              F.count_if(h1).alias("alerts_last_hour"),
              seconds_between(F.max("timestamp"), as_of).alias("data_freshness"),
              r(F.percentile(F.when(h1, age), 0.95)).alias("latency_p95"))
    return m.select(*[x for name in cd.PANEL_THRESHOLDS
                      for x in (c(name), cd.colour(name, c(name)).alias(f"{name}_colour"))])


R20_CTE = "WITH r20 AS (" + " UNION ALL ".join(rule_select_sql(f"r{i:02d}") for i in range(1, 18)) + ")\n"


@register("l08", R20_CTE + """
SELECT alert_type, severity, CASE severity WHEN 'Critical' THEN 'block' WHEN 'High' THEN 'notify'
       WHEN 'Medium' THEN 'monitor' ELSE 'log' END AS policy, count(*) AS alerts FROM (
  SELECT alert_type, CASE WHEN starts_with(s, 'Critical') THEN 'Critical' WHEN starts_with(s, 'High') THEN 'High'
         WHEN starts_with(s, 'Medium') THEN 'Medium' ELSE 'Low' END AS severity
  FROM (SELECT alert_type, regexp_extract(alert_type, '\\[([^\\]]*)\\]\\s*$', 1) AS s FROM r20)) GROUP BY 1, 2, 3""",
          views=fx.EVENT_STREAMS)
def l08_severity_policy(spark, sf_dir):
    """Severity parsed from the alert type and its policy, over all rule alerts."""
    from ..operators.detect import detect_all
    t = Tables(spark, sf_dir)
    alerts = detect_all({s: fx.stream(t, s) for s in fx.EVENT_STREAMS}, "relaxed")
    # Severity depends only on the type: count per type first, classify the few rows after.
    per_type = alerts.groupBy("alert_type").agg(F.count(F.lit(1)).alias("alerts"))
    return cd.severity_policy(per_type).select("alert_type", "severity", "policy", "alerts")


@register("l09", """SELECT coalesce(caller_number, call_id) AS target_id, coalesce(alert_type, 'Unknown Fraud') AS reason,
  coalesce(caller_number, call_id) IS NULL AS missing_id FROM alerts""", views=("alerts",))
def l09_action_records(spark, sf_dir):
    """Action-topic records: target id, reason (default 'Unknown Fraud'), missing-id warning."""
    return cd.action_records(fx.alerts(Tables(spark, sf_dir))).drop("payload")


@register("l10", """
WITH m(pattern, action) AS (VALUES ('SIM Box', 'Block immediately'), ('Wangiri', 'Block + investigate'),
  ('IRSF', 'Block int''l calls'), ('SIM Swap', 'Freeze account'), ('Credit Abuse', 'Limit services'))
SELECT alert_type, m.pattern, m.action, count(*) AS alerts FROM alerts
LEFT JOIN m ON starts_with(alert_type, CASE WHEN m.pattern = 'SIM Swap' THEN 'SIM Swap' ELSE m.pattern END)
GROUP BY 1, 2, 3""", views=("alerts",))
def l10_actions(spark, sf_dir):
    """Alerts joined to the pattern -> action coverage matrix."""
    per_type = fx.alerts(Tables(spark, sf_dir)).groupBy("alert_type").agg(F.count(F.lit(1)).alias("alerts"))
    return cd.with_actions(spark, per_type).select("alert_type", "pattern", "action", "alerts")


@register("l11", """SELECT call_id, fraud_value_estimate, detection_timestamp, action_taken FROM alerts_ext""",
          views=("alerts", "alerts_ext"))
def l11_planned_columns(spark, sf_dir):
    """Alert extra columns: value estimate, detection timestamp, action_taken = 'PENDING'."""
    a = fx.alerts(Tables(spark, sf_dir))
    det = F.timestamp_add("SECOND", (c("call_id").cast("long") * 7) % 30, c("timestamp"))
    return cd.with_planned_columns(a, detection_ts=det).select(
        "call_id", "fraud_value_estimate", "detection_timestamp", "action_taken")


@register("l12", """
WITH t(pattern, victim, perpetrator, difficulty_level) AS (VALUES ('SIM Box', 'Revenue', 'External', 1),
  ('Wangiri', 'Customer', 'External', 1), ('IRSF', 'Revenue', 'External', 2), ('SIM Swap', 'Customer', 'External', 2),
  ('Credit Abuse', 'Revenue', 'Subscriber', 1))
SELECT t.victim, t.perpetrator, t.difficulty_level, count(*) AS alerts FROM alerts
JOIN t ON starts_with(alert_type, t.pattern) GROUP BY 1, 2, 3""", views=("alerts",))
def l12_taxonomy(spark, sf_dir):
    """Alert counts by victim, perpetrator and detection difficulty."""
    per_type = fx.alerts(Tables(spark, sf_dir)).groupBy("alert_type").agg(F.count(F.lit(1)).alias("n"))
    a = cd.with_taxonomy(spark, per_type)
    return a.groupBy("victim", "perpetrator", "difficulty_level").agg(F.sum("n").alias("alerts"))


@register("l13", f"""
WITH q AS ({Q20_SQL})
SELECT alert_type, first_seen, last_seen,
       CASE WHEN CAST(first_seen AS DATE) = CAST({ASOF} AS DATE) THEN 'emerging'
            WHEN CAST({ASOF} AS DATE) - CAST(last_seen AS DATE) >= 5 THEN 'stopped' ELSE 'active' END AS lifecycle
FROM q""", views=("alerts",))
def l13_lifecycle(spark, sf_dir):
    """Alert-type lifecycle: emerging / stopped / active over the 7-day analytics."""
    a = fx.alerts(Tables(spark, sf_dir))
    as_of = latest_ts(a)
    return cd.type_lifecycle(panels.q20_pattern_analytics(a, as_of), as_of)
