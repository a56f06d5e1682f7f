"""Registered queries: joins (J02-J14) and the enriched R18 variant."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import latest_ts, since
from ..operators import joins as jn
from ..operators.detect import detect
from ..operators import rings
from ..operators.rules import R18_ENRICHED
from ..sources import fixtures as fx
from ..sources import lookups
from ..sources.tables import Tables
from .catalog import register

c = F.col
PREMIUM_SQL = ("(starts_with({x}, '1-900') OR starts_with({x}, '809') OR starts_with({x}, '876'))")
BILLING_COLS = ["customer_id", "monthly_spending", "credit_score", "credit_limit", "payment_method"]


def _enriched_cdr(t):
    return jn.enrich_with_profile(fx.cdr(t), fx.billing(t).select(*BILLING_COLS))


@register("j02", """SELECT c.*, b.monthly_spending, b.credit_score, b.credit_limit, b.payment_method
FROM cdr c LEFT JOIN billing b USING (customer_id)""", views=("cdr", "billing"))
def j02_enrich(spark, sf_dir):
    """CDR events left-joined to the customer's billing profile."""
    return _enriched_cdr(Tables(spark, sf_dir))


@register("r18_enriched", """
SELECT customer_id AS call_id, customer_id AS caller_number, 'N/A' AS receiver_number,
       monthly_spending AS duration_min, date_trunc('second', cdr.event_ts) AS timestamp,
       'Subscription Fraud (Bad Debt)' AS alert_type, 'r18' AS rule_id
FROM cdr JOIN billing USING (customer_id)
WHERE monthly_spending > 400 AND credit_score < 600 AND monthly_call_duration > 500""", views=("cdr", "billing"))
def r18_enriched(spark, sf_dir):
    """Bad-debt rule on profile-enriched CDR (spending > 400, score < 600, minutes > 500)."""
    return detect(_enriched_cdr(Tables(spark, sf_dir)), "billing", "basic", rule_ids=["r18"],
                  overrides={"r18": R18_ENRICHED})


@register("j04", """
SELECT a.*, cu.c_nationkey, n.n_name, r.r_name
FROM alerts a LEFT JOIN (SELECT CAST(c_custkey AS VARCHAR) AS caller_number, c_nationkey FROM customer) cu
     USING (caller_number)
LEFT JOIN nation n ON cu.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
          views=("alerts",))
def j04_lookup_chain(spark, sf_dir):
    """Alerts enriched through the chain profile -> nation -> region."""
    t = Tables(spark, sf_dir)
    prof = t.customer.select(c("c_custkey").alias("customer_id"), "c_nationkey")
    return jn.enrich_chain(fx.alerts(t), prof, t.nation, t.region)


@register("j05", """SELECT customer_id, event_ts FROM cdr c
WHERE NOT EXISTS (SELECT 1 FROM billing b WHERE b.customer_id = c.customer_id)""", views=("cdr", "billing"))
def j05_orphans(spark, sf_dir):
    """CDR events whose customer has no profile (left anti join)."""
    t = Tables(spark, sf_dir)
    return jn.orphans(fx.cdr(t).select("customer_id", "event_ts"), fx.billing(t))


@register("j06a", """SELECT device_id, customer_id, imei, tac_code FROM devices
WHERE tac_code NOT IN ('35332510', '35391805', '35875604', '01326300', '35925406')""", views=("devices",))
def j06a_unregistered(spark, sf_dir):
    """Devices whose TAC is not registered (anti join with the TAC registry)."""
    d = fx.devices(Tables(spark, sf_dir)).select("device_id", "customer_id", "imei", "tac_code")
    return jn.unregistered_devices(d, lookups.tac_registry(spark))


@register("j06b", """SELECT * FROM alerts a WHERE EXISTS (SELECT 1 FROM devices d
WHERE CAST(d.customer_id AS VARCHAR) = a.caller_number AND d.device_status IN ('blacklisted', 'stolen'))""",
          views=("alerts", "devices"))
def j06b_flagged_devices(spark, sf_dir):
    """Alerts of callers owning a blacklisted or stolen device (semi join)."""
    t = Tables(spark, sf_dir)
    return jn.alerts_on_flagged_devices(fx.alerts(t), fx.devices(t))


@register("j07", f"""
SELECT b.customer_id, b.dialed_number, r.ts AS ring_ts, r.call_seq AS ring_seq, r.l_linenumber AS ring_line,
       b.ts AS callback_ts, b.call_seq, b.l_linenumber, b.call_duration
FROM busy_calls r JOIN busy_calls b ON r.customer_id = b.customer_id AND r.dialed_number = b.dialed_number
     AND b.ts BETWEEN r.ts AND r.ts + INTERVAL 300 SECOND
WHERE r.call_duration < 3 AND b.call_duration > 3 AND {PREMIUM_SQL.format(x='b.dialed_number')}""",
          views=("busy_calls",))
def j07_callbacks(spark, sf_dir):
    """Callbacks to a premium number within 5 minutes of one-ring calls from it, each with each of its rings."""
    return jn.callbacks_after_ring(fx.busy_calls(Tables(spark, sf_dir)))


@register("j08", """
WITH l AS (SELECT *, lag(geo_location) OVER (PARTITION BY customer_id ORDER BY ts, event_id) AS pg FROM security_events),
w AS (SELECT *, count(*) FILTER (WHERE event_type = 'Device_Change') OVER d AS devices,
             count(*) FILTER (WHERE event_type = 'Password_Reset') OVER d AS resets,
             count(*) FILTER (WHERE pg <> geo_location) OVER d AS moves
      FROM l WINDOW d AS (PARTITION BY customer_id ORDER BY ts RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW)),
g AS (SELECT customer_id, CAST(ts AS DATE) AS day, bool_or(event_type = 'SIM_Swap_Request') AS sim_swap,
             bool_or(event_type = 'Password_Reset') AS pwd, bool_or(devices > 0 AND resets > 0 AND moves > 0) AS dev
      FROM w GROUP BY 1, 2)
SELECT customer_id, day, sim_swap AND pwd AS sim_swap_takeover, dev AS device_takeover
FROM g WHERE (sim_swap AND pwd) OR dev""", views=("security_events",))
def j08_takeover(spark, sf_dir):
    """Same-day SIM-swap + password reset, and new device + location change + reset within 24 hours."""
    return jn.takeover_correlation(fx.security_events(Tables(spark, sf_dir)))


@register("j09", """
WITH v AS (SELECT customer_id, updated_at, arg_max(credit_limit, change_seq) AS credit_limit,
                  arg_max(credit_score, change_seq) AS credit_score, arg_max(__deleted, change_seq) AS del
           FROM profile_changes GROUP BY 1, 2)
SELECT p.*, CASE WHEN v.del = 'true' THEN NULL ELSE v.credit_limit END AS credit_limit,
       CASE WHEN v.del = 'true' THEN NULL ELSE v.credit_score END AS credit_score
FROM payments p ASOF LEFT JOIN v ON p.customer_id = v.customer_id AND p.event_ts >= v.updated_at""",
          views=("payments", "profile_changes"))
def j09_as_of(spark, sf_dir):
    """Payment events with the profile version valid at event time (as-of join; deletes close)."""
    t = Tables(spark, sf_dir)
    return jn.as_of_profile(fx.payments(t), fx.profile_changes(t))


FRAUD_TYPES = ["SIM Box", "Wangiri", "IRSF", "SIM Swap", "Credit Abuse"]
_MASK_SQL = " + ".join(f"max(CASE WHEN starts_with(alert_type, '{x}') THEN {1 << i} ELSE 0 END)" for i, x in enumerate(FRAUD_TYPES))


@register("j10", """
WITH RECURSIVE a AS (SELECT DISTINCT 'ip' AS kind, ip_address AS value, CAST(customer_id AS VARCHAR) AS account FROM security_events
      WHERE customer_id % 3 < 2
      UNION SELECT kind, value, account FROM addresses),
p AS (SELECT *, count(*) OVER (PARTITION BY kind, value) AS members FROM a),
s AS (SELECT * FROM p WHERE members >= 2),
e AS (SELECT DISTINCT x.account AS a, y.account AS b FROM s x JOIN s y USING (kind, value)),
r AS (SELECT a AS account, a AS node FROM e UNION SELECT r.account, e.b FROM r JOIN e ON e.a = r.node),
m AS (SELECT account, min(node) AS ring FROM r GROUP BY 1),
n AS (SELECT account, count(*) AS shared_values FROM s GROUP BY 1)
SELECT account, ring, count(*) OVER (PARTITION BY ring) AS ring_size, shared_values FROM m JOIN n USING (account)""",
          views=("security_events", "addresses"))
def j10_rings(spark, sf_dir):
    """Rings of accounts over shared IP addresses and postal addresses (connected components)."""
    t = Tables(spark, sf_dir)
    ips = fx.security_events(t).filter("customer_id % 3 < 2").select(F.lit("ip").alias("kind"), c("ip_address").alias("value"), c("customer_id").cast("string").alias("account"))
    return rings.account_rings(ips.unionByName(fx.addresses(t)))


@register("j10_types", f"""
WITH m AS (SELECT caller_number AS account, {_MASK_SQL} AS mask FROM alerts
           WHERE timestamp >= (SELECT max(timestamp) FROM alerts) - INTERVAL 24 HOUR GROUP BY 1)
SELECT 'types' AS kind, CAST(mask AS VARCHAR) AS value, account, count(*) OVER (PARTITION BY mask) AS members
FROM m WHERE mask > 0 QUALIFY members >= 2""", views=("alerts",))
def j10_type_sets(spark, sf_dir):
    """Callers with the same set of fraud types in the last 24 hours (bit mask)."""
    a = fx.alerts(Tables(spark, sf_dir))
    recent = a.filter(c("timestamp") >= latest_ts(a) - F.expr("INTERVAL 24 HOURS"))
    return rings.shared_values(rings.type_sets(recent, FRAUD_TYPES))


@register("j11", """
WITH m AS (SELECT tower_id, count(*) AS measurements, avg(network_downtime_minutes) AS ad FROM network_metrics GROUP BY 1),
v AS (SELECT CAST(regexp_extract(cell_tower_id, '(\\d+)', 1) AS BIGINT) AS tower_id, count(*) AS events
      FROM location GROUP BY 1)
SELECT m.tower_id, m.measurements, round(m.ad, 4) AS avg_downtime, coalesce(v.events, 0) AS events
FROM m LEFT JOIN v USING (tower_id)""", views=("network_metrics", "location"))
def j11_tower_load(spark, sf_dir):
    """Tower downtime next to the location-event volume through the tower."""
    t = Tables(spark, sf_dir)
    return jn.tower_load(fx.network_metrics(t), fx.location(t))


@register("j12", """
WITH h AS (SELECT customer_id, count(*) AS complaints,
                  count(*) FILTER (WHERE complaint_category = 'Fraud') AS fraud_complaints,
                  count(*) FILTER (WHERE complaint_status = 'open') AS open_complaints FROM complaints GROUP BY 1)
SELECT h.*, b.credit_score, fraud_complaints * 10 + open_complaints * 5 + complaints
       + CASE WHEN b.credit_score < 550 THEN 20 ELSE 0 END AS risk_points
FROM h LEFT JOIN billing b ON CAST(b.customer_id AS BIGINT) = h.customer_id""", views=("complaints", "billing"))
def j12_complaint_risk(spark, sf_dir):
    """Complaint history per customer joined to billing and scored."""
    t = Tables(spark, sf_dir)
    return jn.complaint_risk(fx.complaints(t), fx.billing(t))


@register("j13", """
SELECT CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM alerts
         WHERE timestamp >= (SELECT max(timestamp) FROM alerts) - INTERVAL 24 HOUR) * 100 AS success_rate
FROM alerts WHERE timestamp >= (SELECT max(timestamp) FROM alerts) - INTERVAL 1 HOUR""", views=("alerts",))
def j13_scalar_subquery(spark, sf_dir):
    """1 h alert count over the 24 h count (uncorrelated scalar subquery form)."""
    a = fx.alerts(Tables(spark, sf_dir))
    as_of = latest_ts(a)
    day_count = a.filter(since(as_of, "timestamp", "24 HOURS")).agg(F.count(F.lit(1))).scalar()
    return (a.filter(since(as_of, "timestamp", "1 HOUR"))
            .agg((F.count(F.lit(1)).cast("double") / day_count * 100).alias("success_rate")))


@register("j14", f"""
WITH j AS (SELECT c.customer_id, c.ts AS call_ts, c.call_seq, c.l_linenumber, c.dialed_number,
                  count(*) OVER (PARTITION BY c.call_seq, c.l_linenumber) AS roaming_records, s.event_ts AS service_ts, s.roaming_charges,
                  row_number() OVER (PARTITION BY c.call_seq, c.l_linenumber
                                     ORDER BY abs(epoch_us(c.ts) - epoch_us(s.event_ts)), s.event_ts, s.roaming_charges DESC) AS n
           FROM service s JOIN calls c ON CAST(s.customer_id AS BIGINT) = c.customer_id
                AND c.ts BETWEEN s.event_ts - INTERVAL 1 DAY AND s.event_ts + INTERVAL 1 DAY
           WHERE s.roaming_charges > 150 AND {PREMIUM_SQL.format(x='c.dialed_number')})
SELECT * EXCLUDE (n) FROM j WHERE n = 1""", views=("service", "calls"))
def j14_roaming_premium(spark, sf_dir):
    """Premium calls within a day of a roaming record of the customer, each with the nearest record."""
    t = Tables(spark, sf_dir)
    return jn.roaming_premium(fx.service(t), fx.calls(t))


@register("j03", """
WITH l AS (SELECT customer_id, count(DISTINCT cell_tower_id) AS unique_tower_count FROM home_location
           WHERE event_ts > (SELECT max(event_ts) FROM home_location) - INTERVAL 30 DAY GROUP BY 1)
SELECT c.customer_id, c.monthly_call_count, c.monthly_call_duration, l.unique_tower_count, d.device_model,
       p.plan_type AS customer_segment
FROM monthly_cdr c JOIN l ON c.customer_id = l.customer_id
JOIN devices d ON c.customer_id = CAST(d.customer_id AS VARCHAR)
JOIN profiles p ON c.customer_id = CAST(p.customer_id AS VARCHAR)
WHERE c.monthly_call_count > 500 AND c.monthly_call_duration > 1000 AND l.unique_tower_count < 3
  AND d.device_model LIKE '%Generic%'""", views=("monthly_cdr", "home_location", "devices", "profiles"))
def j03_simbox_join(spark, sf_dir):
    """SIM-box candidates: 4-way join with a distinct-tower subquery and LIKE filter."""
    t = Tables(spark, sf_dir)
    loc = fx.home_location(t)
    return jn.simbox_candidates(fx.monthly_cdr(t), loc, fx.devices(t), fx.profiles(t), latest_ts(loc, "event_ts"))
