"""Registered queries: window and sequence analytics (W01-W11, T07 batch)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import windows as wn
from ..sources import fixtures as fx
from ..sources.tables import Tables
from .catalog import register

c = F.col
HAV = ("2 * 6371 * asin(sqrt(least(1.0, pow(sin(radians(lat - plat) / 2), 2) "
       "+ cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lon - plon) / 2), 2))))")


@register("w01", f"""
WITH p AS (SELECT customer_id, event_id, lat, lon, ts,
                  lag(lat) OVER w AS plat, lag(lon) OVER w AS plon, lag(ts) OVER w AS pts,
                  lag(event_id) OVER w AS pid
           FROM fixes WINDOW w AS (PARTITION BY customer_id ORDER BY ts, event_id)),
q AS (SELECT *, {HAV} AS d, (epoch_us(ts) - epoch_us(pts)) / 3600e6 AS h FROM p WHERE pts IS NOT NULL)
SELECT customer_id, pid AS prev_event_id, event_id, pts AS prev_ts, ts, round(d, 3) AS distance_km,
       round(h, 4) AS hours, d > 900 * h AS impossible FROM q""", views=("fixes",))
def w01_impossible_travel(spark, sf_dir):
    """Successive location fixes per customer with implied speed above 900 km/h."""
    return wn.impossible_travel(fx.fixes(Tables(spark, sf_dir)))


@register("w02", """
WITH st AS (SELECT a.customer_id, a.day, avg(b.monthly_recharge_amount) AS m, stddev_samp(b.monthly_recharge_amount) AS sd
            FROM (SELECT DISTINCT customer_id, CAST(event_ts AS DATE) AS day FROM payments) a
            LEFT JOIN payments b ON a.customer_id = b.customer_id AND CAST(b.event_ts AS DATE) BETWEEN a.day - 30 AND a.day - 1
            GROUP BY 1, 2)
SELECT p.customer_id, p.event_ts, p.monthly_recharge_amount, round(m, 4) AS mean_30d, round(sd, 4) AS std_30d,
       round((p.monthly_recharge_amount - m) / NULLIF(sd, 0), 4) AS zscore,
       abs((p.monthly_recharge_amount - m) / NULLIF(sd, 0)) > 3 AS is_outlier
FROM payments p LEFT JOIN st ON p.customer_id = st.customer_id AND CAST(p.event_ts AS DATE) = st.day""",
          views=("payments",))
def w02_spending_zscore(spark, sf_dir):
    """Recharge z-score against the customer's previous 30 days."""
    return wn.spending_zscore(fx.payments(Tables(spark, sf_dir)))


@register("w03", """
WITH d AS (SELECT customer_id, CAST(ts AS DATE) AS day, sum(call_duration) AS t FROM calls GROUP BY 1, 2)
SELECT customer_id, day, round(t, 4) AS daily_total,
       round(sum(t) OVER (PARTITION BY customer_id ORDER BY day
                          RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) / 7.0, 4) AS avg_7d
FROM d""", views=("calls",))
def w03_rolling_7d(spark, sf_dir):
    """Rolling 7-day average of daily call minutes per customer."""
    return wn.rolling_daily_average(fx.calls(Tables(spark, sf_dir)), "customer_id", "ts", "call_duration")


@register("w04", """
WITH m AS (SELECT customer_id, CAST(date_trunc('month', ts) AS DATE) AS month, sum(call_duration) AS total
           FROM calls GROUP BY 1, 2)
SELECT a.customer_id, a.month, round(a.total, 4) AS total, round(b.total, 4) AS prev_total,
       round(a.total / NULLIF(b.total, 0), 4) AS ratio,
       CASE WHEN a.total / NULLIF(b.total, 0) > 4 THEN 'severe'
            WHEN a.total / NULLIF(b.total, 0) >= 3 THEN 'spike' END AS spike_level
FROM m a LEFT JOIN m b ON a.customer_id = b.customer_id
     AND b.month = CAST(a.month - INTERVAL 1 MONTH AS DATE)""", views=("calls",))
def w04_month_over_month(spark, sf_dir):
    """Monthly call minutes vs the previous calendar month (spike >= 300 %, severe > 400 %)."""
    return wn.month_over_month(fx.calls(Tables(spark, sf_dir)), "customer_id", "ts", "call_duration")


@register("w05", """
WITH g AS (SELECT customer_id, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY customer_id
                  ORDER BY ts, call_seq, l_linenumber))) / 1e6 AS gap FROM calls),
a AS (SELECT customer_id, count(*) AS n_calls, avg(gap) AS ag, stddev_samp(gap) AS sg FROM g GROUP BY 1)
SELECT customer_id, n_calls, round(ag, 4) AS avg_gap_sec, round(sg, 4) AS std_gap_sec,
       round(sg / NULLIF(ag, 0), 4) AS cv, n_calls >= 10 AND sg / NULLIF(ag, 0) < 0.1 AS timer_driven FROM a""",
          views=("calls",))
def w05_call_spacing(spark, sf_dir):
    """Regularity of inter-call gaps per customer (timer-driven dialing)."""
    return wn.call_spacing(fx.calls(Tables(spark, sf_dir)))


@register("w06", """
WITH l AS (SELECT customer_id, ts, call_seq, l_linenumber, dialed_number,
                  lag(dialed_number, 1) OVER w AS p1, lag(dialed_number, 2) OVER w AS p2
           FROM busy_calls WINDOW w AS (PARTITION BY customer_id ORDER BY ts, call_seq, l_linenumber, dialed_number))
SELECT customer_id, ts, call_seq, l_linenumber, dialed_number FROM l
WHERE p1 = dialed_number AND p2 = dialed_number
  AND (starts_with(dialed_number, '1-900') OR starts_with(dialed_number, '809')
       OR starts_with(dialed_number, '876'))""", views=("busy_calls",))
def w06_repeated_premium(spark, sf_dir):
    """Three consecutive calls of a customer to the same premium-rate number."""
    return wn.repeated_premium_calls(fx.busy_calls(Tables(spark, sf_dir)))


@register("w07", """
SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY customer_id ORDER BY ts
               RANGE BETWEEN INTERVAL 3600 SECOND PRECEDING AND CURRENT ROW) AS calls_last_hour FROM busy_calls)
WHERE calls_last_hour > 5""", views=("busy_calls",))
def w07_calls_last_hour(spark, sf_dir):
    """Calls with more than 5 calls by the same customer in the preceding hour."""
    return wn.calls_in_last_hour(fx.busy_calls(Tables(spark, sf_dir)))


@register("w08", """
WITH d AS (SELECT cell_tower_id, CAST(event_ts AS DATE) AS day, count(*) AS n FROM location GROUP BY 1, 2),
t AS (SELECT a.cell_tower_id, a.day, a.n, coalesce(sum(b.n), 0) / 7.0 AS tr FROM d a LEFT JOIN d b
      ON a.cell_tower_id = b.cell_tower_id AND b.day BETWEEN a.day - 7 AND a.day - 1 GROUP BY 1, 2, 3)
SELECT cell_tower_id, day, n, round(tr, 4) AS trailing_avg, round(tr, 4) > 0 AND n > 10 * round(tr, 4) AS spike
FROM t""", views=("location",))
def w08_tower_spikes(spark, sf_dir):
    """Daily tower volume against its trailing 7-day average (1000 % spike)."""
    return wn.tower_spikes(fx.location(Tables(spark, sf_dir)))


@register("w09", """
WITH l AS (SELECT customer_id, ts, imei, lag(imei) OVER (PARTITION BY customer_id ORDER BY ts, event_id) AS p
           FROM device_sightings),
g AS (SELECT customer_id, count(*) FILTER (WHERE p IS NOT NULL AND p <> imei) AS device_changes,
             min(ts) AS first_seen, max(ts) AS last_seen FROM l GROUP BY 1)
SELECT *, round(device_changes * 30.0 / NULLIF((epoch_us(last_seen) - epoch_us(first_seen)) / 86400e6, 0), 4)
       AS changes_per_30d FROM g""", views=("device_sightings",))
def w09_device_changes(spark, sf_dir):
    """IMEI changes per customer and changes per 30 days."""
    return wn.device_changes(fx.device_sightings(Tables(spark, sf_dir)))


@register("w10", """
SELECT customer_id, credit_limit, credit_score, updated_at, change_seq FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC, change_seq DESC) AS rn
  FROM profile_changes) WHERE rn = 1 AND __deleted <> 'true'""", views=("profile_changes",))
def w10_latest_change(spark, sf_dir):
    """Latest change row per customer; a delete as latest change removes the customer."""
    return wn.latest_per_key(fx.profile_changes(Tables(spark, sf_dir)))


@register("w11", """
WITH x AS (SELECT customer_id, ts, call_seq, l_linenumber,
                  max(CASE WHEN destination_country <> customer_id THEN ts END) OVER (
                      PARTITION BY customer_id ORDER BY ts, call_seq, l_linenumber
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS li,
                  avg(hour(ts)) OVER (PARTITION BY customer_id) AS ah FROM calls)
SELECT customer_id, ts, call_seq, l_linenumber, round((epoch_us(ts) - epoch_us(li)) / 86400e6, 4)
       AS days_since_last_intl, round(abs(hour(ts) - ah), 4) AS hour_deviation FROM x""", views=("calls",))
def w11_intl_recency(spark, sf_dir):
    """Days since the previous international call and deviation from the typical call hour."""
    return wn.intl_recency_and_hour(fx.calls(Tables(spark, sf_dir)))


@register("t07", """
SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY customer_id ORDER BY ts
               RANGE BETWEEN INTERVAL 600 SECOND PRECEDING AND CURRENT ROW) AS failures_10m
               FROM login_failures WHERE is_failure) WHERE failures_10m >= 5""", views=("login_failures",))
def t07_brute_force(spark, sf_dir):
    """Failed logins preceded by >= 5 failures of the customer within 10 minutes (batch form)."""
    return wn.brute_force(fx.login_failures(Tables(spark, sf_dir)))
