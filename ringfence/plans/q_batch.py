"""Registered queries: batch sources (S01, S02, S04/S07, S08, S10, S11),
warehouse (M01-M11, J01, K05/K10) and data quality (A01-A04, D01-D06, P11, P12)."""

from __future__ import annotations

import datetime as dt
import hashlib
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators import quality as dq
from ..operators import warehouse as wh
from ..session import fresh_path, shared_path
from ..sources import fixtures as fx
from ..sources import files, lookups
from ..sources.schemas import CUSTOMER_PROFILES, WAREHOUSE
from ..sources.store import AlertStore, TieredStore
from ..sources.tables import Tables
from .catalog import register
from .q_core import rule_select_sql

c = F.col


def _stage(spark, sf_dir: str, name: str) -> str:
    """Staging folder under the shared checkpoint dir, stable per input folder."""
    tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:10]
    return shared_path(spark, "staging", tag, name)


def _fresh_stage(spark, sf_dir: str, name: str) -> str:
    """The same, without what the query's last run left: for stores that rows are appended to."""
    return fresh_path(spark, "staging", hashlib.sha1(sf_dir.encode()).hexdigest()[:10], name)


PROFILE_COLUMNS = ["customer_id", "customer_name", "age", "gender", "region", "plan_type", "income",
                   "monthly_spending", "credit_score", "credit_limit", "payment_method",
                   "avg_payment_delay", "payment_behavior_index", "account_creation_date"]


def _profiles_csv(spark, sf_dir):
    path = _stage(spark, sf_dir, "profiles_csv")
    files.write_csv(fx.profiles(Tables(spark, sf_dir)).select(*PROFILE_COLUMNS), path)
    return path


@register("s01", "SELECT " + ", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in PROFILE_COLUMNS)
          + " FROM profiles", views=("profiles",))
def s01_csv_strings(spark, sf_dir):
    """Headered CSV read with every column a string (profiles file)."""
    return files.read_csv_strings(spark, _profiles_csv(spark, sf_dir))


@register("s02", "SELECT " + ", ".join(PROFILE_COLUMNS) + " FROM profiles", views=("profiles",))
def s02_csv_inferred(spark, sf_dir):
    """Headered CSV read with sampled type inference (5 % sample)."""
    return files.read_csv_inferred(spark, _profiles_csv(spark, sf_dir), sampling_ratio=0.05)


@register("s07_s04", "SELECT * FROM cdr", views=("cdr",))
def s07_s04_json_roundtrip(spark, sf_dir):
    """CDR rows encoded as JSON event records, then decoded with the fixed stream schema."""
    raw = files.encode_events(fx.cdr(Tables(spark, sf_dir)))
    return files.decode_events(raw, "cdr").withColumn("event_ts", c("event_ts").cast("timestamp_ntz"))


@register("k07_s08", """
SELECT CAST(event_ts AS DATE) AS dt, count(*) AS events, CAST(sum(location_update_count) AS BIGINT) AS updates
FROM location WHERE CAST(event_ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY 1""",
          views=("location",))
def k07_s08_archive(spark, sf_dir):
    """Raw archive written partitioned by topic/dt, read back with a dt range (partition pruning)."""
    path = _stage(spark, sf_dir, "archive")
    files.write_archive(fx.location(Tables(spark, sf_dir)), path, "telecom-location")
    from ..sources.schemas import stream_schema
    df = files.read_archive(spark, path, stream_schema("location"), "2024-01-05", "2024-01-20")
    return df.groupBy("dt").agg(F.count(F.lit(1)).alias("events"),
                                F.sum("location_update_count").alias("updates"))


@register("s10", """SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE)
          AS date_id FROM orders""")
def s10_date_series(spark, sf_dir):
    """One row per day between the first and last order date."""
    o = Tables(spark, sf_dir).orders
    b = o.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    return b.select(wh.date_series(c("lo"), c("hi")).alias("date_id"))


@register("m04", """
WITH d AS (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE)
           AS date_id FROM orders)
SELECT date_id, CAST(year(date_id) AS INTEGER) AS year, CAST(month(date_id) AS INTEGER) AS month,
       CAST(day(date_id) AS INTEGER) AS day, CAST(quarter(date_id) AS INTEGER) AS quarter,
       dayname(date_id) AS day_name, dayofweek(date_id) IN (0, 6) AS is_weekend FROM d""")
def m04_dim_time(spark, sf_dir):
    """Dim_Time: calendar attributes over the order-date range."""
    return wh.dim_time_covering(Tables(spark, sf_dir).orders, "o_orderdate")


@register("s11", """
SELECT CAST(customer_id AS VARCHAR) AS customer_id, customer_name, age, gender, CAST(NULL AS VARCHAR) AS location,
       account_creation_date, plan_type, CAST(monthly_spending AS DECIMAL(10,2)) AS monthly_spending,
       credit_score, payment_method, avg_payment_delay,
       CAST(payment_behavior_index AS DECIMAL(5,2)) AS payment_behavior_index,
       CAST(credit_limit AS DECIMAL(10,2)) AS credit_limit,
       CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at
FROM profiles""", views=("profiles",))
def s11_conformed_load(spark, sf_dir):
    """Profiles loaded into the declared change-table schema; missing columns NULL."""
    return files.load_conformed(fx.profiles(Tables(spark, sf_dir)), CUSTOMER_PROFILES)


DIM_CUSTOMER_SQL = ("SELECT " + ", ".join(wh.DIM_CUSTOMER_COLUMNS)
                    + " FROM profiles LEFT JOIN behavior USING (customer_id)")


@register("m01", DIM_CUSTOMER_SQL, views=("profiles", "behavior"))
def m01_dim_customer(spark, sf_dir):
    """Dim_Customer: profiles LEFT JOIN behavior, 14 columns."""
    t = Tables(spark, sf_dir)
    return wh.dim_customer(fx.profiles(t), fx.behavior(t))


@register("j01", "SELECT * FROM profiles LEFT JOIN behavior USING (customer_id)",
          views=("profiles", "behavior"))
def j01_left_join(spark, sf_dir):
    """Left equi join profiles x behavior on customer_id (all columns)."""
    t = Tables(spark, sf_dir)
    return fx.profiles(t).join(fx.behavior(t), "customer_id", "left")


def _simple(qid, view, columns, builder, distinct=False, doc=""):
    sql = f"SELECT {'DISTINCT ' if distinct else ''}{', '.join(columns)} FROM {view}"

    def run(spark, sf_dir):
        return builder(Tables(spark, sf_dir))
    run.__doc__ = doc
    register(qid, sql, views=(view,))(run)


_simple("m02", "devices", wh.DIM_DEVICE_COLUMNS, lambda t: wh.dim_device(fx.devices(t)), doc="Dim_Device")
_simple("m03", "towers", wh.DIM_LOCATION_COLUMNS, lambda t: wh.dim_location(fx.towers(t)), True,
        doc="Dim_Location (distinct towers)")
_simple("m05", "cdr", wh.FACT_CDR_COLUMNS, lambda t: wh.fact(fx.cdr(t), wh.FACT_CDR_COLUMNS), doc="Fact_CDR")
_simple("m06", "billing", wh.FACT_PAYMENTS_COLUMNS, lambda t: wh.fact(fx.billing(t), wh.FACT_PAYMENTS_COLUMNS),
        doc="Fact_Payments")
_simple("m07", "complaint_scores", wh.FACT_COMPLAINTS_COLUMNS,
        lambda t: wh.fact(fx.complaint_scores(t), wh.FACT_COMPLAINTS_COLUMNS), doc="Fact_Complaints")
_simple("m08", "internet_usage", wh.FACT_INTERNET_COLUMNS,
        lambda t: wh.fact(fx.internet_usage(t), wh.FACT_INTERNET_COLUMNS), doc="Fact_Internet_Usage")
_simple("m09", "network_metrics", wh.FACT_NETWORK_COLUMNS,
        lambda t: wh.fact(fx.network_metrics(t), wh.FACT_NETWORK_COLUMNS), doc="Fact_Network_Metrics")
_simple("m10", "security_profile", wh.FACT_SECURITY_COLUMNS,
        lambda t: wh.fact(fx.security_profile(t), wh.FACT_SECURITY_COLUMNS), doc="Fact_Security")


@register("m11", """
SELECT CAST(customer_id AS BIGINT) AS customer_id, age, gender, region, income FROM profiles""",
          views=("profiles",))
def m11_conformed_dim_customer(spark, sf_dir):
    """Declared (narrow) Dim_Customer view: names, types and order of the target table."""
    t = Tables(spark, sf_dir)
    return wh.conform(wh.dim_customer(fx.profiles(t), fx.behavior(t)), WAREHOUSE["dim_customer"])


WAREHOUSE_COUNTS_SQL = """
SELECT 'dim_customer' AS table_name, count(*) AS row_count FROM profiles
UNION ALL SELECT 'dim_device', count(*) FROM devices
UNION ALL SELECT 'dim_location', count(*) FROM (SELECT DISTINCT tower_id, city, state, zip_code, latitude,
                                                longitude, urbanization_level FROM towers)
UNION ALL SELECT 'dim_time', CAST(max(CAST(o_orderdate AS DATE)) - min(CAST(o_orderdate AS DATE)) + 1 AS BIGINT)
          FROM orders
UNION ALL SELECT 'fact_cdr', count(*) FROM cdr
UNION ALL SELECT 'fact_payments', count(*) FROM billing
UNION ALL SELECT 'fact_complaints', count(*) FROM complaint_scores
UNION ALL SELECT 'fact_internet_usage', count(*) FROM internet_usage
UNION ALL SELECT 'fact_network_metrics', count(*) FROM network_metrics
UNION ALL SELECT 'fact_security', count(*) FROM security_profile"""


@register("k05_k10", WAREHOUSE_COUNTS_SQL,
          views=("profiles", "devices", "towers", "cdr", "billing", "complaint_scores", "internet_usage",
                 "network_metrics", "security_profile"))
def k05_k10_load_and_verify(spark, sf_dir):
    """Warehouse load of all 10 conformed tables (overwrite), then row counts read back."""
    t = Tables(spark, sf_dir)
    paths = wh.load(wh.build_conformed(t), _stage(spark, sf_dir, "warehouse"))
    return wh.verify_counts(spark, paths)


#: The eleven profiled tables and their keys (call records have none).
PROFILED = {"profiles": "customer_id", "behavior": "customer_id", "devices": "customer_id", "towers": "tower_id", "cdr": None,
            "billing": "customer_id", "complaints": "customer_id", "complaint_scores": "customer_id", "internet_usage": "customer_id",
            "network_metrics": "tower_id", "security_profile": "customer_id"}


def _profiled(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return {n: (getattr(fx, n)(t), key) for n, key in PROFILED.items()}


def _nulls_sql(name):
    return (f"SELECT '{name}' AS table_name, column_name, null_count FROM (UNPIVOT (SELECT count_if(COLUMNS('(.*)') IS NULL) AS '\\1' FROM {name}) "
            "ON COLUMNS(*) INTO NAME column_name VALUE null_count)")


A01_SQL = " UNION ALL ".join(_nulls_sql(n) for n in PROFILED)
A02_SQL = " UNION ALL ".join(f"SELECT '{n}' AS table_name, CAST({key} AS VARCHAR) AS key, count(*) AS count FROM {n} GROUP BY 2 HAVING count(*) > 1"
                             for n, key in PROFILED.items() if key)


@register("a01", A01_SQL, views=tuple(PROFILED))
def a01_null_counts(spark, sf_dir):
    """NULL count of every column of the eleven tables, one pass each."""
    parts = [dq.null_counts(df, n) for n, (df, _) in _profiled(spark, sf_dir).items()]
    return reduce(DataFrame.unionByName, parts)


@register("a02", A02_SQL, views=tuple(PROFILED))
def a02_duplicate_keys(spark, sf_dir):
    """Keys that occur more than once in the ten keyed tables (GROUP BY ... HAVING count > 1)."""
    return dq.duplicate_key_report({n: x for n, x in _profiled(spark, sf_dir).items() if x[1]})


@register("a03", """
SELECT md5(concat_ws('||', CAST(tower_id AS VARCHAR), CAST(signal_strength_avg AS VARCHAR),
                     CAST(network_downtime_minutes AS VARCHAR), network_congestion_level,
                     CAST(avg_signal_strength AS VARCHAR))) AS row_hash, count(*) AS count
FROM network_metrics GROUP BY 1 HAVING count(*) > 1""", views=("network_metrics",))
def a03_duplicate_rows(spark, sf_dir):
    """Whole-row duplicates of the tower metrics file by md5 row hash."""
    return dq.duplicate_rows(fx.network_metrics(Tables(spark, sf_dir)))


@register("a04", "SELECT DISTINCT customer_id, cell_tower_id FROM location", views=("location",))
def a04_distinct(spark, sf_dir):
    """DISTINCT (customer, tower) pairs seen in the location stream."""
    return fx.location(Tables(spark, sf_dir)).select("customer_id", "cell_tower_id").distinct()


@register("d01", """
SELECT customer_id, event_ts,
       concat_ws('; ',
         CASE WHEN monthly_call_count > 0 AND monthly_call_duration = 0
              THEN 'Impossible: calls exist but duration is 0' END,
         CASE WHEN monthly_call_duration < 0 OR monthly_call_duration > 10000
              THEN 'Duration out of reasonable range' END,
         CASE WHEN monthly_call_duration / greatest(monthly_call_count, 1) > 480
              THEN 'Suspicious: average call duration too high' END) AS errors,
       NOT ((monthly_call_count > 0 AND monthly_call_duration = 0)
            OR monthly_call_duration < 0 OR monthly_call_duration > 10000
            OR monthly_call_duration / greatest(monthly_call_count, 1) > 480) AS is_valid
FROM cdr""", views=("cdr",))
def d01_validate_cdr(spark, sf_dir):
    """CDR validation: five checks -> is_valid and the list of errors."""
    v = dq.validate_cdr(fx.cdr(Tables(spark, sf_dir)))
    return v.select("customer_id", "event_ts", F.array_join("errors", "; ").alias("errors"), "is_valid")


@register("d02", """
SELECT customer_id,
       concat_ws(',', CASE WHEN credit_score < 300 OR credit_score > 850 THEN 'flag' END,
                      CASE WHEN monthly_spending > credit_limit * 1.2 THEN 'alert' END,
                      CASE WHEN avg_payment_delay > 90 THEN 'cap' END) AS actions,
       least(avg_payment_delay, 90) AS avg_payment_delay, false AS rejected
FROM billing""", views=("billing",))
def d02_validate_payments(spark, sf_dir):
    """Payment validation with reject/flag/alert/cap actions."""
    v = dq.validate_payments(fx.billing(Tables(spark, sf_dir)))
    return v.select("customer_id", F.array_join("actions", ",").alias("actions"), "avg_payment_delay", "rejected")


@register("d03", """
SELECT customer_id, event_ts, arg_min(ss7_requests, ss7_requests) AS ss7_requests
FROM (SELECT customer_id, event_ts, ss7_requests FROM sdr) GROUP BY 1, 2""", views=("sdr",))
def d03_dedupe(spark, sf_dir):
    """Deduplicate the signalling stream on (customer_id, timestamp), keeping the lowest ss7 count."""
    s = fx.sdr(Tables(spark, sf_dir)).select("customer_id", "event_ts", "ss7_requests")
    return dq.dedupe(s, ("customer_id", "event_ts"), order_by="ss7_requests")


LUHN_SQL = """(list_sum(list_transform(range(1, length(imei) + 1), lambda i:
   CASE WHEN i % 2 = 0 THEN
     (CASE WHEN CAST(substr(reverse(imei), i, 1) AS INTEGER) * 2 > 9
           THEN CAST(substr(reverse(imei), i, 1) AS INTEGER) * 2 - 9
           ELSE CAST(substr(reverse(imei), i, 1) AS INTEGER) * 2 END)
   ELSE CAST(substr(reverse(imei), i, 1) AS INTEGER) END)) % 10 = 0)"""


@register("d04", f"""
WITH dup AS (SELECT imei, count(*) AS n FROM devices GROUP BY 1),
reg AS (SELECT unnest(['35332510', '35391805', '35875604', '01326300', '35925406']) AS tac),
x AS (SELECT d.device_id, d.customer_id, d.imei, d.tac_code, length(d.imei) = 15 AS length_ok,
             {LUHN_SQL} AS luhn_ok, dup.n > 1 AS duplicate_imei,
             d.tac_code IN (SELECT tac FROM reg) AS tac_registered
      FROM devices d JOIN dup USING (imei))
SELECT *, CASE WHEN NOT length_ok THEN 'Invalid length'
               WHEN NOT luhn_ok THEN 'Failed Luhn check (counterfeit?)'
               WHEN NOT tac_registered THEN 'TAC not registered'
               WHEN duplicate_imei THEN 'Duplicate IMEI' ELSE 'Valid IMEI' END AS status FROM x""",
          views=("devices",))
def d04_imei_checks(spark, sf_dir):
    """Device-registry validation: length 15, Luhn, duplicate IMEI, TAC registered."""
    return dq.imei_checks(fx.devices(Tables(spark, sf_dir)), lookups.tac_registry(spark))


@register("d05", """
SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'malformed' ELSE 'good' END AS status, count(*) AS records
FROM orders GROUP BY 1""")
def d05_malformed_split(spark, sf_dir):
    """JSON decode with malformed-record split (every 13th signalling record truncated)."""
    from ..sources.schemas import stream_schema
    sdr = fx.sdr(Tables(spark, sf_dir), with_key=True)
    enc = files.encode_events(sdr)
    raw = enc.select(F.when(F.get_json_object("value", "$.o_orderkey").cast("long") % 13 == 0,
                            F.substring("value", 1, 12)).otherwise(c("value")).alias("value"))
    good, bad = dq.split_malformed(raw, stream_schema("sdr"))
    return (good.select(F.lit("good").alias("status"))
            .unionByName(bad.select(F.lit("malformed").alias("status")))
            .groupBy("status").agg(F.count(F.lit(1)).alias("records")))


D06_SQL = " UNION ALL ".join([
    *[f"SELECT table_name, 'nulls:' || column_name AS metric, null_count AS value FROM ({_nulls_sql(n)})" for n in PROFILED],
    *[f"SELECT '{n}', 'rows', count(*) FROM {n}" for n in PROFILED],
    *[f"SELECT '{n}', 'duplicate_rows', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM (SELECT t AS r FROM {n} t) GROUP BY r)" for n in PROFILED],
    *[f"SELECT '{n}', 'duplicate_keys', count(*) FROM (SELECT {key} FROM {n} GROUP BY 1 HAVING count(*) > 1)" for n, key in PROFILED.items() if key]])


@register("d06", D06_SQL, views=tuple(PROFILED))
def d06_profile_report(spark, sf_dir):
    """Profiling report (nulls, rows, duplicate rows and keys) over the eleven tables."""
    return dq.profile_report(_profiled(spark, sf_dir))


@register("p11", """
SELECT c.customer_id, c.event_ts, coalesce(b.credit_score, 680) AS credit_score,
       coalesce(b.payment_method, 'Unknown') AS payment_method
FROM cdr c LEFT JOIN billing b USING (customer_id)""", views=("cdr", "billing"))
def p11_impute(spark, sf_dir):
    """CDR rows enriched with billing; missing credit score -> 680, payment method -> 'Unknown'."""
    t = Tables(spark, sf_dir)
    j = fx.cdr(t).select("customer_id", "event_ts").join(
        fx.billing(t).select("customer_id", "credit_score", "payment_method"), "customer_id", "left")
    return dq.impute(j)


@register("p12", """
SELECT customer_id, least(avg_payment_delay, 90) AS avg_payment_delay, monthly_spending > 10000 AS spending_outlier
FROM billing""", views=("billing",))
def p12_cap_flag(spark, sf_dir):
    """Payment delay capped at 90 days; spending above 10,000 flagged."""
    return dq.cap_and_flag(fx.billing(Tables(spark, sf_dir))).select(
        "customer_id", "avg_payment_delay", "spending_outlier")


@register("k08", """
SELECT CAST(month(event_ts) AS INTEGER) AS month, count(*) AS rows FROM cdr WHERE year(event_ts) = 1998 GROUP BY 1""",
          views=("cdr",))
def k08_date_layout(spark, sf_dir):
    """CDR written as snappy Parquet under year/month/day, read back with a year filter (pruned)."""
    path = _stage(spark, sf_dir, "cdr_by_date")
    files.write_date_layout(fx.cdr(Tables(spark, sf_dir)), path)
    df = spark.read.parquet(path).filter(c("year") == 1998)
    return df.groupBy("month").agg(F.count(F.lit(1)).alias("rows"))


@register("k09", """
WITH d AS (SELECT CAST(event_ts AS DATE) AS dt, count(*) AS n FROM cdr GROUP BY 1),
a AS (SELECT max(dt) AS as_of FROM d),
t AS (SELECT dt, n, CASE WHEN as_of - dt <= 7 THEN 'hot' WHEN as_of - dt <= 90 THEN 'warm'
                WHEN as_of - dt <= 2555 THEN 'cold' END AS tier FROM d, a)
SELECT dt, tier, n AS rows FROM t WHERE tier IS NOT NULL""", views=("cdr",))
def k09_retention(spark, sf_dir):
    """Retention tiers (hot 7 d / warm 90 d / cold 7 y) of raw CDR, loaded as of one date and applied on a later one; rows read back per tier and day."""
    cdr = fx.cdr(Tables(spark, sf_dir)).withColumn("dt", F.to_date("event_ts"))
    last = cdr.agg(F.max("dt")).first()[0]
    store = TieredStore(spark, _fresh_stage(spark, sf_dir, "retention"), "CDR (Raw)")
    store.load(cdr, last - dt.timedelta(days=30))
    store.apply(last)
    return store.read().groupBy("dt", "tier").agg(F.count(F.lit(1)).alias("rows"))


@register("k02_s09", "SELECT rule_id, CAST(timestamp AS DATE) AS dt, count(*) AS alerts FROM ("
          + "\nUNION ALL\n".join(rule_select_sql(f"r{i:02d}") for i in range(1, 18))
          + ") GROUP BY 1, 2", views=fx.EVENT_STREAMS)
def k02_s09_alert_store(spark, sf_dir):
    """Rule alerts appended in batches (one of them twice), closed batches compacted by month, scanned back per rule and day."""
    from ..operators.detect import detect
    from ..streaming.sinks import write_alert_batch
    t = Tables(spark, sf_dir)
    store = AlertStore(spark, _fresh_stage(spark, sf_dir, "alert_store"))
    for s in fx.EVENT_STREAMS:
        events = fx.stream(t, s)
        half = F.pmod(F.xxhash64(*events.columns), F.lit(2))
        for batch_id in (0, 1, 1):
            write_alert_batch(detect(events.filter(half == batch_id), s, "relaxed"), batch_id, store.incoming, s)
    store.compact()
    return store.read().groupBy("rule_id", "dt").agg(F.count(F.lit(1)).alias("alerts"))
