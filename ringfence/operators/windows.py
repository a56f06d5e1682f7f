"""Window and sequence analytics (W01-W11, T07 batch form).

Per-key sequences go through ``sequences`` (bucketed numbering, halo range
counts, bucket-carried last values) so no key is ever processed by a single
task; per-key *calendar* aggregates (daily, monthly) are pre-aggregated first
and windowed afterwards, where a key has at most one row per day or month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exprs import haversine_km, r, safe_div
from ..sources.lookups import is_premium
from .sequences import epoch_seconds, last_before, previous_rows, range_count

c = F.col

MAX_SPEED_KMH = 900.0  # fixed value: fastest plausible travel (airliner)


def impossible_travel(fixes: DataFrame, key: str = "customer_id", ts: str = "ts",
                      tiebreak: str = "event_id", max_kmh: float = MAX_SPEED_KMH) -> DataFrame:
    """Successive location fixes further apart than ``max_kmh`` x elapsed time."""
    p = previous_rows(fixes, [key], [ts, tiebreak], ["lat", "lon", ts, tiebreak])
    p = p.filter(c(f"prev_{ts}").isNotNull())
    dist = haversine_km("prev_lat", "prev_lon", "lat", "lon")
    hours = (epoch_seconds(ts) - epoch_seconds(f"prev_{ts}")) / 3600.0
    return p.select(c(key), c(f"prev_{tiebreak}").alias(f"prev_{tiebreak}"), c(tiebreak),
                    c(f"prev_{ts}").alias("prev_ts"), c(ts).alias("ts"),
                    r(dist, 3).alias("distance_km"), r(hours, 4).alias("hours"),
                    (dist > max_kmh * hours).alias("impossible"))


def _epoch_day(d) -> Column:
    return F.datediff(F.to_date(d), F.lit("1970-01-01").cast("date"))


def spending_zscore(tx: DataFrame, key: str = "customer_id", ts: str = "event_ts",
                    amount: str = "monthly_recharge_amount", days: int = 30, z: float = 3.0) -> DataFrame:
    """Z-score of each amount against the customer's previous ``days`` days.

    Moments (count, mean, squared deviations) per customer and day merge into those of
    the days before: the window holds at most ``days`` of them, and no sum of squares
    loses the digits of large amounts.  Then joined back on (customer, day).
    """
    daily = (tx.groupBy(key, F.to_date(ts).alias("day"))
             .agg(F.count(amount).alias("n"), F.avg(amount).alias("m"), (F.var_pop(amount) * F.count(amount)).alias("d")))
    w = Window.partitionBy(key).orderBy(_epoch_day("day")).rangeBetween(-days, -1)
    held = F.filter(F.collect_list(F.struct("n", "m", "d")).over(w), lambda x: x["n"] > 0)
    add = lambda f: F.aggregate("_h", F.lit(0.0), lambda a, x: a + f(x))
    trail = (daily.select(key, "day", held.alias("_h")).withColumn("tn", add(lambda x: x["n"].cast("double")))
             .withColumn("tm", safe_div(add(lambda x: x["n"] * x["m"]), "tn"))
             .withColumn("td", add(lambda x: x["d"] + x["n"] * (x["m"] - c("tm")) * (x["m"] - c("tm")))))
    mean = c("tm")
    std = F.when(c("tn") > 1, F.sqrt(c("td") / (c("tn") - 1)))
    trail = trail.select(key, "day", mean.alias("mean_30d"), std.alias("std_30d"))
    j = tx.select(key, ts, amount, F.to_date(ts).alias("day")).join(trail, [key, "day"], "left")
    zs = safe_div(c(amount) - c("mean_30d"), "std_30d")
    return j.select(key, ts, amount, r(c("mean_30d")).alias("mean_30d"), r(c("std_30d")).alias("std_30d"),
                    r(zs).alias("zscore"), (F.abs(zs) > z).alias("is_outlier"))


def rolling_daily_average(df: DataFrame, key: str, ts: str, value: str, days: int = 7) -> DataFrame:
    """Per customer and day, total and trailing ``days``-day average (missing days = 0)."""
    daily = df.groupBy(key, F.to_date(ts).alias("day")).agg(F.sum(value).alias("daily_total"))
    w = Window.partitionBy(key).orderBy(_epoch_day("day")).rangeBetween(-(days - 1), 0)
    return daily.select(key, "day", r(c("daily_total")).alias("daily_total"),
                        r(F.sum("daily_total").over(w) / float(days)).alias(f"avg_{days}d"))


def month_over_month(df: DataFrame, key: str, ts: str, value: str, spike: float = 3.0,
                     severe: float = 4.0) -> DataFrame:
    """Monthly totals against the previous calendar month; >= 300 % spike, > 400 % severe."""
    m = df.groupBy(key, F.trunc(F.to_date(ts), "month").alias("month")).agg(F.sum(value).alias("total"))
    prev = m.select(c(key), F.add_months("month", 1).alias("month"), c("total").alias("prev_total"))
    j = m.join(prev, [key, "month"], "left")
    ratio = safe_div("total", "prev_total")
    level = F.when(ratio > severe, F.lit("severe")).when(ratio >= spike, F.lit("spike"))
    return j.select(key, "month", r(c("total")).alias("total"), r(c("prev_total")).alias("prev_total"),
                    r(ratio).alias("ratio"), level.alias("spike_level"))


def call_spacing(calls: DataFrame, key: str = "customer_id", ts: str = "ts",
                 tiebreak: tuple = ("call_seq", "l_linenumber"), min_calls: int = 10,
                 max_cv: float = 0.1) -> DataFrame:
    """Regularity of the gaps between successive calls (timer-driven dialing)."""
    p = previous_rows(calls.select(key, ts, *tiebreak), [key], [ts, *tiebreak], [ts])
    gap = epoch_seconds(ts) - epoch_seconds(f"prev_{ts}")
    g = (p.groupBy(key).agg(F.count(F.lit(1)).alias("n_calls"), F.avg(gap).alias("avg_gap"),
                            F.stddev_samp(gap).alias("std_gap")))
    cv = safe_div("std_gap", "avg_gap")
    return g.select(key, "n_calls", r(c("avg_gap")).alias("avg_gap_sec"), r(c("std_gap")).alias("std_gap_sec"),
                    r(cv).alias("cv"), ((c("n_calls") >= min_calls) & (cv < max_cv)).alias("timer_driven"))


def repeated_premium_calls(calls: DataFrame, key: str = "customer_id", ts: str = "ts",
                           tiebreak: tuple = ("call_seq", "l_linenumber"), number: str = "dialed_number",
                           run: int = 3) -> DataFrame:
    """``run`` consecutive calls of a customer to the same premium number."""
    k = run - 1
    p = previous_rows(calls.select(key, ts, *tiebreak, number), [key], [ts, *tiebreak, number], [number], k=k)
    same = None
    for i in range(1, k + 1):
        eq = c(f"prev{i}_{number}") == c(number) if k > 1 else c(f"prev_{number}") == c(number)
        same = eq if same is None else (same & eq)
    return p.filter(same & is_premium(c(number))).select(key, ts, *tiebreak, number)


def calls_in_last_hour(calls: DataFrame, key: str = "customer_id", ts: str = "ts",
                       threshold: int = 5, seconds: int = 3600) -> DataFrame:
    """Calls of the same customer in the preceding hour (inclusive) above ``threshold``."""
    cnt = range_count(calls, [key], ts, seconds, "calls_last_hour", bucket_seconds=4 * seconds)
    return cnt.filter(c("calls_last_hour") > threshold)


def tower_spikes(events: DataFrame, tower: str = "cell_tower_id", ts: str = "event_ts", days: int = 7,
                 factor: float = 10.0) -> DataFrame:
    """Daily tower volume above ``factor`` x its trailing ``days``-day average (1000 %)."""
    daily = events.groupBy(tower, F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(tower).orderBy(_epoch_day("day")).rangeBetween(-days, -1)
    trailing = F.coalesce(F.sum("n").over(w), F.lit(0)) / float(days)
    out = daily.select(tower, "day", "n", r(trailing).alias("trailing_avg"))
    return out.withColumn("spike", (c("trailing_avg") > 0) & (c("n") > factor * c("trailing_avg")))


def device_changes(sightings: DataFrame, key: str = "customer_id", ts: str = "ts",
                   tiebreak: str = "event_id", device: str = "imei") -> DataFrame:
    """IMEI changes per customer and their frequency (per 30 days observed)."""
    p = previous_rows(sightings.select(key, ts, tiebreak, device), [key], [ts, tiebreak], [device])
    changed = c(f"prev_{device}").isNotNull() & (c(f"prev_{device}") != c(device))
    g = p.groupBy(key).agg(F.count_if(changed).alias("device_changes"), F.min(ts).alias("first_seen"),
                           F.max(ts).alias("last_seen"))
    span_days = (epoch_seconds("last_seen") - epoch_seconds("first_seen")) / 86400.0
    return g.select(key, "device_changes", "first_seen", "last_seen",
                    r(safe_div(c("device_changes") * 30.0, span_days)).alias("changes_per_30d"))


def latest_per_key(changes: DataFrame, key: str = "customer_id", order: tuple = ("updated_at", "change_seq"),
                   deleted: str = "__deleted") -> DataFrame:
    """Newest change row per key (max_by in a hash aggregate); a delete removes the key."""
    rest = [n for n in changes.columns if n != key]
    latest = (changes.groupBy(key)
              .agg(F.max_by(F.struct(*rest), F.struct(*[c(o) for o in order])).alias("_r"))
              .select(key, "_r.*"))
    return latest.filter(c(deleted) != "true").drop("__op", "__db", "__table", deleted)


def intl_recency_and_hour(calls: DataFrame, key: str = "customer_id", ts: str = "ts",
                          tiebreak: tuple = ("call_seq", "l_linenumber"),
                          is_intl: Column | None = None) -> DataFrame:
    """Days since the customer's previous international call and the
    deviation of the call hour from the customer's average hour."""
    intl = is_intl if is_intl is not None else (c("destination_country") != c(key))
    base = calls.select(key, ts, *tiebreak, intl.alias("_intl"))
    carried = last_before(base, [key], ts, F.when(c("_intl"), c(ts)), "_last_intl", tiebreak=list(tiebreak))
    typical = calls.groupBy(key).agg(F.avg(F.hour(ts)).alias("_avg_hour")).withColumnRenamed(key, "_k")
    j = carried.join(typical, c(key).eqNullSafe(c("_k")))
    days = (epoch_seconds(ts) - epoch_seconds("_last_intl")) / 86400.0
    return j.select(key, ts, *tiebreak, r(days).alias("days_since_last_intl"),
                    r(F.abs(F.hour(ts) - c("_avg_hour"))).alias("hour_deviation"))


def brute_force(logins: DataFrame, key: str = "customer_id", ts: str = "ts", failures: int = 5,
                minutes: int = 10) -> DataFrame:
    """T07 (batch form): failed logins with >= ``failures`` failures of the same
    customer in the preceding ``minutes`` (inclusive)."""
    f = logins.filter(c("is_failure"))
    cnt = range_count(f, [key], ts, minutes * 60, "failures_10m", bucket_seconds=3600)
    return cnt.filter(c("failures_10m") >= failures)
