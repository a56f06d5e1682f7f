"""Further analytical aggregates.

All are hash aggregates (partial + final), conditional counts, or joins of
small aggregates; global statistics are scalar subqueries
(``DataFrame.scalar()``), never a cross join or a driver round trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exprs import hour_of, is_weekend, r, safe_div, since
from ..session import ensure_checkpoint_dir
from ..sources.lookups import is_premium

c = F.col


def hourly_usage(calls: DataFrame) -> DataFrame:
    """Per customer and hour — calls, minutes, distinct destinations."""
    return (calls.groupBy("customer_id", hour_of("ts").alias("hour"))
            .agg(F.count(F.lit(1)).alias("calls"), r(F.sum("call_duration")).alias("minutes"),
                 F.count_distinct("destination_country").alias("unique_destinations")))


def monthly_value(calls: DataFrame, rate: float = 0.05) -> DataFrame:
    """Monthly customer value (minutes x rate)."""
    return (calls.groupBy("customer_id", F.trunc(F.to_date("ts"), "month").alias("month"))
            .agg(r(F.sum(c("call_duration") * rate)).alias("value")))


def pbx_hacking(calls: DataFrame, min_calls: int = 100, min_countries: int = 10) -> DataFrame:
    """A10: business lines calling at night on weekends to many countries.

    Night is 22:00-06:59 (wrap-around), weekend is Saturday/Sunday.
    """
    h = F.hour("ts")
    night = (h >= 22) | (h <= 6)
    f = calls.filter((c("customer_segment") == "Business") & is_weekend("ts") & night)
    return (f.groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("weekend_calls"), r(F.sum("call_duration")).alias("total_duration"),
                 F.count_distinct("destination_country").alias("country_count"))
            .filter((c("weekend_calls") > min_calls) & (c("country_count") > min_countries)))


def tower_diversity(location: DataFrame, stationary_below: int = 3) -> DataFrame:
    """Distinct towers per customer; fewer than 3 = stationary."""
    return (location.groupBy("customer_id").agg(F.count_distinct("cell_tower_id").alias("unique_towers"))
            .withColumn("stationary", c("unique_towers") < stationary_below))


def mass_dialers(calls: DataFrame, as_of: Column, victims: int = 1000) -> DataFrame:
    """Per calling customer in the last 24 h — distinct numbers reached and whether
    any was premium-rate; warning when > 1000 numbers (mass dialer) or premium-rate."""
    d = calls.filter(since(as_of, "ts", "24 HOURS"))
    g = d.groupBy("customer_id").agg(F.count_distinct("dialed_number").alias("unique_numbers"),
                                     F.coalesce(F.max(is_premium(c("dialed_number"))), F.lit(False)).alias("premium"))
    warn = (F.when(c("unique_numbers") > victims, F.lit("mass dialer"))
            .when(c("premium"), F.lit("premium-rate")))
    return g.select("customer_id", "unique_numbers", "premium", warn.alias("warning"))


# Benford first-digit probabilities (digits 1..9) and the
# chi-square critical value for p = 0.01 with 8 degrees of freedom.
BENFORD = [0.301, 0.176, 0.125, 0.097, 0.079, 0.067, 0.058, 0.051, 0.046]
CHI2_CRIT_8DF_P01 = 20.090


def benford(calls: DataFrame, value: str = "call_duration", min_count: int = 30) -> DataFrame:
    """Chi-square of each customer's first-digit distribution against Benford.

    One aggregate with nine conditional counts per customer (no per-customer
    lists); customers with fewer than ``min_count`` positive values are skipped.
    """
    pos = calls.filter(c(value) > 0)
    digit = F.substring(F.floor(c(value)).cast("long").cast("string"), 1, 1).cast("int")
    g = pos.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"),
                                       *[F.count_if(digit == d).alias(f"d{d}") for d in range(1, 10)])
    chi2 = None
    for d, p in enumerate(BENFORD, start=1):
        e = c("n") * p
        term = (c(f"d{d}") - e) * (c(f"d{d}") - e) / e
        chi2 = term if chi2 is None else chi2 + term
    return (g.filter(c("n") >= min_count)
            .select("customer_id", "n", r(chi2).alias("chi2"), (chi2 > CHI2_CRIT_8DF_P01).alias("violates_benford")))


def complaint_spikes(complaints: DataFrame, days: int = 7, factor: float = 2.0) -> DataFrame:
    """Daily complaints per category above ``factor`` x the trailing ``days``-day mean."""
    daily = complaints.groupBy("complaint_category", F.to_date("created_at").alias("day")) \
        .agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("complaint_category").orderBy(
        F.datediff("day", F.lit("1970-01-01").cast("date"))).rangeBetween(-days, -1)
    t = daily.select("complaint_category", "day", "n",
                     r(F.coalesce(F.sum("n").over(w), F.lit(0)) / float(days)).alias("trailing_mean"))
    return t.filter((c("trailing_mean") > 0) & (c("n") > factor * c("trailing_mean")))


def stale_fraud_complaints(complaints: DataFrame, hours: int = 48) -> DataFrame:
    """Open fraud complaints unresolved for more than 48 hours (churn risk)."""
    return complaints.filter((c("complaint_category") == "Fraud") & (c("complaint_status") == "open")
                             & (c("resolution_time_hours") > hours)) \
        .select("complaint_id", "customer_id", "resolution_time_hours", "created_at")


def exact_quantiles(df: DataFrame, value: str, shares: tuple[float, ...], partitions: int | None = None) -> DataFrame:
    """(share, quantile): exact interpolated quantiles (that of rank share * (n - 1)), by rank selection.

    Values are counted by a shuffle with partial sums, range-partitioned, and written
    to the checkpoint folder.  Prefix sums over the partitions' totals (one row a partition) tell
    which partitions hold the wanted ranks; only these are ordered, each by its own task.
    NULLs are left out; no rows give no rows; NaN is the largest value.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = df.select(c(value).cast("double").alias("v")).filter("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    dealt = counts.repartitionByRange(n, "v").withColumn("p", F.spark_partition_id()).checkpoint()
    totals = dealt.groupBy("p").agg(F.sum("n").alias("t"))
    # one row per partition
    offsets = totals.select("p", "t", (F.sum("t").over(Window.orderBy("p")) - c("t")).alias("o"), F.sum("t").over(Window.partitionBy()).alias("all"))
    rank = lambda q: F.lit(q) * (c("all") - 1)
    wanted = F.explode(F.array(*[F.struct(F.lit(q).alias("share"), F.lit(side).alias("side"), f(rank(q)).cast("long").alias("rank"), rank(q).alias("at"))
                                 for q in shares for side, f in ((0, F.floor), (1, F.ceil))]))
    hit = offsets.select("p", "t", "o", wanted.alias("w")).filter((c("w.rank") >= c("o")) & (c("w.rank") < c("o") + c("t")))
    upto = F.sum("n").over(Window.partitionBy("p", "w").orderBy("v")) + c("o")
    found = dealt.join(hit, "p").withColumn("c", upto).filter((c("w.rank") < c("c")) & (c("w.rank") >= c("c") - c("n")))
    side = lambda s: F.max(F.when(c("w.side") == s, c("v")))
    low, high, part = side(0), side(1), F.max(c("w.at") - F.floor(c("w.at")))
    return found.groupBy(c("w.share").alias("share")).agg(F.when(low == high, low).otherwise(low + part * (high - low)).alias("quantile"))


def population_outliers(df: DataFrame, value: str, z: float = 3.0) -> DataFrame:
    """Global mean / std / quartiles and the number of |z| > 3 outliers.

    The global statistics are scalar subqueries, so no cross join is planned; the
    quartiles come from rank selection (``exact_quantiles``), not from one final task.
    """
    stats = df.agg(F.struct(F.avg(value).alias("m"), F.stddev_samp(value).alias("s"))).scalar()
    m, s = stats.getField("m"), stats.getField("s")
    q = exact_quantiles(df, value, (0.25, 0.5, 0.75))
    at = q.agg(F.struct(*[F.max(F.when(c("share") == x, c("quantile"))).alias(n) for n, x in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))])).scalar()
    zval = F.abs(c(value) - m) / s
    return df.agg(F.count(F.lit(1)).alias("n"), r(F.avg(value)).alias("mean"), r(F.stddev_samp(value)).alias("std"),
                  F.count_if(zval > z).alias("outliers")).select(
        "n", "mean", "std", r(at.getField("p50")).alias("median"), r(at.getField("p25")).alias("p25"), r(at.getField("p75")).alias("p75"), "outliers")


def permanent_roamers(profiles: DataFrame, days: int = 90, spending: float = 200.0) -> DataFrame:
    """Roaming more than 90 days with spending above 200."""
    return profiles.filter((c("days_in_roaming") > days) & (c("monthly_spending") > spending)) \
        .select("customer_id", "days_in_roaming", "monthly_spending")


def daily_kpis(alerts_ext: DataFrame) -> DataFrame:
    """Per day — alerts, average value, reviewed false-positive rate, time to detect."""
    resp = F.timestamp_diff("SECOND", c("timestamp"), c("detection_timestamp")).cast("double")
    return (alerts_ext.groupBy(F.to_date("timestamp").alias("day"))
            .agg(F.count(F.lit(1)).alias("alerts"), r(F.avg("fraud_value_estimate")).alias("avg_value"),
                 r(F.avg(c("false_positive").cast("double"))).alias("false_positive_rate"),
                 r(F.avg(resp)).alias("avg_time_to_detect_sec")))


def daily_spend_flags(calls: DataFrame, cost_per_unit: float = 0.001, day_spend: float = 100.0,
                      call_cost: float = 10.0, days: int = 30, factor: float = 3.0) -> DataFrame:
    """Per customer and day — an international spike (minutes above ``factor`` x the mean of
    the ``days`` days before, missing days 0), spend > $100/day, any call > $10."""
    cost = c("call_cost_raw") * cost_per_unit
    intl = c("destination_country") != c("customer_id")
    g = (calls.groupBy("customer_id", F.to_date("ts").alias("day"))
         .agg(F.sum(F.when(intl, c("call_duration")).otherwise(0.0)).alias("_im"),
              r(F.sum(cost), 5).alias("spend"), r(F.max(cost), 5).alias("max_call_cost")))
    epoch_day = F.datediff("day", F.lit("1970-01-01").cast("date"))
    w = Window.partitionBy("customer_id").orderBy(epoch_day).rangeBetween(-days, -1)
    g = g.withColumn("_tr", F.coalesce(F.sum("_im").over(w), F.lit(0.0)) / float(days))
    out = g.select("customer_id", "day", r(c("_im")).alias("intl_minutes"), r(c("_tr")).alias("intl_trailing"), "spend", "max_call_cost",
                   (c("spend") > day_spend).alias("over_daily_spend"), (c("max_call_cost") > call_cost).alias("expensive_call"),
                   ((c("_tr") > 0) & (c("_im") > factor * c("_tr"))).alias("intl_spike"))
    return out.filter(c("over_daily_spend") | c("expensive_call") | c("intl_spike"))


def weekly_run_rate(alerts: DataFrame, rate: float = 0.05) -> DataFrame:
    """Weekly alert totals, the sum of the 30 days that end with the week, run rate
    (avg day x 365) and week-over-week change."""
    wk = F.date_trunc("week", c("timestamp")).cast("date")
    g = (alerts.groupBy(wk.alias("week"))
         .agg(F.count(F.lit(1)).alias("alerts"), F.sum(c("duration_min") * rate).alias("value"),
              F.count_distinct(F.to_date("timestamp")).alias("active_days")))
    prev = g.select(F.date_add("week", 7).alias("week"), c("value").alias("prev_value"))
    # a day counts in the (at most five) weeks whose 30 days hold it
    day = F.to_date("timestamp")
    daily = alerts.groupBy(day.alias("day")).agg(F.sum(c("duration_min") * rate).alias("value"))
    weeks = F.explode(F.sequence(F.date_trunc("week", c("day")).cast("date"), F.date_trunc("week", F.date_add("day", 23)).cast("date"), F.expr("INTERVAL 7 DAY")))
    month = daily.select(weeks.alias("week"), "value").groupBy("week").agg(F.sum("value").alias("value_30d"))
    j = g.join(month, "week").join(prev, "week", "left")
    return j.select("week", "alerts", r(c("value")).alias("value"), r(c("value_30d")).alias("value_30d"),
                    r(c("value") / c("active_days") * 365).alias("annual_run_rate"),
                    r(c("prev_value")).alias("prev_value"),
                    r(safe_div((c("value") - c("prev_value")) * 100.0, "prev_value")).alias("wow_change_pct"))


def alerts_by_region(enriched_alerts: DataFrame, rate: float = 0.05) -> DataFrame:
    """Alerts and average fraud value per region."""
    return (enriched_alerts.groupBy(F.coalesce(c("r_name"), F.lit("UNKNOWN")).alias("region"))
            .agg(F.count(F.lit(1)).alias("alerts"), r(F.avg(c("duration_min") * rate)).alias("avg_value")))
