"""Additive risk scores and flag sets.

Every score is a sum of ``when(condition, points)`` terms plus a banding
``when`` chain — pure column expressions inside one projection.  Customer
baselines (typical hour, location, apps, data use) come from hash
aggregates over (customer, value) pairs, whose size per customer is bounded
by the value vocabulary, never by the customer's row count.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exprs import band, points, safe_div
from ..sources.lookups import HIGH_COST_COUNTRIES
from .aggregates import exact_quantiles
from .sequences import range_count

c = F.col


def _age_days(created: str, as_of: Column) -> Column:
    return F.datediff(F.to_date(as_of), F.to_date(c(created)))


def subscription_score(profiles: DataFrame, as_of: Column) -> DataFrame:
    """40 spending > 400, 30 score < 550, 20 delay > 5, 10 account < 30 days;
    >= 70 HIGH_RISK, >= 50 MEDIUM_RISK."""
    s = (points(c("monthly_spending") > 400, 40) + points(c("credit_score") < 550, 30)
         + points(c("avg_payment_delay") > 5, 20) + points(_age_days("account_creation_date", as_of) < 30, 10))
    return profiles.select("customer_id", s.alias("score"),
                           band(s, [(70, "HIGH_RISK"), (50, "MEDIUM_RISK")], "LOW_RISK").alias("risk_level"))


def signup_risk(profiles: DataFrame) -> DataFrame:
    """30 score < 600, 40 KYC not verified, 20 online, 10 unlimited plan; > 70 deposit."""
    s = (points(c("credit_score") < 600, 30) + points(~c("kyc_verified"), 40)
         + points(c("registration_channel") == "Online", 20) + points(c("requested_plan") == "Unlimited", 10))
    return profiles.select("customer_id", s.alias("score"), (s > 70).alias("require_deposit"))


def first_party_fraud(profiles: DataFrame) -> DataFrame:
    """35/25/15/20/15 points; >= 80 REJECT, >= 60 REQUIRE_DEPOSIT, >= 40 APPROVE_WITH_LIMIT."""
    s = (points(c("credit_score") < 600, 35)
         + points((c("requested_plan") == "Unlimited") & (c("credit_score") < 650), 25)
         + points(c("registration_channel") == "Online", 15) + points(~c("kyc_verified"), 20)
         + points(~c("address_verified"), 15))
    return profiles.select("customer_id", s.alias("score"), band(
        s, [(80, "REJECT"), (60, "REQUIRE_DEPOSIT"), (40, "APPROVE_WITH_LIMIT")], "APPROVE").alias("decision"))


def _high_cost(col: str) -> Column:
    return c(col).isin(*HIGH_COST_COUNTRIES)


def irsf_call_score(calls: DataFrame, key: str = "customer_id", ts: str = "ts") -> DataFrame:
    """50 high-cost destination, 30 call > 60 min, 10 night (h < 6 or h > 22),
    10 more than 5 calls in the last hour; >= 80 BLOCK, >= 60 ALERT."""
    withc = range_count(calls, [key], ts, 3600, "calls_last_hour", bucket_seconds=4 * 3600)
    h = F.hour(ts)
    s = (points(_high_cost("destination_iso"), 50) + points(c("call_duration") > 60, 30)
         + points((h < 6) | (h > 22), 10) + points(c("calls_last_hour") > 5, 10))
    return withc.select(key, ts, "call_seq", "l_linenumber", "destination_iso", s.alias("score"),
                        band(s, [(80, "BLOCK"), (60, "ALERT")], "ALLOW").alias("action"))


def irsf_night_rule(calls: DataFrame, minutes: float = 60.0) -> DataFrame:
    """Long call to a high-cost country between midnight and 6 am."""
    h = F.hour("ts")
    return calls.filter((c("call_duration") > minutes) & _high_cost("destination_iso") & (h >= 0) & (h <= 5)) \
        .select("customer_id", "ts", "call_seq", "l_linenumber", "destination_iso", "call_duration")


def _mode(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Most frequent value per key (ties -> smallest value); bounded per key."""
    cnt = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(key).orderBy(F.desc("_n"), c(value))
    return cnt.withColumn("_r", F.row_number().over(w)).filter(c("_r") == 1).select(key, c(value).alias(out))


def _same(key: str, left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on ``key`` where NULL equals NULL, keeping the left key."""
    other = right.withColumnRenamed(key, "_k")
    return left.join(other, left[key].eqNullSafe(other["_k"]), how).drop("_k")


def session_baselines(sessions: DataFrame, key: str = "customer_id", app_share: float = 0.05) -> DataFrame:
    """Per customer: peak hour, usual location, typical apps (those in at least
    ``app_share`` of the customer's sessions), mean data use.  Sessions without a
    customer share one baseline."""
    peak = _mode(sessions, key, "hour", "typical_peak_hour")
    loc = _mode(sessions, key, "location", "typical_location")
    app_n = (sessions.select(key, F.explode(F.array_distinct("apps")).alias("app")).groupBy(key, "app")
             .agg(F.count(F.lit(1)).alias("_n")))
    data = sessions.groupBy(key).agg(F.avg("data_usage").alias("typical_data_usage"), F.count(F.lit(1)).alias("_t"))
    # at most 1 / app_share apps a session's worth each: bounded per customer
    apps = (_same(key, app_n, data).filter(c("_n") >= app_share * c("_t"))
            .groupBy(key).agg(F.sort_array(F.collect_list("app")).alias("typical_apps")))
    out = _same(key, _same(key, data.drop("_t"), peak, "left"), loc, "left")
    return _same(key, out, apps, "left")


def takeover_score(sessions: DataFrame, key: str = "customer_id") -> DataFrame:
    """30 hour far from peak (> 6 h), 40 unusual location, 20 no familiar app,
    10 data > 3x usual; > 60 LIKELY_TAKEOVER, > 40 SUSPICIOUS.  Every session is scored."""
    j = _same(key, sessions, session_baselines(sessions, key), "left")
    familiar = F.size(F.array_intersect(F.coalesce("apps", F.array().cast("array<string>")),
                                        F.coalesce("typical_apps", F.array().cast("array<string>"))))
    s = (points(F.abs(c("hour") - c("typical_peak_hour")) > 6, 30)
         + points(c("location") != c("typical_location"), 40)
         + points(familiar < 1, 20)
         + points(safe_div("data_usage", "typical_data_usage") > 3, 10))
    verdict = F.when(s > 60, F.lit("LIKELY_TAKEOVER")).when(s > 40, F.lit("SUSPICIOUS")).otherwise(F.lit("NORMAL"))
    return j.select(key, "event_id", s.alias("score"), verdict.alias("verdict"))


def session_anomaly(sessions: DataFrame, key: str = "customer_id", hour_share: float = 0.05) -> DataFrame:
    """25 login hour outside the customer's usual hours, 35 unusual location,
    40 session starting with a SIM-swap request; > 70 TAKEOVER.  (The typing-speed
    term has no data source in any schema and is omitted.)  Every session is scored."""
    per_hour = sessions.groupBy(key, "hour").agg(F.count(F.lit(1)).alias("_n"))
    tot = sessions.groupBy(key).agg(F.count(F.lit(1)).alias("_t"))
    usual = (_same(key, per_hour, tot).filter(c("_n") >= hour_share * c("_t"))
             .select(c(key).alias("_uk"), c("hour").alias("_uh"), F.lit(True).alias("_usual")))
    loc = _mode(sessions, key, "location", "typical_location")
    j = sessions.join(usual, sessions[key].eqNullSafe(usual["_uk"]) & sessions["hour"].eqNullSafe(usual["_uh"]), "left")
    j = _same(key, j, loc, "left")
    s = (points(c("_usual").isNull(), 25) + points(c("location") != c("typical_location"), 35)
         + points(c("first_action") == "SIM_Swap_Request", 40))
    return j.select(key, "event_id", s.alias("score"),
                    F.when(s > 70, F.lit("TAKEOVER")).otherwise(F.lit("NORMAL")).alias("verdict"))


# Monthly spending limit per KYC level (level 3 unlimited).
KYC_LIMITS = {0: 20.0, 1: 100.0, 2: 500.0}


def kyc_limits(profiles: DataFrame) -> DataFrame:
    """KYC level -> allowed spending; violations above the limit."""
    lim = None
    for lvl, v in KYC_LIMITS.items():
        lim = F.when(c("kyc_level") == lvl, F.lit(v)) if lim is None else lim.when(c("kyc_level") == lvl, F.lit(v))
    lim = lim.otherwise(F.lit(None).cast("double"))
    return profiles.select("customer_id", "kyc_level", lim.alias("spending_limit"), "monthly_spending",
                           F.coalesce(c("monthly_spending") > lim, F.lit(False)).alias("violation"))


def new_account_flags(profiles: DataFrame, as_of: Column, days: int = 30, high_spend: float = 400.0
                      ) -> DataFrame:
    """New account (< 30 days) with high usage; unverified KYC with high spending."""
    age = _age_days("account_creation_date", as_of)
    return profiles.select("customer_id", age.alias("account_age_days"),
                           ((age < days) & (c("monthly_spending") > high_spend)).alias("new_high_usage"),
                           (~c("kyc_verified") & (c("monthly_spending") > high_spend)).alias("unverified_high_spend"))


def voip_bypass(usage: DataFrame, data_gb: float = 40.0) -> DataFrame:
    """Heavy data use with zero voice minutes."""
    return usage.filter((c("internet_usage_gb") > data_gb) & (c("voice_minutes") == 0)) \
        .select("customer_id", "internet_usage_gb", "voice_minutes")


def esim_takeover(sec_events: DataFrame) -> DataFrame:
    """X11: per customer and day — SIM-swap (eSIM) request, an IP first seen that day,
    and a device change."""
    day = F.to_date("ts")
    first_ip = sec_events.groupBy("customer_id", "ip_address").agg(F.to_date(F.min("ts")).alias("day"))
    new_ip = first_ip.groupBy("customer_id", "day").agg(F.count(F.lit(1)).alias("new_ips"))
    d = (sec_events.groupBy("customer_id", day.alias("day"))
         .agg(F.max((c("event_type") == "SIM_Swap_Request").cast("int")).alias("req"),
              F.max((c("event_type") == "Device_Change").cast("int")).alias("dev")))
    j = d.join(new_ip, ["customer_id", "day"], "left")
    return j.filter((c("req") == 1) & (c("dev") == 1) & (F.coalesce(c("new_ips"), F.lit(0)) > 0)) \
        .select("customer_id", "day", "new_ips")


def drop_flags(cdr: DataFrame) -> DataFrame:
    """Dropped-call count above 20 (elevated) / 30 (high)."""
    lvl = F.when(c("call_drop_count") > 30, F.lit("high")).when(c("call_drop_count") > 20, F.lit("elevated"))
    return cdr.select("customer_id", "event_ts", "call_drop_count", lvl.alias("drop_level")) \
        .filter(c("drop_level").isNotNull())


def premium_sms_monitor(service: DataFrame, watch: int = 20, alert: int = 40) -> DataFrame:
    """Premium-SMS volume monitor (watch / alert levels)."""
    lvl = F.when(c("premium_sms_count") > alert, F.lit("alert")).when(c("premium_sms_count") > watch, F.lit("watch"))
    return service.select("customer_id", "event_ts", "premium_sms_count", lvl.alias("level")) \
        .filter(c("level").isNotNull())


def decision_matrix(pattern_stats: DataFrame, high_cases: int = 10000, low_cases: int = 1000,
                    long_minutes: float = 10.0) -> DataFrame:
    """Cases x average duration -> action, over the per-type analytics (Q20)."""
    high = c("total_cases") > high_cases
    low = c("total_cases") < low_cases
    long_ = c("avg_duration") > long_minutes
    action = (F.when(high & long_, F.lit("CRITICAL - Immediate blocking"))
              .when(high, F.lit("Automate detection"))
              .when(low & long_, F.lit("Manual investigation"))
              .when(low, F.lit("Monitor only"))
              .otherwise(F.lit("Review")))
    return pattern_stats.select("alert_type", "total_cases", "avg_duration", action.alias("action"))


def payment_flags(billing: DataFrame) -> DataFrame:
    """Spending > 400, score < 550, cash, delay > 15, behaviour index < 3.0."""
    flags = {
        "high_spending": c("monthly_spending") > 400,
        "poor_credit": c("credit_score") < 550,
        "cash_payer": c("payment_method") == "Cash",
        "late_payer": c("avg_payment_delay") > 15,
        "unreliable_payer": c("payment_behavior_index") < 3.0,
    }
    total = sum((v.cast("int") for v in flags.values()), F.lit(0))
    return billing.select("customer_id", *[v.alias(k) for k, v in flags.items()], total.alias("flag_count"))


FEATURES = ["monthly_call_count", "monthly_call_duration", "international_call_duration",
            "call_drop_count", "sms_usage_per_month"]


#: Ranges that a feature's values are cut into; rows of a part of the fit's layout, and its fewest parts.
RANGES, FIT_PART_ROWS, FIT_PARTS = 32, 200_000, 16
#: Counts (one for each row and tree) that fitting keeps at once; the fewest trees that are grown at once.
FIT_COUNTS, FIT_TREES = 200_000_000, 10


def held_out(key: Column, fold: int = 5) -> Column:
    """Whether a row is kept out of fitting: a fifth of the keys by their hash."""
    return F.pmod(F.xxhash64(key), F.lit(fold)) == 0


def smallest_hashes(df: DataFrame, order: Column, key: str, n: int) -> DataFrame:
    """The ``n`` rows that come first by ``order`` (a hash) and ``key``: counts by ranges of the hash say
    up to which range they lie, so only about ``n`` rows are sorted, not all."""
    part = F.shiftright(order, 48)
    sizes = df.groupBy(part.alias("part")).count().orderBy("part").collect()  # at most 65,536 ranges
    total, last = 0, None
    for row in sizes:
        total, last = total + row["count"], row["part"]
        if total >= n:
            break
    return (df.filter(part <= last) if total >= n else df).orderBy(order, key).limit(n)


def ranges(df: DataFrame, columns: list[str], n: int = RANGES) -> list[list[float]]:
    """For each column the borders of at most ``n`` ranges with about as many rows each: exact quantiles of all rows, null and NaN left out."""
    out = []
    for x in columns:
        known = df.select(c(x).cast("double").alias("v")).filter(c("v").isNotNull() & ~F.isnan("v"))
        found = exact_quantiles(known, "v", tuple(i / n for i in range(1, n))).collect()
        borders = sorted({r["quantile"] for r in found if math.isfinite(r["quantile"])})
        out.append([-math.inf, *(borders or [0.0]), math.inf])
    return out


def random_forest_scores(cdr: DataFrame, labelled: DataFrame, threshold: float = 0.85, trees: int = 100,
                         seed: int = 42, key: str = "call_id") -> DataFrame:
    """Random-forest fraud probability (VectorAssembler + RandomForestClassifier
    in one Pipeline); flag above ``threshold``.

    Fitted on all rows of ``labelled`` (features + label).  Their layout follows from their
    number (hash of ``key`` over parts of about ``FIT_PART_ROWS`` rows, sorted inside), since
    bagging follows the partitions: the model doesn't depend on the cluster or on how the
    input was split.  Thresholds lie between the ranges of each feature (``ranges``, from all
    rows; null and NaN are a range above the others).  Fitting keeps a count for each row and
    tree, up to ``FIT_COUNTS`` at once: the trees of many rows are grown as several forests,
    whose mean is the forest of all.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import Bucketizer, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    binned = [f"__range_{x}" for x in FEATURES]
    known = lambda df: df.withColumns({f"__{x}": F.coalesce(c(x).cast("double"), F.lit(math.nan)) for x in FEATURES})
    rows = labelled.select(F.xxhash64(key).alias("__hash"), *FEATURES, "label").persist()  # read for each feature's ranges
    try:
        n = rows.count()
        cut = Bucketizer(inputCols=[f"__{x}" for x in FEATURES], outputCols=binned, splitsArray=ranges(rows, FEATURES), handleInvalid="keep")
        small = cut.transform(known(rows)).select("__hash", *[c(x).cast("byte").alias(x) for x in binned], "label")
        train = (small.repartition(max(FIT_PARTS, -(-n // FIT_PART_ROWS)), "__hash").sortWithinPartitions("__hash", *binned, "label")
                 .select(*binned, "label").persist())  # fitting passes over these rows several times
        try:
            train.count()
            rows.unpersist()
            asm = VectorAssembler(inputCols=binned, outputCol="features", handleInvalid="keep")
            most = max(FIT_TREES, FIT_COUNTS // max(n, 1))
            groups = [min(most, trees - i) for i in range(0, trees, most)]
            # maxBins: where its square reaches the number of rows, MLlib looks for thresholds in all rows, not in some;
            # there are no more than the ranges.  maxMemoryInMB: more tree nodes are split per pass over the data, so
            # training makes fewer passes (same model, fewer scans).
            forests = [RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=g, maxDepth=6, seed=seed + 1_000_003 * i,
                                              maxMemoryInMB=1024, maxBins=min(46_340, max(RANGES + 1, math.isqrt(n) + 1)),
                                              rawPredictionCol=f"__raw_{i}", probabilityCol=f"__probability_{i}", predictionCol=f"__prediction_{i}")
                       for i, g in enumerate(groups)]
            model = Pipeline(stages=[asm, *forests]).fit(train)
        finally:
            train.unpersist()
    finally:
        rows.unpersist()
    # a forest's probability is the mean of its trees'
    p = sum((vector_to_array(f"__probability_{i}").getItem(1) * (g / trees) for i, g in enumerate(groups)), F.lit(0.0))
    scored = model.transform(cut.transform(known(cdr))).withColumn("__p", p)
    return scored.select(*cdr.columns, c("__p").alias("fraud_probability"), (c("__p") > threshold).alias("flagged"))
