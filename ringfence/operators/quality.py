"""Data-quality operators: profiling (A01-A04, D06), validation (D01, D02,
D04), deduplication (D03), malformed-record split (D05), imputation and
capping (P11, P12).

Everything is a single pass or a hash aggregate: null counts are one
``select`` of conditional counts; duplicate detection groups on a key or a
row hash (partial aggregation first, so a hot key costs one partial row per
task); validation builds an error array per row with ``when`` and drops the
NULLs, so no per-row Python runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

c = F.col


def null_counts(df: DataFrame, table: str, rows: str | None = None) -> DataFrame:
    """NULL count per column in one pass, one row per column; with ``rows`` also the number of rows under that name."""
    counts = [F.count_if(c(n).isNull()).alias(n) for n in df.columns]
    agg = df.agg(*counts, *([F.count(F.lit(1)).alias("_rows")] if rows else []))
    named = [(n, n) for n in df.columns] + ([(rows, "_rows")] if rows else [])
    stack = F.explode(F.array(*[F.struct(F.lit(label).alias("column_name"), c(n).alias("null_count")) for label, n in named]))
    return agg.select(stack.alias("s")).select(F.lit(table).alias("table_name"), "s.column_name", "s.null_count")


def duplicate_keys(df: DataFrame, key: str | list[str] = "customer_id") -> DataFrame:
    """Keys occurring more than once, with their counts (GROUP BY ... HAVING)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter(c("count") > 1)


def row_hash(df: DataFrame, null_safe: bool = True, sep: str = "||") -> Column:
    """md5 over all columns; the NULL-safe form marks NULLs so (a,NULL,b) != (a,b,NULL)."""
    cols = [c(n).cast("string") for n in df.columns]
    if null_safe:
        cols = [F.coalesce(x, F.lit("\u0000")) for x in cols]
    return F.md5(F.concat_ws(sep, *cols))


def duplicate_rows(df: DataFrame, null_safe: bool = True) -> DataFrame:
    """Whole-row duplicates by row hash, with their multiplicity."""
    return (df.select(row_hash(df, null_safe).alias("row_hash")).groupBy("row_hash")
            .agg(F.count(F.lit(1)).alias("count")).filter(c("count") > 1))


def duplicate_key_report(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Duplicate keys of several tables (table -> rows and key), one row per table and key."""
    return reduce(DataFrame.unionByName, [
        duplicate_keys(df, key).select(F.lit(name).alias("table_name"), c(key).cast("string").alias("key"), "count")
        for name, (df, key) in tables.items()])


def profile_report(tables: dict[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """Per table and column: nulls; per table: rows, duplicate rows, and keys that occur more than once.

    Three aggregates per table: one pass for nulls and rows, one by row hash, one by key.
    """
    parts = []
    for name, (df, key) in tables.items():
        one = lambda d, metric, value: d.agg(value.alias("value")).select(F.lit(name).alias("table_name"), F.lit(metric).alias("metric"), "value")
        first = null_counts(df, name, rows="rows")
        metric = F.when(c("column_name") == "rows", c("column_name")).otherwise(F.concat(F.lit("nulls:"), c("column_name")))
        parts.append(first.select("table_name", metric.alias("metric"), c("null_count").alias("value")))
        parts.append(one(duplicate_rows(df), "duplicate_rows", F.coalesce(F.sum(c("count") - 1), F.lit(0))))
        if key:
            parts.append(one(duplicate_keys(df, key), "duplicate_keys", F.count(F.lit(1))))
    return reduce(DataFrame.unionByName, parts)


def _errors(checks: list[tuple[Column, str]]) -> Column:
    arr = F.array(*[F.when(cond, F.lit(msg)) for cond, msg in checks])
    return F.array_compact(arr)


# CDR validation messages.
CDR_MESSAGES = {
    "missing_id": "Missing customer_id",
    "types": "Invalid data types",
    "zero_duration": "Impossible: calls exist but duration is 0",
    "range": "Duration out of reasonable range",
    "avg": "Suspicious: average call duration too high",
}


def validate_cdr(df: DataFrame) -> DataFrame:
    """Five checks per CDR record -> ``is_valid`` and the ``errors`` list."""
    calls = c("monthly_call_count").cast("double")
    dur = c("monthly_call_duration").cast("double")
    checks = [
        (c("customer_id").isNull() | (c("customer_id") == ""), CDR_MESSAGES["missing_id"]),
        (calls.isNull() | dur.isNull(), CDR_MESSAGES["types"]),
        ((calls > 0) & (dur == 0), CDR_MESSAGES["zero_duration"]),
        ((dur < 0) | (dur > 10000), CDR_MESSAGES["range"]),
        (dur / F.greatest(F.coalesce(calls, F.lit(0.0)), F.lit(1.0)) > 480, CDR_MESSAGES["avg"]),
    ]
    errs = _errors(checks)
    return df.withColumn("errors", errs).withColumn("is_valid", F.size("errors") == 0)


# Payment data-quality actions.
PAYMENT_ACTIONS = ["reject", "flag", "alert", "cap"]


def validate_payments(df: DataFrame, delay_cap: int = 90, soft_limit: float = 1.2) -> DataFrame:
    """schema/range/business/temporal checks with their actions.

    Reject (credit score not an integer), flag (score outside 300-850), alert
    (spending above 1.2 x limit), cap (payment delay above 90 days -> 90).
    """
    score = c("credit_score")
    score_num = score.cast("double")
    is_int = score_num.isNotNull() & (score_num == F.floor(score_num))
    actions = F.array_compact(F.array(
        F.when(~is_int | score.isNull(), F.lit("reject")),
        F.when(is_int & ((score_num < 300) | (score_num > 850)), F.lit("flag")),
        F.when(c("monthly_spending") > c("credit_limit") * soft_limit, F.lit("alert")),
        F.when(c("avg_payment_delay") > delay_cap, F.lit("cap"))))
    return (df.withColumn("actions", actions)
              .withColumn("avg_payment_delay", F.least(c("avg_payment_delay"), F.lit(delay_cap)))
              .withColumn("rejected", F.array_contains("actions", "reject")))


def impute(df: DataFrame, credit_score: int = 680, payment_method: str = "Unknown") -> DataFrame:
    """Documented NULL imputation."""
    return df.fillna({"credit_score": credit_score, "payment_method": payment_method})


def cap_and_flag(df: DataFrame, delay_cap: int = 90, spending_flag: float = 10000.0) -> DataFrame:
    """Cap payment delay, flag outlier spending."""
    return (df.withColumn("avg_payment_delay", F.least(c("avg_payment_delay"), F.lit(delay_cap)))
              .withColumn("spending_outlier", c("monthly_spending") > spending_flag))


def dedupe(df: DataFrame, keys=("customer_id", "event_ts"), order_by: str | None = None) -> DataFrame:
    """Keep one row per (customer_id, timestamp).

    With ``order_by`` the kept row is the one with the smallest value of that
    column (deterministic); it is chosen by ``min_by`` in a hash aggregate, so
    partial aggregation collapses a hot key map-side before the shuffle.
    Without it, ``dropDuplicates`` keeps an arbitrary row.
    """
    keys = list(keys)
    if order_by is None:
        return df.dropDuplicates(keys)
    rest = [n for n in df.columns if n not in keys]
    return (df.groupBy(*keys).agg(F.min_by(F.struct(*rest), c(order_by)).alias("_kept"))
              .select(*keys, "_kept.*"))


def imei_checks(devices: DataFrame, registry: DataFrame) -> DataFrame:
    """IMEI length, Luhn checksum, duplicate IMEI and TAC registration.

    The registry join is left to the planner: the fixed lookup registry is
    broadcast by construction (``lookups.tac_registry``), a full industry
    registry is joined by size.  Duplicate IMEIs come from a grouped count joined
    back on the IMEI (AQE splits a hot IMEI's partition).
    """
    dup = devices.groupBy("imei").agg(F.count(F.lit(1)).alias("imei_count"))
    reg = registry.select(c("tac_code").alias("_tac"), F.lit(True).alias("_registered"))
    out = (devices.join(dup, "imei", "left")
           .join(reg, c("tac_code") == c("_tac"), "left")
           .withColumn("length_ok", F.length("imei") == 15)
           .withColumn("luhn_ok", F.expr("luhn_check(imei)"))
           .withColumn("duplicate_imei", c("imei_count") > 1)
           .withColumn("tac_registered", F.coalesce(c("_registered"), F.lit(False))))
    reason = F.when(~c("length_ok"), F.lit("Invalid length")) \
        .when(~c("luhn_ok"), F.lit("Failed Luhn check (counterfeit?)")) \
        .when(~c("tac_registered"), F.lit("TAC not registered")) \
        .when(c("duplicate_imei"), F.lit("Duplicate IMEI")) \
        .otherwise(F.lit("Valid IMEI"))
    return out.select("device_id", "customer_id", "imei", "tac_code", "length_ok", "luhn_ok",
                      "duplicate_imei", "tac_registered", reason.alias("status"))


def split_malformed(raw: DataFrame, schema: T.StructType, value_col: str = "value"):
    """Decode JSON; return (good rows, malformed raw records).

    PERMISSIVE ``from_json`` never fails: a malformed document becomes a struct
    of NULLs.  A document is malformed when it is not a JSON object or it
    carries none of the schema's fields.
    """
    parsed = raw.select(c(value_col).cast("string").alias("_raw"),
                        F.from_json(c(value_col).cast("string"), schema,
                                    {"mode": "PERMISSIVE"}).alias("data"))
    any_field = reduce(lambda a, b: a | b, [c(f"data.{f.name}").isNotNull() for f in schema.fields])
    is_obj = F.trim(c("_raw")).startswith("{") & F.trim(c("_raw")).endswith("}")
    ok = c("data").isNotNull() & is_obj & any_field
    good = parsed.filter(ok).select("data.*")
    bad = parsed.filter(~ok | ok.isNull()).select(c("_raw").alias("_corrupt_record"))
    return good, bad
