"""Column helpers shared by operators (all built-in, JVM-side expressions)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

c = F.col

EARTH_RADIUS_KM = 6371.0


def col_(x: str | Column) -> Column:
    return c(x) if isinstance(x, str) else x


def safe_div(num: str | Column, den: str | Column) -> Column:
    """Division that yields NULL on a zero denominator (ANSI-safe)."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))


def since(as_of: Column, ts: str | Column, interval: str) -> Column:
    """``ts >= as_of - INTERVAL interval`` (rolling window filter, P09)."""
    return col_(ts) >= as_of - F.expr(f"INTERVAL {interval}")


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Whole-second boundaries crossed from ``start`` to ``end``."""
    return F.timestamp_diff("SECOND", F.date_trunc("second", col_(start)),
                            F.date_trunc("second", col_(end)))


def weekday_mon1(ts: str | Column) -> Column:
    """Day of week with Monday = 1 ... Sunday = 7."""
    return F.weekday(col_(ts)) + 1


def is_weekend(ts: str | Column) -> Column:
    return F.dayofweek(col_(ts)).isin(1, 7)


def minute_of(ts: str | Column) -> Column:
    return F.date_trunc("minute", col_(ts)).cast("timestamp_ntz")


def hour_of(ts: str | Column) -> Column:
    return F.date_trunc("hour", col_(ts)).cast("timestamp_ntz")


def day_of(ts: str | Column) -> Column:
    return F.to_date(col_(ts))


def pattern_prefix(alert_type: str | Column) -> Column:
    """Text before the first '/', trailing blank kept; whole when no '/'."""
    return F.substring_index(col_(alert_type), "/", 1)


def severity(alert_type: str | Column) -> Column:
    """Bracketed label at the end of an alert type, e.g. 'Critical - Lock Account'."""
    return F.nullif(F.regexp_extract(col_(alert_type), r"\[([^\]]*)\]\s*$", 1), F.lit(""))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    rad = math.pi / 180.0
    p1, p2 = col_(lat1) * rad, col_(lat2) * rad
    dphi = (col_(lat2) - col_(lat1)) * rad
    dlmb = (col_(lon2) - col_(lon1)) * rad
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def points(cond: Column, pts: float) -> Column:
    return F.when(cond, F.lit(pts)).otherwise(F.lit(0))


def band(score: Column, bands: list[tuple[float, str]], default: str) -> Column:
    """First label whose lower bound (inclusive) the score reaches."""
    out = None
    for lo, label in bands:
        out = F.when(score >= lo, F.lit(label)) if out is None else out.when(score >= lo, F.lit(label))
    return out.otherwise(F.lit(default))


def r(x: Column, digits: int = 4) -> Column:
    """Round a floating result for stable comparison."""
    return F.round(x, digits)


def latest_ts(df: DataFrame, ts: str = "timestamp") -> Column:
    """Scalar subquery ``(SELECT max(ts) FROM df)``: the test-time ``as_of``."""
    return df.agg(F.max(ts)).scalar()
