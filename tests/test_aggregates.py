"""Exact quantiles by rank selection, merged moments, alert gaps: against brute force on small data."""

import datetime as dt
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ringfence.operators.aggregates import exact_quantiles, population_outliers
from ringfence.operators.conditions import silence_gaps
from ringfence.operators.windows import repeated_premium_calls, spending_zscore


def test_exact_quantiles(spark):
    rnd = random.Random(1)
    shares = (0.0, 0.1, 0.25, 0.5, 0.95, 1.0)
    for values in ([rnd.gauss(0, 9) for _ in range(997)], [5.0] * 400 + [1.0, 7.0, None], [3.25], [rnd.randrange(4) / 1 for _ in range(500)]):
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
        got = {r.share: r.quantile for r in exact_quantiles(df, "x", shares).collect()}
        want = np.quantile([v for v in values if v is not None], shares)
        assert np.allclose([got[s] for s in shares], want, rtol=1e-12)
    assert exact_quantiles(df.limit(0), "x", shares).count() == 0


def test_quartiles_need_no_single_task(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).cast("double").alias("x"))
    out = population_outliers(df, "x")
    assert "percentile(" not in out._jdf.queryExecution().executedPlan().toString()
    sizes = exact_quantiles(df, "x", (0.5,), partitions=8)
    assert sizes.first().quantile == np.median([i * 7919 % 5003 for i in range(5000)])


def test_zscore_of_large_amounts(spark):
    rnd = random.Random(2)
    base = dt.datetime(2024, 1, 1)
    rows = [("a", base + dt.timedelta(hours=7 * i), 1e9 + rnd.random()) for i in range(120)]
    got = {r.event_ts: r for r in spending_zscore(spark.createDataFrame(rows, "customer_id string, event_ts timestamp_ntz, amount double"), amount="amount").collect()}
    for _, ts, x in rows:
        before = [y for _, t, y in rows if ts.date() - dt.timedelta(days=30) <= t.date() < ts.date()]
        if len(before) > 1:
            assert abs(got[ts].std_30d - pd.Series(before).std()) < 1e-4


def test_silence_gaps(spark):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    at = sorted(base + dt.timedelta(seconds=rnd.choice([30, 100, 119, 121, 5000, 40000, 9000000]) * i + rnd.random()) for i in range(60))
    df = spark.createDataFrame([(t, str(i)) for i, t in enumerate(at + [None, at[3]])], "timestamp timestamp_ntz, call_id string").repartition(3)
    cut = [t.replace(microsecond=0) for t in at]
    want = sorted((a, b, int((y - x).total_seconds())) for a, b, x, y in zip(at, at[1:], cut, cut[1:]) if (y - x).total_seconds() > 120)
    for bucket in (3600, 60):
        assert sorted(tuple(r) for r in silence_gaps(df, 120, bucket).collect()) == want
    plan = silence_gaps(df, 120)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "partitioning(0" not in plan


def test_runs_of_calls_that_cross_midnight(spark):
    base = dt.datetime(2024, 1, 1, 23, 58)
    number = "1-900-0001"
    rows = [(1, base + dt.timedelta(minutes=i), i, 1, n) for i, n in enumerate(["44-1", number, number, number, number, "44-1", number])]
    rows += [(None, base + dt.timedelta(minutes=i), 100 + i, 1, number) for i in range(3)]
    df = spark.createDataFrame(rows, "customer_id long, ts timestamp_ntz, call_seq long, l_linenumber int, dialed_number string")
    assert sorted(r.call_seq for r in repeated_premium_calls(df).collect()) == [3, 4, 102]
