"""Skew-safe helpers against brute force on a fixture with one hot key."""

import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from ringfence.operators.joins import callbacks_after_ring
from ringfence.operators.sequences import interval_join, last_before, nearest, previous_rows, range_count


def _events(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        key = 0 if rnd.random() < 0.4 else rnd.randint(1, 20)        # key 0 holds ~40 % of rows
        ts = base + dt.timedelta(seconds=rnd.randint(0, 5 * 86400))
        rows.append((key, ts, i, rnd.randint(0, 9), rnd.random() < 0.2))
    return spark.createDataFrame(rows, "k long, ts timestamp_ntz, id long, v long, flag boolean"), rows


def test_previous_rows_matches_sorted_lag(spark):
    df, rows = _events(spark)
    got = previous_rows(df, ["k"], ["ts", "id"], ["v", "id"], k=2, bucket_seconds=3600)
    got = {r.id: (r.prev1_id, r.prev2_id) for r in got.collect()}
    pdf = pd.DataFrame(rows, columns=["k", "ts", "id", "v", "flag"]).sort_values(["k", "ts", "id"])
    pdf["p1"] = pdf.groupby("k")["id"].shift(1)
    pdf["p2"] = pdf.groupby("k")["id"].shift(2)
    for r in pdf.itertuples():
        exp = (None if pd.isna(r.p1) else int(r.p1), None if pd.isna(r.p2) else int(r.p2))
        assert got[r.id] == exp


def test_range_count_matches_brute_force(spark):
    df, rows = _events(spark, n=1500)
    got = {r.id: r.n for r in range_count(df, ["k"], "ts", 600, "n", bucket_seconds=900).collect()}
    for k, ts, i, v, f in rows:
        exp = sum(1 for k2, ts2, *_ in rows if k2 == k and ts - dt.timedelta(seconds=600) <= ts2 <= ts)
        assert got[i] == exp


def test_last_before_matches_brute_force(spark):
    df, rows = _events(spark, n=1500)
    out = last_before(df, ["k"], "ts", F.when(F.col("flag"), F.col("id")), "last_flag_id",
                      bucket_seconds=3600, tiebreak=["id"]).collect()
    got = {r.id: r.last_flag_id for r in out}
    for k, ts, i, v, f in rows:
        prior = [(ts2, i2) for k2, ts2, i2, v2, f2 in rows if k2 == k and f2 and (ts2, i2) < (ts, i)]
        assert got[i] == (max(prior)[1] if prior else None)


def test_nearest_matches_brute_force(spark):
    df, rows = _events(spark, n=900)
    events = df.filter("not flag").select("k", "ts", "id")
    marks = df.filter("flag").select("k", F.col("ts").alias("mts"), F.col("id").alias("mid"))
    extra = spark.createDataFrame([(None, rows[0][1], -1), (3, None, -2)], "k long, ts timestamp_ntz, id long")
    for before, after in ((7200, 3600), (1800, 0)):
        out = nearest(events.unionByName(extra), marks, ["k"], "ts", "mts", ["mid"], before, after).collect()
        got = {r.id: (r.marks, r.mark.mid) for r in out}
        assert len(got) == len(out)
        for k, ts, i, v, f in rows:
            if f:
                continue
            near = [(abs((t2 - ts).total_seconds()), t2, -j) for k2, t2, j, v2, f2 in rows if f2 and k2 == k
                    and ts - dt.timedelta(seconds=before) <= t2 <= ts + dt.timedelta(seconds=after)]
            assert got.pop(i, None) == ((len(near), -min(near)[2]) if near else None)
        assert not got
        plan = out and nearest(events, marks, ["k"], "ts", "mts", ["mid"], before, after)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_interval_join_makes_every_pair_once(spark):
    df, rows = _events(spark, n=900)
    rings = df.filter("flag").select("k", F.col("ts").alias("mts"), F.col("id").alias("mid"))
    backs = df.filter("not flag").select("k", "ts", "id").unionByName(
        spark.createDataFrame([(None, rows[0][1], -1), (3, None, -2)], "k long, ts timestamp_ntz, id long"))
    out = interval_join(rings, backs, ["k"], "mts", "ts", 1800)
    exp = sorted((j, i) for k, ts, i, _, f in rows for k2, t2, j, _, f2 in rows
                 if f2 and not f and k == k2 and t2 <= ts <= t2 + dt.timedelta(seconds=1800))
    assert exp and sorted((r.mid, r.id) for r in out.collect()) == exp
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_rows_without_key_or_time_stay(spark):
    base = dt.datetime(2024, 1, 1, 23, 0)
    rows = [(None, base, 1), (None, base + dt.timedelta(hours=3), 2), (1, None, 3), (1, None, 4), (1, base, 5), (1, base + dt.timedelta(days=40), 6)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, id long")
    got = {r.id: r.prev_id for r in previous_rows(df, ["k"], ["ts", "id"], ["id"]).collect()}
    assert got == {1: None, 2: 1, 3: None, 4: 3, 5: 4, 6: 5}
    got = {r.id: r.last for r in last_before(df, ["k"], "ts", F.when(F.col("id") != 5, F.col("id")), "last", tiebreak=["id"]).collect()}
    assert got == {1: None, 2: 1, 3: None, 4: 3, 5: 4, 6: 4}


def test_rows_are_shuffled_once(spark):
    df, _ = _events(spark, n=500)
    plan = previous_rows(df.withColumn("wide", F.repeat(F.lit("x"), 50)), ["k"], ["ts", "id"], ["v"])._jdf.queryExecution().executedPlan().toString()
    shuffled = [i for i, line in enumerate(plan.split("\n")) if "Exchange hashpartitioning" in line]
    # one of whole rows by (key, bucket); the others are of at most k rows per bucket and task, or of the bucket table
    assert len(shuffled) <= 4 and plan.count("WindowGroupLimit") >= 2 and "Generate explode" not in plan


def test_hot_key_is_split_across_partitions(spark):
    df, _ = _events(spark, n=3000)
    seq = previous_rows(df, ["k"], ["ts", "id"], ["v"], bucket_seconds=3600)
    plan = seq._jdf.queryExecution().executedPlan().toString()
    # The row-level window is partitioned by (key, bucket), never by the key alone.
    assert "_bkt" in plan and "Exchange SinglePartition" not in plan


def test_callbacks_keep_every_ring(spark):
    """A callback after two rings from the number gives two rows."""
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    calls = [(1, at(0), 1.0, 10, 1, "1-900-5"), (1, at(3), 2.0, 11, 1, "1-900-5"), (1, at(5), 9.0, 12, 1, "1-900-5"), (1, at(9), 9.0, 13, 1, "1-900-5")]
    df = spark.createDataFrame(calls, "customer_id long, ts timestamp_ntz, call_duration double, call_seq long, l_linenumber long, dialed_number string")
    assert sorted((r.ring_seq, r.call_seq) for r in callbacks_after_ring(df).collect()) == [(10, 12), (11, 12)]


def test_nearest_looks_at_each_row_once(spark):
    """Dense rows of one key: one shuffle, no window that looks at all rows in range for each row; counts and ties are right."""
    start = dt.datetime(2024, 1, 1)
    events = spark.range(400).select(F.lit(1).alias("k"), (F.lit(start) + F.make_dt_interval(secs=F.col("id"))).cast("timestamp_ntz").alias("ts"), "id")
    marks = spark.range(400).select(F.lit(1).alias("k"), (F.lit(start) + F.make_dt_interval(secs=F.floor(F.col("id") / 2) * 2)).cast("timestamp_ntz").alias("mts"), F.col("id").alias("mid"))
    out = nearest(events, marks, ["k"], "ts", "mts", ["mid"], 100, 50)
    got = {r.id: (r.marks, r.mark.mid) for r in out.collect()}
    at = [m // 2 * 2 for m in range(400)]
    for t in range(400):
        assert got[t] == (sum(t - 100 <= m <= t + 50 for m in at), t // 2 * 2 + 1)
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "RangeFrame" not in plan and plan.count("Exchange hashpartitioning") == 1
