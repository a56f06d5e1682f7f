"""Structured Streaming: stream = batch, restart without duplicates, replay
idempotence, watermark behaviour, silence-detector state."""

import datetime as dt
import gzip
import os
import random

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringfence.operators.detect import detect
from ringfence.plans import q_streaming
from ringfence.sources import files, fixtures as fx
from ringfence.sources.tables import Tables
from ringfence.operators.windows import latest_per_key
from ringfence.streaming import jobs, sinks, sources, stateful
from ringfence.streaming.upserts import CurrentTable

from paths import SF_SMALL


def _write_json_events(spark, stream, path, parts=3):
    df = fx.stream(Tables(spark, SF_SMALL), stream)
    files.encode_events(df).select("value").repartition(parts).write.mode("overwrite").text(path)
    return df


def test_stream_equals_batch_and_restart_is_idempotent(spark, scratch):
    src, store, act, ck = (os.path.join(scratch, x) for x in ("src", "store", "actions", "ck"))
    batch_df = _write_json_events(spark, "cdr", src)
    q = jobs.rule_stream(spark, "cdr", src, store, act, checkpoint=ck, available_now=True)
    q.awaitTermination()
    got = spark.read.parquet(store)
    exp = detect(batch_df, "cdr")
    cols = ["call_id", "receiver_number", "duration_min", "alert_type", "rule_id"]
    assert got.count() == exp.count()
    assert got.select(*cols).exceptAll(exp.select(*cols)).count() == 0
    # restart on the same checkpoint: nothing is re-read, nothing duplicated
    q2 = jobs.rule_stream(spark, "cdr", src, store, act, checkpoint=ck, available_now=True)
    q2.awaitTermination()
    assert spark.read.parquet(store).count() == exp.count()
    assert spark.read.json(act).count() == exp.count()


def test_replayed_batch_overwrites_its_own_output(spark, scratch):
    store, act = os.path.join(scratch, "store"), os.path.join(scratch, "act")
    alerts = detect(fx.stream(Tables(spark, SF_SMALL), "sdr"), "sdr")
    sink = sinks.dual_sink(store, act)
    sink(alerts, 5)
    sink(alerts, 5)          # replay after a failure
    sink(alerts.limit(10), 6)
    n = alerts.count()
    assert spark.read.parquet(store).count() == n + 10
    assert spark.read.json(act).count() == n + 10


def _data_files(path):
    return [f for _, _, names in os.walk(path) for f in names if f.startswith("part-")]


def test_sinks_and_replay_are_compressed(spark, scratch):
    """Messages and store take a fraction of the plain text's disk; a finished replay takes none."""
    store, act = os.path.join(scratch, "store"), os.path.join(scratch, "act")
    sinks.dual_sink(store, act)(detect(fx.stream(Tables(spark, SF_SMALL), "sdr"), "sdr"), 0)
    assert _data_files(act) and all(f.endswith(".json.gz") for f in _data_files(act))
    assert _data_files(store) and all(f.endswith(".zstd.parquet") for f in _data_files(store))
    q_streaming._alerts_of(Tables(spark, SF_SMALL), os.path.join(scratch, "run"))
    assert _data_files(os.path.join(scratch, "run", "actions")) and not os.path.exists(os.path.join(scratch, "run", "src"))


def test_tumbling_window_drops_late_rows(spark, scratch):
    src = os.path.join(scratch, "late")
    os.makedirs(src)
    t0 = dt.datetime(2024, 1, 1, 12, 0, 0)
    # Spark filters late rows with the watermark of the previous batch, so the
    # late row comes two batches after the one that moved the watermark.
    batches = [[("c1", t0, 1.0), ("c1", t0 + dt.timedelta(minutes=1), 2.0)],
               [("c1", t0 + dt.timedelta(minutes=30), 5.0)],          # moves the watermark to 12:20
               [("c1", t0 + dt.timedelta(minutes=31), 6.0)],          # 12:00 window closes and is emitted
               [("c1", t0 + dt.timedelta(minutes=2), 100.0)]]         # late: behind the watermark
    import time
    now = time.time()
    for i, b in enumerate(batches):
        fname = os.path.join(src, f"part{i}.txt")
        with open(fname, "w") as fh:
            fh.write("\n".join(f'{{"customer_id":"{c}","event_ts":"{ts.isoformat()}","monthly_call_count":1,'
                               f'"monthly_call_duration":{v}}}' for c, ts, v in b) + "\n")
        os.utime(fname, (now - 100 + 10 * i, now - 100 + 10 * i))   # the file source reads in mtime order
    ev = sources.event_stream(spark, "cdr", src, max_per_trigger=1)
    agg = jobs.tumbling_usage(ev, "monthly_call_duration", minutes=5, watermark="10 minutes")
    q = (agg.writeStream.outputMode("append").format("memory").queryName("t05_late")
         .option("checkpointLocation", os.path.join(scratch, "ck5")).trigger(availableNow=True).start())
    q.awaitTermination()
    rows = spark.sql("SELECT window.start AS s, total FROM t05_late").collect()
    totals = {r.s.replace(tzinfo=None): r.total for r in rows}
    assert totals.get(dt.datetime(2024, 1, 1, 12, 0)) == 3.0       # the late 100.0 was dropped


def test_dedupe_within_watermark(spark, scratch):
    src = os.path.join(scratch, "dup")
    os.makedirs(src)
    t0 = "2024-01-01T00:00:00"
    lines = [f'{{"customer_id":"c1","event_ts":"{t0}","ss7_requests":1}}'] * 3 + \
            [f'{{"customer_id":"c2","event_ts":"{t0}","ss7_requests":1}}']
    with open(os.path.join(src, "a.txt"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    ev = sources.event_stream(spark, "sdr", src)
    q = (jobs.dedupe_stream(ev).writeStream.format("memory").queryName("t06_dedup")
         .option("checkpointLocation", os.path.join(scratch, "ck6")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.sql("SELECT count(*) AS n FROM t06_dedup").first().n == 2


PROFILE = T.StructType([T.StructField("customer_id", T.StringType()), T.StructField("credit_limit", T.DoubleType()),
                        T.StructField("updated_at", T.TimestampNTZType()), T.StructField("change_seq", T.LongType()),
                        T.StructField("__deleted", T.StringType())])


def test_upserts_rewrite_only_the_buckets_they_touch(spark, scratch):
    table = CurrentTable(spark, os.path.join(scratch, "profiles"), PROFILE, buckets=8)
    ch = fx.profile_changes(Tables(spark, SF_SMALL)).select(*PROFILE.fieldNames())
    table.merge(ch, 0)
    before = table.manifest()
    assert sorted(before["rewritten"]) == list(range(8))
    assert table.read().count() == latest_per_key(ch).count()
    some = table.read().orderBy("customer_id").first()
    at = some.updated_at + dt.timedelta(days=1)
    row = lambda key, limit, when, seq, gone: spark.createDataFrame([(key, limit, when, seq, gone)], PROFILE)
    after = table.merge(row(some.customer_id, -5.0, at, 10**9, "false"), 1)
    assert len(after["rewritten"]) == 1 and after["version"] == before["version"] + 1
    kept = {b: f for b, f in after["buckets"].items() if int(b) not in after["rewritten"]}
    assert kept == {b: before["buckets"][b] for b in kept}
    one = table.read().filter(F.col("customer_id") == some.customer_id)
    assert [r.credit_limit for r in one.collect()] == [-5.0]
    # a replayed batch changes nothing, not even the manifest
    assert table.merge(row(some.customer_id, 77.0, at, 10**9 + 1, "false"), 1) == after
    # a delete removes the key; an older change that comes later doesn't bring it back, a newer one does
    table.merge(row(some.customer_id, None, at, 10**9 + 5, "true"), 2)
    assert one.isEmpty() is False and table.read().filter(F.col("customer_id") == some.customer_id).isEmpty()
    table.merge(row(some.customer_id, 1.0, at, 10**9 + 4, "false"), 3)
    assert table.read().filter(F.col("customer_id") == some.customer_id).isEmpty()
    table.merge(row(some.customer_id, 2.0, at, 10**9 + 6, "false"), 4)
    assert table.read().filter(F.col("customer_id") == some.customer_id).first().credit_limit == 2.0
    # null keys are one key; earlier versions can be read until they are vacuumed; an empty batch is a version
    table.merge(row(None, 3.0, at, 1, None), 5)
    assert table.read().filter("customer_id is null").count() == 1 and table.read(1).filter("customer_id is null").isEmpty()
    assert table.merge(ch.limit(0), 6)["rewritten"] == []
    n = table.read().count()
    assert table.vacuum(keep=1) and table.versions() == [7] and table.read().count() == n


def _json_files(path, files, mtime):
    os.makedirs(path)
    for i, rows in enumerate(files):
        _lines(os.path.join(path, f"{i}.txt"), rows, mtime + i)


def test_open_and_closed_gaps(spark, scratch):
    """A gap is reported while it is open and again when it ends; heartbeats move the watermark."""
    import time
    at = lambda s, kind: f'{{"timestamp":"2024-01-01T{s}","alert_type":"{kind}"}}'
    _json_files(os.path.join(scratch, "a"), [[at("08:00:00", "x"), at("08:00:00.5", "x")], [at("08:01:00", "x")], [at("08:05:00", "x")],
                                             [at("08:05:30", "x")], [at("09:00:00", "heartbeat")], [at("09:10:00", "heartbeat")]], time.time() - 60)
    alerts = spark.readStream.option("maxFilesPerTrigger", 1).schema("timestamp timestamp, alert_type string").json(os.path.join(scratch, "a"))
    out = os.path.join(scratch, "out")
    with stateful.rocksdb_state(spark):
        q = (stateful.silence(alerts, 120, is_alert=F.col("alert_type") != "heartbeat").writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    jobs.finished(q, triggers=6)
    minute = lambda t: t and t.strftime("%H:%M:%S")
    got = sorted(((minute(r.gap_start), minute(r.gap_end) or "", r.gap_seconds) for r in spark.read.parquet(out).collect()), key=str)
    assert got == [("08:01:00", "", None), ("08:01:00", "08:05:00", 240), ("08:05:30", "", None)]


def test_streams_sharing_a_store_keep_each_others_batches(spark, scratch):
    """Two queries number their micro-batches independently; batch 0 of one must
    not overwrite batch 0 of the other in a shared store."""
    store, act = os.path.join(scratch, "store"), os.path.join(scratch, "act")
    t = Tables(spark, SF_SMALL)
    a = detect(fx.stream(t, "sdr"), "sdr")
    b = detect(fx.stream(t, "payments"), "payments")
    sinks.dual_sink(store, act, source="sdr")(a, 0)
    sinks.dual_sink(store, act, source="payments")(b, 0)
    assert spark.read.parquet(store).count() == a.count() + b.count()


def _lines(path, rows, mtime):
    with open(path, "w") as fh:
        fh.write("\n".join(rows) + "\n")
    os.utime(path, (mtime, mtime))


def test_events_take_the_version_valid_at_their_time(spark, scratch):
    """An event waits for the watermark, so a version that comes after it in the stream but before it in time counts."""
    import time
    _json_files(os.path.join(scratch, "ch"), [
        ['{"customer_id":"c1","lim":500.0,"at":"2024-01-01T08:00:00","seq":1,"__deleted":"false"}'],
        ['{"customer_id":"c1","lim":700.0,"at":"2024-01-01T09:59:00.000001","seq":2}', '{"customer_id":"c1","lim":701.0,"at":"2024-01-01T09:59:00.000001","seq":3}'],
        ['{"customer_id":"c1","lim":9.0,"at":"2024-01-01T11:00:00","seq":4,"__deleted":"true"}', '{"customer_id":null,"lim":4.0,"at":"2024-01-01T08:00:00","seq":5}'],
        ['{"customer_id":"c9","lim":1.0,"at":"2024-01-03T08:00:00","seq":6}']], time.time() - 60)
    ev = lambda key, s, n: f'{{"customer_id":{key},"event_ts":"2024-01-01T{s}","n":{n}}}'
    _json_files(os.path.join(scratch, "ev"), [
        [ev('"c1"', "10:00:00", 1), ev('"c2"', "10:00:00", 2), ev('"c1"', "07:59:59", 3), ev('"c1"', "09:59:00.000001", 4)],
        [ev("null", "10:30:00", 5), ev('"c1"', "09:59:00", 6)], [ev('"c1"', "12:00:00", 7)],
        ['{"customer_id":"c9","event_ts":"2024-01-03T10:00:00","n":9}']], time.time() - 60)
    read = lambda name, schema: spark.readStream.option("maxFilesPerTrigger", 1).schema(schema).json(os.path.join(scratch, name))
    rows = stateful.enrich(read("ev", "customer_id string, event_ts timestamp, n int"),
                           read("ch", "customer_id string, lim double, at timestamp, seq long, __deleted string"),
                           "customer_id", "event_ts", "at", "seq", ("lim",), "__deleted", watermark="1 hour", spread=3)
    out = os.path.join(scratch, "out")
    with stateful.rocksdb_state(spark):
        q = (rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", os.path.join(scratch, "ck"))
             .trigger(availableNow=True).start())
    jobs.finished(q, triggers=4)
    got = {r.n: r.lim for r in spark.read.parquet(out).collect()}
    assert got == {1: 701.0, 2: None, 3: None, 4: 701.0, 5: None, 6: 500.0, 7: None}


def test_a_bucket_of_keys_takes_each_keys_own_versions():
    """Many keys share a state key, whose rows are handled together, not key by key."""
    rnd = random.Random(3)
    keys = ["a", "b", "c", None]
    versions = [(rnd.randrange(30), s, rnd.choice(keys[:3]), f"v{s}") for s in range(40)]
    events = [(rnd.randrange(20), rnd.choice(keys), f"e{i}") for i in range(60)]
    ev = pa.table(dict(zip(stateful.AsOf.EVENT.names, map(list, zip(*events)))), stateful.AsOf.EVENT)
    vr = pa.table(dict(zip(stateful.AsOf.VERSION.names, map(list, zip(*versions)))), stateful.AsOf.VERSION)
    ev, vr = (stateful._unpack([stateful._pack(x.slice(0, 7)), stateful._pack(x.slice(7))], x.schema) for x in (ev, vr))
    taken, kept = stateful._valid(ev, vr, 20)
    for (at, k, _), got in zip(events, taken):
        may = [(v[0], v[1], i) for i, v in enumerate(versions) if v[2] == k and v[0] <= at]
        assert got == (max(may)[2] if may else -1)
    for i, (at, seq, k, _) in enumerate(versions):
        last = max((v[:2] for v in versions if v[2] == k and v[0] < 20), default=None)
        assert kept[i] == (at >= 20 or (at, seq) == last)
    none = stateful._valid(ev, stateful.AsOf.VERSION.empty_table(), 20)
    assert (none[0] == -1).all() and len(none[1]) == 0


def test_a_task_sends_runs_not_alerts():
    """Alerts without a long gap between them reach the one state key as one run, over all batches of a task."""
    at = lambda s: pd.DataFrame({"ts": pd.to_datetime(np.array(s) * 1_000_000, unit="us"), "alert": [True] * len(s)})
    dense = list(range(0, 5000, 100))
    random.Random(1).shuffle(dense)
    sent = pd.concat(stateful._alert_runs(iter([at(dense[:20]), at(dense[20:] + [5021, 5200]), at([5321])]), 120))
    assert list(zip(sent["start"] // 1_000_000, sent["end"] // 1_000_000)) == [(0, 4900), (5021, 5021), (5200, 5200), (5321, 5321)]
    assert list(stateful._alert_runs(iter([at([])]), 120)) == []


def test_brute_force_and_burst_streams(spark, scratch):
    """T07 live: sliding 10-minute windows of failures; T10: burst windows above a threshold."""
    import time
    now = time.time()
    src = os.path.join(scratch, "logins")
    os.makedirs(src)
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    burst = [f'{{"customer_id":1,"ts":"{(t0 + dt.timedelta(seconds=30 * i)).isoformat()}","is_failure":true}}'
             for i in range(6)]
    _lines(os.path.join(src, "a.txt"), burst, now - 50)
    _lines(os.path.join(src, "b.txt"), ['{"customer_id":2,"ts":"2024-01-02T00:00:00","is_failure":true}'], now - 40)
    _lines(os.path.join(src, "c.txt"), ['{"customer_id":2,"ts":"2024-01-02T00:01:00","is_failure":true}'], now - 30)
    logins = spark.readStream.option("maxFilesPerTrigger", 1).schema(
        "customer_id long, ts timestamp, is_failure boolean").json(src)
    out = os.path.join(scratch, "bf")
    q = (jobs.brute_force_stream(logins).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    fired = spark.read.parquet(out)
    assert fired.filter("customer_id = 1").count() > 0
    assert fired.filter("customer_id = 2").count() == 0
    # T10 burst: same input seen as alerts; a 5-minute window with more than 3 alerts fires
    alerts = spark.readStream.option("maxFilesPerTrigger", 1).schema(
        "customer_id long, ts timestamp, is_failure boolean").json(src) \
        .select(F.col("ts").alias("timestamp"), F.lit("SIM Box / Gateway Bypass [High Confidence]").alias("alert_type"))
    out2 = os.path.join(scratch, "burst")
    q2 = (jobs.burst_stream(alerts, 5, 3).writeStream.format("parquet").option("path", out2)
          .option("checkpointLocation", os.path.join(scratch, "ck2")).trigger(availableNow=True).start())
    q2.awaitTermination()
    assert [r.alerts for r in spark.read.parquet(out2).filter("fired").collect()] == [6]


def test_messages_are_packed_at_the_fastest_level(spark, scratch):
    """Action messages are gzip files at its fastest level: larger than at the usual one, and read back whole."""
    alerts = fx.alerts(Tables(spark, SF_SMALL)).limit(1000).withColumn("rule_id", F.lit("r01")).coalesce(1)
    sinks.write_action_batch(alerts, 0, f"{scratch}/actions")
    parts = [os.path.join(d, f) for d, _, names in os.walk(f"{scratch}/actions") for f in names if f.endswith(".gz")]
    packed = open(parts[0], "rb").read()
    assert len(parts) == 1 and len(packed) > 1.03 * len(gzip.compress(gzip.decompress(packed), 6))
    assert spark.read.json(f"{scratch}/actions").count() == alerts.count() > 500
