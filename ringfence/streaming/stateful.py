"""Keyed, versioned state and event-time timers.

Processors for ``transformWithState``.  Its state lives in the RocksDB store
(``rocksdb_state`` sets the provider), so a key's lists are read and written entry by
entry and are not bound by a task's memory.
"""

from __future__ import annotations

from functools import partial
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

c = F.col
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class rocksdb_state:
    """Start a query with processors under the RocksDB store; the session's own setting is restored."""

    KEY = "spark.sql.streaming.stateStore.providerClass"

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self):
        self.old = self.spark.conf.get(self.KEY)
        self.spark.conf.set(self.KEY, ROCKSDB)
        return self

    def __exit__(self, *exc):
        self.spark.conf.set(self.KEY, self.old)
        return False


#: Timestamps in state keep their microseconds.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


#: Rows in a list state come in packs: one entry holds many rows as an Arrow stream, with their time range beside it.
PACK = T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType()), T.StructField("rows", T.BinaryType())])


def _pack(rows: pa.Table) -> tuple:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
        out.write_table(rows)
    at = rows["at"].to_numpy()
    return int(at.min()), int(at.max()), sink.getvalue().to_pybytes()


def _unpack(packs: list, columns: pa.Schema) -> pa.Table:
    tables = [pa.ipc.open_stream(p[2]).read_all() for p in packs]
    return pa.concat_tables(tables) if tables else columns.empty_table()


class AsOf(StatefulProcessor):
    """Events wait for the watermark, then take the version valid at their time.

    A state key is a bucket of many keys (``k``), so that state is read and written a pack
    of rows at a time.  ``versions`` holds each key's versions that are newer than the
    watermark, and the last one before it; ``waiting`` the events that the watermark hasn't
    passed; ``due`` the time of the one timer that counts, the first waiting event's.  When
    the watermark passes an event, no version of its time can come any more, so each
    event is emitted once, with one version.  Events later than the watermark were
    dropped upstream.
    """

    VERSION = pa.schema([("at", pa.int64()), ("seq", pa.int64()), ("k", pa.string()), ("row", pa.string())])
    EVENT = pa.schema([("at", pa.int64()), ("k", pa.string()), ("row", pa.string())])
    DUE = T.StructType([T.StructField("ms", T.LongType())])
    OUTPUT = "event string, version string"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.versions = handle.getListState("versions", PACK)
        self.waiting = handle.getListState("waiting", PACK)
        self.due = handle.getValueState("due", self.DUE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for pdf in rows:
            kind = pdf["kind"].to_numpy()
            # a version without a key is valid for no event
            v, e = pdf[(kind == 0) & pdf["k"].notna().to_numpy()], pdf[kind == 1]
            if len(v):
                self.versions.appendValue(_pack(pa.Table.from_pandas(v, self.VERSION, preserve_index=False)))
            if len(e):
                pack = _pack(pa.Table.from_pandas(e, self.EVENT, preserve_index=False))
                self.waiting.appendValue(pack)
                first = pack[0] if first is None else min(first, pack[0])
        if first is not None:
            self._wake(first)
        return iter(())

    def _wake(self, at: int) -> None:
        """A timer for the event at ``at``, unless an earlier one is set."""
        ms = at // 1000 + 1  # timers have milliseconds: the one after the event's time
        if not self.due.exists() or ms < self.due.get()[0]:
            self.due.update((ms,))
            self.handle.registerTimer(ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        if not self.due.exists() or self.due.get()[0] > now:  # a timer whose events went with an earlier one
            return
        self.due.clear()
        mark = now * 1000
        packs = list(self.waiting.get())
        events = _unpack([p for p in packs if p[0] < mark], self.EVENT)
        later = [p for p in packs if p[0] >= mark]
        ready = events["at"].to_numpy() < mark
        if not ready.all():
            later.append(_pack(events.filter(pa.array(~ready))))
        events = events.filter(pa.array(ready))
        if later:
            self.waiting.put(later)
            self._wake(min(p[0] for p in later))
        else:
            self.waiting.clear()
        versions = _unpack(list(self.versions.get()), self.VERSION)
        taken, kept = _valid(events, versions, mark)
        if kept.all():
            pass
        elif kept.any():
            self.versions.put([_pack(versions.filter(pa.array(kept)))])
        else:
            self.versions.clear()
        got = versions["row"].take(pa.array(taken, mask=taken < 0))
        yield pd.DataFrame({"event": events["row"].to_pandas(), "version": got.to_pandas()})

    def close(self) -> None:
        pass


def _valid(events: pa.Table, versions: pa.Table, mark: int) -> tuple[np.ndarray, np.ndarray]:
    """For each event the row number of the version valid at its time (-1: none); for each version
    whether an event at ``mark`` or later may still take it."""
    n = versions.num_rows
    code = pd.factorize(np.concatenate([versions["k"].to_pandas().to_numpy(object), events["k"].to_pandas().to_numpy(object)]))[0]
    at = np.concatenate([versions["at"].to_numpy(), events["at"].to_numpy()])
    seq = np.concatenate([versions["seq"].to_numpy(), np.zeros(events.num_rows, np.int64)])
    event = np.arange(len(at)) >= n
    order = np.lexsort((seq, event, at, code))
    code, spot = code[order], np.arange(len(order))
    new = np.ones(len(order), bool)
    new[1:] = code[1:] != code[:-1]
    start = np.maximum.accumulate(np.where(new, spot, 0))
    latest = np.maximum.accumulate(np.where(event[order], -1, spot))
    valid = np.where(latest >= start, order[latest], -1)
    taken = np.empty(len(order), np.int64)
    taken[order] = valid
    # the version carried up to the watermark: the last one of a key whose time is before it
    kept = at[:n] >= mark
    past = order[~event[order] & (at[order] < mark)]
    if len(past):
        keys = np.empty(len(order), np.int64)
        keys[order] = code
        last = np.append(keys[past[1:]] != keys[past[:-1]], True)
        kept[past[last]] = True
    return taken[n:], kept


def enrich(events: DataFrame, versions: DataFrame, key: str, event_ts: str, version_ts: str, seq: str,
           fields: tuple[str, ...], deleted: str, watermark: str = "10 minutes", spread: int = 8,
           buckets: int = 256) -> DataFrame:
    """One row per event, with ``fields`` of the version valid at its time; a delete closes a profile.

    Both streams have watermarks; the slower one holds back the events.  Keys share ``buckets``
    state keys; a task holds one bucket's waiting events and versions at a time.  A hot key is
    spread over ``spread`` of them: each event goes to one, each version to all
    (versions are few beside events).  A row without a time has that of its arrival; an
    event without a key keeps null fields.
    """
    timed = lambda df, ts: df.withColumn(ts, F.coalesce(c(ts).cast("timestamp"), F.current_timestamp())).withWatermark(ts, watermark)
    ev, vr = timed(events, event_ts), timed(versions, version_ts)
    names = ev.columns
    shape = ev.schema
    live = F.coalesce(c(deleted), F.lit("false")) != "true"
    # a null key has no profile
    vr = vr.withColumn("_live", live & c(key).isNotNull())
    spots = F.pmod(F.xxhash64(*names), F.lit(spread)).cast("int")
    e = ev.select(c(event_ts).alias("ts"), c(key).cast("string").alias("k"), spots.alias("spot"), F.unix_micros(event_ts).alias("at"), F.lit(0).cast("long").alias("seq"),
                  F.lit(1).alias("kind"), F.to_json(F.struct(*names), _JSON).alias("row"))
    v = vr.select(c(version_ts).alias("ts"), c(key).cast("string").alias("k"), F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("spot"),
                  F.unix_micros(version_ts).alias("at"), F.coalesce(c(seq).cast("long"), F.lit(-1 << 63)).alias("seq"), F.lit(0).alias("kind"),
                  F.to_json(F.struct(*[F.when(c("_live"), c(f)).alias(f) for f in fields]), _JSON).alias("row"))
    kinds = T.StructType([vr.schema[f] for f in fields])
    both = e.unionByName(v).withColumn("bucket", F.pmod(F.xxhash64("k", "spot"), F.lit(buckets)).cast("int")).drop("spot")
    out = both.groupBy("bucket").transformWithStateInPandas(
        AsOf(), AsOf.OUTPUT, "Append", "eventTime")
    got = out.select(F.from_json("event", shape, _JSON).alias("e"), F.from_json("version", kinds, _JSON).alias("v"))
    return got.select("e.*", *[c(f"v.{f}").alias(f) for f in fields])


class Silence(StatefulProcessor):
    """Gaps between alerts, by event time.

    Alerts come as runs: from one alert to another with no gap of more than ``seconds``
    between.  ``last`` is the newest alert of the runs that the watermark has reached (the
    end of the run it is in, maybe ahead of it), ``ahead`` the runs that it hasn't.
    """

    RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    LAST = T.StructType([T.StructField("at", T.LongType()), T.StructField("told", T.BooleanType())])
    OUTPUT = "gap_start timestamp, gap_end timestamp, gap_seconds long"

    def __init__(self, seconds: int):
        self.seconds = seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ahead = handle.getListState("ahead", self.RUN)
        self.last = handle.getValueState("last", self.LAST)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        got = [pdf[["start", "end"]].to_numpy("int64") for pdf in rows]
        runs = _runs(np.concatenate(got), self.seconds) if got else ()
        if len(runs):
            self.ahead.appendList([(int(a), int(b)) for a, b in runs])
            self.handle.registerTimer(int(runs[0][0]) // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        runs = sorted(tuple(r) for r in self.ahead.get())
        due = [r for r in runs if r[0] < mark]
        last, told = self.last.get() if self.last.exists() else (None, False)
        out = []
        for start, end in due:
            if last is not None and (gap := start // 1_000_000 - last // 1_000_000) > self.seconds:
                out.append((last, start, gap))
            last, told = max(end, last or end), False
        left = runs[len(due):]
        if due:
            self.ahead.put(left) if left else self.ahead.clear()
        if left:
            self.handle.registerTimer(left[0][0] // 1000 + 1)
        if last is not None:
            alarm = last // 1000 + self.seconds * 1000 + 1000
            if not told and alarm * 1000 < mark and (not left or left[0][0] // 1000 > alarm):
                out.append((last, None, None))
                told = True
            elif not told:
                self.handle.registerTimer(alarm)
            self.last.update((last, told))
        if out:
            times = [pd.to_datetime([x[i] for x in out], unit="us") for i in (0, 1)]
            yield pd.DataFrame({"gap_start": times[0], "gap_end": times[1], "gap_seconds": pd.Series([x[2] for x in out], dtype="Int64")})

    def close(self) -> None:
        pass


def silence(alerts: DataFrame, seconds: int = 120, watermark: str = "1 minute", ts: str = "timestamp",
            is_alert: Column | None = None) -> DataFrame:
    """T10 / L02 live: gaps of more than ``seconds`` without an alert, by event time.

    An open gap (null ``gap_end``) is reported once, as soon as the watermark shows it; a
    closed one when the watermark passes the alert that ends it.  Rows that aren't
    ``is_alert`` (heartbeats, or the traffic that alerts are made of) only move the
    watermark: without alerts nothing else would.  Each task sends the runs of its alerts to the
    one state key (start and end, no gap of more than ``seconds`` between), not every alert:
    alerts of other tasks inside a run only make its gaps smaller.
    """
    rows = alerts.select(c(ts).cast("timestamp").alias("ts"), (F.lit(True) if is_alert is None else is_alert).alias("alert"))
    # a filter here would be pushed below the watermark and hide these rows from it; ``_alert_runs`` drops them
    reduced = rows.withWatermark("ts", watermark).mapInPandas(partial(_alert_runs, seconds=seconds), "channel string, start long, end long")
    return reduced.groupBy("channel").transformWithStateInPandas(Silence(seconds), Silence.OUTPUT, "Append", "eventTime")


def _runs(spans: np.ndarray, seconds: int) -> np.ndarray:
    """Spans (first, last; microseconds) merged where no gap of more than ``seconds`` whole seconds is between them."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    if not len(spans):
        return spans
    end = np.maximum.accumulate(spans[:, 1])
    cut = spans[1:, 0] // 1_000_000 - end[:-1] // 1_000_000 > seconds
    return np.column_stack([spans[np.append(True, cut), 0], end[np.append(cut, True)]])


#: Spans that a task holds before it merges them into runs.
SPANS = 1_000_000


def _alert_runs(batches: Iterator[pd.DataFrame], seconds: int) -> Iterator[pd.DataFrame]:
    """The runs of all of a task's alerts."""
    held, size, bound = [np.empty((0, 2), np.int64)], 0, SPANS
    for pdf in batches:
        at = pdf.loc[pdf["alert"] & pdf["ts"].notna(), "ts"].astype("datetime64[us]").astype("int64").to_numpy()
        held.append(np.column_stack([at, at]))
        size += len(at)
        if size > bound:
            held = [_runs(np.concatenate(held), seconds)]
            size = len(held[0])
            bound = max(SPANS, 2 * size)
    runs = _runs(np.concatenate(held), seconds)
    if len(runs):
        yield pd.DataFrame({"channel": "alerts", "start": runs[:, 0], "end": runs[:, 1]})
