"""Skew-safe building blocks for per-key sequence analytics.

A plain ``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to
one task; if one customer holds a third of all rows that task holds a third
of the data.  The helpers below never partition rows by the key alone:

* rows are first cut into (key, time bucket) partitions, so a hot key is
  spread over as many tasks as it has buckets;
* what crosses a bucket boundary is carried by a *bucket-level* table (one row
  per key and bucket, i.e. bounded by the time span, not by the row count): the
  last rows of each bucket, cut to k in the map tasks, then a window over buckets;
* rows themselves are shuffled once, by (key, bucket), and never copied;
* range lookbacks (count in the last hour) copy only the rows near a bucket's
  end into the next bucket as read-only "halo" rows.

* the nearest partner in time (``nearest``) is a sweep over both sides, never a join
  of all pairs.

All of it is built from DataFrame windows, joins and aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

c = F.col
DAY = 86400


def col_(x) -> Column:
    return c(x) if isinstance(x, str) else x


def epoch_seconds(ts) -> Column:
    """Seconds since the epoch (double, microsecond precision)."""
    return F.unix_micros(col_(ts).cast("timestamp")) / 1_000_000.0


def time_bucket(ts, seconds: int) -> Column:
    return F.floor(epoch_seconds(ts) / seconds).cast("long")


def _bucketed(df: DataFrame, keys: list[str], ts, seconds: int) -> DataFrame:
    """``_g``: (keys, time bucket) as one struct, so that null keys and times compare as equal in joins."""
    return df.withColumn("_g", F.struct(*[c(k) for k in keys], time_bucket(ts, seconds).alias("_bkt")))


def _last_rows(b: DataFrame, order: list[Column], payload: Column, k: int) -> DataFrame:
    """(``_g``, ``_last``): the payloads of the last ``k`` rows of each bucket, in order.

    ``row_number() <= k`` is cut in the map tasks already (a group limit before the
    shuffle), so a bucket sends at most ``k`` rows from each task.
    """
    down = Window.partitionBy("_g").orderBy(*[o.desc() for o in order])
    top = b.select("_g", payload.alias("_pay"), F.row_number().over(down).alias("_rn")).filter(c("_rn") <= k)
    listed = F.array_sort(F.collect_list(F.struct((-c("_rn")).alias("n"), c("_pay").alias("p"))))
    return top.groupBy("_g").agg(listed.alias("_l")).select("_g", c("_l.p").alias("_last"))


def _carry(last: DataFrame, keys: list[str], k: int) -> DataFrame:
    """(``_g``, ``_carry``): the last ``k`` payloads before each bucket.

    A bucket that occurs has a row, so the ``k`` occupied buckets before it suffice.
    The window is over one row per key and occupied bucket.
    """
    w = Window.partitionBy(*[c(f"_g.{x}") for x in keys]).orderBy(c("_g._bkt"))
    before = F.flatten(F.array_compact(F.array(*[F.lag("_last", i).over(w) for i in range(k, 0, -1)])))
    return last.select("_g", before.alias("_b")).select("_g", F.when(F.size("_b") > 0, F.slice("_b", F.greatest(F.size("_b") - k + 1, F.lit(1)), k)).alias("_carry"))


def previous_rows(df: DataFrame, keys: list[str], order: list[str], cols: list[str], k: int = 1,
                  bucket_seconds: int = DAY, prefix: str = "prev") -> DataFrame:
    """Attach the ``cols`` of the k preceding rows of the same key.

    Output columns: all input columns plus ``{prefix}_{col}`` (k = 1) or
    ``{prefix}{i}_{col}`` for i = 1..k; NULL where no such row exists.  The first order
    column is the time; rows without a time come first, rows without a key are a key.
    Rows are shuffled once, by (key, bucket).
    """
    keys = list(keys)
    by = [col_(o) for o in order]
    payload = F.struct(*[c(x) for x in cols])
    b = _bucketed(df, keys, order[0], bucket_seconds)
    w = Window.partitionBy("_g").orderBy(*by)
    ranked = b.select("*", F.row_number().over(w).alias("_rn"), *[F.lag(payload, i).over(w).alias(f"_p{i}") for i in range(1, k + 1)])
    carry = _carry(_last_rows(b, by, payload, k), keys, k)
    j = ranked.join(carry, "_g", "left")
    # the row i places back is in an earlier bucket where the bucket has fewer rows before this one
    back = lambda i: F.coalesce(c(f"_p{i}"), F.when(c("_rn") <= i, F.get("_carry", F.size("_carry") - 1 - (F.lit(i) - c("_rn")))))
    found = j.select(*[c(f"`{n}`") for n in df.columns], *[back(i).alias(f"_f{i}") for i in range(1, k + 1)])

    def name(i, x):
        return f"{prefix}_{x}" if k == 1 else f"{prefix}{i}_{x}"
    return found.select(*[c(f"`{n}`") for n in df.columns], *[c(f"_f{i}.{x}").alias(name(i, x)) for i in range(1, k + 1) for x in cols])


def last_before(df: DataFrame, keys: list[str], ts: str, value: Column, out: str,
                inclusive: bool = False, bucket_seconds: int = DAY, tiebreak: list[str] | None = None
                ) -> DataFrame:
    """Carry forward: for each row, the ``value`` of the latest earlier row of the
    same key where ``value`` is not NULL (``inclusive`` also looks at the row itself).

    Order is (ts, tiebreak...), rows without a time first; rows without a key are a key.
    Works per (key, bucket) plus a bucket-level carry; rows are shuffled once.
    """
    keys = list(keys)
    order = [c(ts)] + [c(t) for t in (tiebreak or [])]
    b = _bucketed(df.withColumn("_v", F.when(value.isNotNull(), F.struct(value.alias("v")))), keys, ts, bucket_seconds)
    w = Window.partitionBy("_g").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    within = b.withColumn("_within", F.last("_v", ignorenulls=True).over(w))
    last = _last_rows(b.filter(c("_v").isNotNull()), order, c("_v"), 1)
    # the carry of a bucket without a value of its own needs its row, too
    marks = b.select("_g").distinct().join(last, "_g", "left")
    up = Window.partitionBy(*[c(f"_g.{x}") for x in keys]).orderBy(c("_g._bkt")).rowsBetween(Window.unboundedPreceding, -1)
    carry = marks.select("_g", F.last(F.get("_last", F.lit(0)), ignorenulls=True).over(up).alias("_carry"))
    return (within.join(carry, "_g", "left").withColumn(out, F.coalesce(c("_within"), c("_carry")).getField("v"))
            .select(*[c(f"`{n}`") for n in df.columns], out))


def range_count(df: DataFrame, keys: list[str], ts: str, lookback_seconds: int, out: str,
                cond: Column | None = None, bucket_seconds: int | None = None, ahead_seconds: int = 0) -> DataFrame:
    """For each row: number of rows of the same key (optionally those meeting
    ``cond``) with time in [ts - lookback, ts + ahead] (peers included).

    Halo technique: a row within ``lookback`` of its bucket's end (``ahead`` of its start) is
    also copied into the next (previous) bucket as context; windows run per (key, bucket).
    The bucket is at least twice as wide, so at most half the rows (a quarter with
    the 4x buckets used by callers) are copied to each side.
    """
    return range_counts(df, keys, ts, lookback_seconds, {out: F.lit(True) if cond is None else cond}, bucket_seconds, ahead_seconds)


def range_counts(df: DataFrame, keys: list[str], ts: str, lookback_seconds: int, conds: dict[str, Column],
                 bucket_seconds: int | None = None, ahead_seconds: int = 0) -> DataFrame:
    """``range_count`` of several conditions (output column to condition) over one window."""
    keys = list(keys)
    width = max(bucket_seconds or DAY, 2 * max(lookback_seconds, ahead_seconds)) * 1_000_000
    look, ahead = lookback_seconds * 1_000_000, ahead_seconds * 1_000_000
    base = df.withColumn("_e", F.unix_micros(col_(ts).cast("timestamp"))) \
        .withColumn("_bkt", F.floor(c("_e") / width).cast("long")) \
        .withColumns({f"_hit_{i}": F.coalesce(x.cast("int"), F.lit(0)) for i, x in enumerate(conds.values())})
    sides = [(c("_e") >= (c("_bkt") + 1) * width - look, c("_bkt") + 1)]
    if ahead:
        sides.append((c("_e") < c("_bkt") * width + ahead, c("_bkt") - 1))
    allrows = base.withColumn("_halo", F.lit(False))
    for near, to in sides:
        allrows = allrows.unionByName(base.filter(near).withColumn("_bkt", to).withColumn("_halo", F.lit(True)))
    w = Window.partitionBy(*keys, "_bkt").orderBy("_e").rangeBetween(-look, ahead)
    counted = allrows.select("*", *[F.sum(f"_hit_{i}").over(w).alias(out) for i, out in enumerate(conds)])
    return counted.filter(~c("_halo")).drop("_e", "_bkt", "_halo", *[f"_hit_{i}" for i in range(len(conds))])


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], ts: str, right_ts: str, after_s: int) -> DataFrame:
    """All pairs of rows of one key where the right time is from the left one to ``after_s`` later.

    The key is extended with a time bucket ``after_s`` wide: each right row is in one, each left
    row goes to the (at most two) buckets that its interval touches.  A hot key is split by
    time, and a pair is made once.  Rows without a key or a time have no partner.
    """
    first = time_bucket(ts, after_s)
    lx = left.withColumn("_jb", F.explode(F.array(first, first + 1)))
    rx = right.withColumn("_jb", time_bucket(right_ts, after_s))
    return lx.join(rx, [*keys, "_jb"]).filter(c(right_ts).between(c(ts), F.timestamp_add("SECOND", F.lit(after_s), c(ts)))).drop("_jb")


def nearest(events: DataFrame, marks: DataFrame, keys: list[str], ts: str, mark_ts: str, mark_order: list[str],
            before_s: int, after_s: int, mark: str = "mark", count: str = "marks") -> DataFrame:
    """Each event with the number of ``marks`` of its key from ``before_s`` before to ``after_s`` after it, and the nearest of them.

    A sweep over the union of both sides, per (key, time bucket): a mark goes to the (at most
    two) buckets of the times that it is in range of.  There it opens and closes a range, and
    an event's count is the number of ranges open at its time; the last mark at or before the
    event and the first at or after it are carried along.  No pairs are made, and each row is
    looked at once in either direction, however many rows are near it.  Of marks equally near
    the earlier one is taken, of those at one time the last by ``mark_order``.  Events without a
    mark in range are left out; so are events and marks without a key or a time.
    """
    keys = list(keys)
    before, after = before_s * 1_000_000, after_s * 1_000_000
    width = max(2 * (before + after), 3_600_000_000)
    own = F.struct(*[c(f"`{n}`") for n in events.columns])
    other = F.struct(*[c(f"`{n}`") for n in marks.columns])
    known = lambda df, t: df.filter(F.col(t).isNotNull()).dropna(subset=keys)
    micros = lambda t: F.unix_micros(c(t).cast("timestamp"))
    bucket = lambda t: F.floor(t / F.lit(width)).cast("long")
    ties = F.struct(*[c(o).alias(f"o{i}") for i, o in enumerate(mark_order)])
    ev = known(events, ts).select(*keys, micros(ts).alias("_t"), own.alias("_ev")).withColumn("_bkt", bucket(c("_t")))
    mk = known(marks, mark_ts).select(*keys, micros(mark_ts).alias("_t"), other.alias("_mark"), ties.alias("_o"))
    mk = mk.withColumn("_bkt", F.explode(F.sequence(bucket(c("_t") - after), bucket(c("_t") + before))))
    both = ev.unionByName(mk, allowMissingColumns=True).repartition(*keys, "_bkt")
    # at one time ranges open before marks, marks come before events, events before ranges close
    at = lambda t, kind, delta: F.struct(t.alias("t"), F.lit(kind).alias("k"), F.lit(delta).alias("d"))
    event, points = F.array(at(c("_t"), 2, 0)), F.array(at(c("_t") - after, 0, 1), at(c("_t"), 1, 0), at(c("_t") + before, 3, -1))
    rows = both.withColumn("_at", F.explode(F.when(c("_ev").isNotNull(), event).otherwise(points)))
    point = F.when(c("_at.k") == 1, F.struct(c("_at.t").alias("t"), c("_mark").alias("m")))
    rows = rows.select(*keys, "_bkt", "_ev", "_o", c("_at.t").alias("_t"), c("_at.k").alias("_k"), c("_at.d").alias("_d"), point.alias("_mark"))
    up = Window.partitionBy(*keys, "_bkt").orderBy("_t", "_k", "_o").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*keys, "_bkt").orderBy(c("_t").desc(), "_k", "_o").rowsBetween(Window.unboundedPreceding, 0)
    swept = rows.select("*", F.sum("_d").over(up).alias("_n"), F.last("_mark", ignorenulls=True).over(up).alias("_past"))
    swept = swept.filter((c("_k") == 1) | (c("_k") == 2) & (c("_n") > 0))
    swept = swept.withColumn("_next", F.last("_mark", ignorenulls=True).over(down)).filter(c("_k") == 2)
    gap_past, gap_next = c("_t") - c("_past.t"), c("_next.t") - c("_t")
    in_past, in_next = gap_past <= before, gap_next <= after
    pick = F.when(in_past & (~F.coalesce(in_next, F.lit(False)) | (gap_past <= gap_next)), c("_past.m")).when(in_next, c("_next.m"))
    return swept.select("_ev.*", c("_n").alias(count), pick.alias(mark))
