"""Packing documents into padded batches with optimal length buckets.

The global histogram of lengths is one small aggregate.  Dynamic programming over
it chooses the bucket boundaries that minimise padding, and batches of a token
budget form inside each bucket.  Large buckets are dealt out over shards of bounded
size, so no task numbers more than about ``SHARD_ROWS`` documents; a shard ends in
at most one batch that isn't full.

Histogram cells: every length up to ``FINE`` is a cell of its own, longer ones share
cells of a 256th of their power of two (a boundary is always a length that occurs).
So the histogram has at most ``FINE`` + 256 * 54 rows whatever the input, and the
optimum is exact where all lengths are at most ``FINE`` and over cell boundaries
beyond.

Cases: null and empty texts have length one (the end token); a document longer than
the budget has a batch of its own and is never cut; equal lengths are one cell;
repeated rows are packed each; an empty table gives an empty table; the caller's
other columns are not touched (``assign`` returns its own columns only).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import body, words

BUCKETS, BUDGET, FINE, SHARD_ROWS = 16, 8192, 1024, 1 << 16


def token_length(text) -> Column:
    """Words and one end token."""
    return (F.size(words(body(text))) + 1).cast("long")


def _cell(length: Column) -> Column:
    step = F.pow(F.lit(2.0), F.floor(F.log2(length.cast("double"))) - 8).cast("long")
    return F.when(length <= FINE, length).otherwise(F.ceil(length / F.greatest(step, F.lit(1))) * F.greatest(step, F.lit(1)))


def boundaries(length: np.ndarray, count: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """The at most ``buckets`` upper bounds, out of ``length`` (ascending), that minimise padding for ``count`` documents each."""
    k = len(length)
    if not k:
        return []
    total = np.append(0, np.cumsum(count)).astype(np.float64)
    cost = np.append(0.0, np.full(k, np.inf))
    came = np.zeros((buckets + 1, k + 1), np.int32)
    best, used = np.inf, 0
    for b in range(1, min(buckets, k) + 1):
        new = np.append(np.inf, np.full(k, np.inf))
        for j in range(1, k + 1):  # the last bucket ends at length[j-1] and begins after i
            each = cost[:j] + length[j - 1] * (total[j] - total[:j])
            i = int(each.argmin())
            new[j], came[b, j] = each[i], i
        cost = new
        if cost[k] < best:
            best, used = cost[k], b
    out, j = [], k
    for b in range(used, 0, -1):
        out.append(int(length[j - 1]))
        j = int(came[b, j])
    return out[::-1]


def histogram(lengths: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    rows = lengths.groupBy(_cell(F.col("length")).alias("cell")).agg(F.max("length"), F.count("*")).collect()
    rows.sort(key=lambda r: r[1])
    return np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64)


def assign(docs: DataFrame, doc_id: str = "doc_id", length: Column | None = None, buckets: int = BUCKETS,
           budget: int = BUDGET, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``length``, ``bucket``, ``padded`` (the bucket's length), ``shard``, ``batch``, ``slot``.

    ``length`` is a column of token counts (words and an end token of ``text`` if
    left out); a batch is one (bucket, shard, batch) and holds at most
    ``max(1, budget // padded)`` documents.
    """
    sized = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), (token_length("text") if length is None else length).cast("long").alias("length"))
    size, count = histogram(sized)
    bound = boundaries(size, count, buckets)
    if not bound:
        return sized.limit(0).select("doc_id", "length", *[F.lit(0).cast(t).alias(c) for c, t in (
            ("bucket", "int"), ("padded", "long"), ("shard", "int"), ("batch", "long"), ("slot", "int"))])
    held = [int(count[(size <= b) & (size > a)].sum()) for a, b in zip([-1, *bound], bound)]
    bucket = F.lit(len(bound) - 1)
    for i in range(len(bound) - 2, -1, -1):
        bucket = F.when(F.col("length") <= bound[i], F.lit(i)).otherwise(bucket)
    of = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("bucket") + 1)
    shards = [-(-h // shard_rows) or 1 for h in held]
    out = (sized.withColumn("bucket", bucket).withColumn("padded", of([np.int64(b).item() for b in bound]).cast("long"))
           .withColumn("shard", F.pmod(F.xxhash64("doc_id", "length"), of(shards)).cast("int")))
    place = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("doc_id", "length")) - 1
    room = of([max(1, budget // b) for b in bound])
    return (out.withColumn("__n", place).withColumn("batch", F.floor(F.col("__n") / room).cast("long"))
            .withColumn("slot", (F.col("__n") % room).cast("int")).drop("__n"))
