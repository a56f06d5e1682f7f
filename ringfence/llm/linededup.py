"""Fuzzy line deduplication by MinHash, over Arrow batches.

A line's words, lower-cased and joined by blanks, are its normal form.  Its set is
the shingles of ``CHARS`` characters that begin at each of its characters, blanks included.

1. Lines with the same normal form are one (``line``, a 64-bit value of it).
2. Signatures: the circle of shingle values is entered at some places; from each
   place on, the next values of the set, as one value, are a band.  Sets of similarity s
   agree in a band of n values with about s^n.  ``TIERS`` gives the bands of small, middle and
   large sets: at 0.8 a pair meets in one of them with 0.997 or more, at 0.9 with 0.9999.  The
   larger the sets, the longer the bands: so unlike lines seldom meet, however many there are.
   Two similar sets have the bands of a tier in common: sets of at least ``similarity``
   times its largest size have the next tier's, too.
3. Each line is compared with the smallest line of each of its buckets, by the exact
   Jaccard similarity of the sets.  Distributed union-find joins what is similar.
4. In each bucket that still has several components, the lines outside its largest one
   are compared with all its lines.  A bucket is dealt over pairs of blocks of about
   ``BLOCK`` lines and ``CELLS`` shingles; a pair of blocks gives links between components
   that it has not joined yet, never its pairs.  So any two similar lines that share a
   bucket are linked.
5. One occurrence of each component stays: the smallest (doc_id, line number).

Signatures are made once, where the texts are read; buckets are formed in ``PASSES`` passes.  Texts are shuffled by line twice, once
for step 3 and once for step 4; beyond that only texts of lines that counts (below) leave in a
pair move.  Each step's result is written before the next begins, and its shuffle files are
removed then.  Shingle values have 52
bits: two shingles of a line of n characters share one with probability n*n/2^53.

Of two sets, each shingle is counted in one of ``PARTS`` cells, up to 15 a cell.  The sum of
the differences of these counts is at most the number of shingles that one set has and the
other has not, so where it is too large the sets can't be similar.  Counts (32 bytes) rule
out most pairs, and no similar one, before texts are brought together.

Cases: null text is empty; lines without a word stay; lines
of under ``MIN_CHARS`` characters are compared by their normal form alone; rows that
share an id count as one document and rows without an id as one more, after all others; a line repeated in a document goes like any other; texts and lines
of any length are used whole; an empty table gives an empty table; other columns are
passed through.  ``clean`` leaves out documents that had words and lose all of them.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from . import ready
from .graph import components, stable, written
from .text import _FACTOR, WS, _mix, body

CHARS, SIMILARITY = 5, 0.8
#: Values of a band, places where the circle is entered, and the largest sets of each tier.
TIERS = ((3, 8, 50), (5, 16, 250), (7, 26, 1 << 62))
#: Passes in which buckets are formed, by their value: the shuffle files of one are gone before the next.
PASSES = 4
#: Shorter lines have at most three shingles: such a set reaches 0.8 with an equal one alone.
MIN_CHARS = CHARS + 3
#: Lines and shingles of one bucket that are dealt out in one piece.
BLOCK, CELLS = 1024, 1 << 20
#: Counts that tell most different sets apart; groups up to SMALL lines are compared in one go.
PARTS, SMALL = 64, 48
#: Lines and bytes that are hashed in one piece; a longer line is a piece of its own.
_LINES, _BYTES = 4000, 1 << 20
_BITS = 52
_MASK = np.uint64((1 << _BITS) - 1)


def normal_lines(text: str) -> list[bytes]:
    """The normal form of each line of a text."""
    return [b" ".join(x.split()) for x in text.lower().encode("utf-8", "replace").split(b"\n")]


def value(normal: bytes) -> int:
    """Signed 64-bit value of a normal form."""
    out = xxhash.xxh64_intdigest(normal)
    return out - (1 << 64) if out >> 63 else out


def _pieces(normals: list[bytes]):
    """(first, end) of runs of at most ``_LINES`` texts and about ``_BYTES`` bytes."""
    first = size = 0
    for i, x in enumerate(normals):
        if i > first and (i - first >= _LINES or size + len(x) > _BYTES):
            yield first, i
            first, size = i, 0
        size += len(x)
    if len(normals) > first:
        yield first, len(normals)


def sets(normals: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle values of up to ``_LINES`` texts, each with its text's place above bit 52, sorted; where each text's begin."""
    joined = b"\n".join(normals) + b"\n"
    code = np.frombuffer(joined, np.uint8) if joined.isascii() else np.frombuffer(joined.decode("utf-8").encode("utf-32-le"), np.uint32)
    end = np.flatnonzero(code == 10)
    start = np.append(0, end[:-1] + 1)
    many = np.maximum(end - start - CHARS + 1, 0)
    offset = np.append(0, np.cumsum(many))
    code = code.astype(np.uint64)
    n = max(len(code) - CHARS + 1, 0)
    rolled = code[:n].copy()
    for j in range(1, CHARS):
        rolled *= _FACTOR
        rolled += code[j:j + n]
    at = np.arange(offset[-1]) + np.repeat(start - offset[:-1], many)
    key = _mix(rolled[at]) >> np.uint64(64 - _BITS)
    key |= np.repeat(np.arange(len(normals), dtype=np.uint64) << np.uint64(_BITS), many)
    key.sort()
    if len(key):
        key = key[np.append(True, key[1:] != key[:-1])]
    return key, np.searchsorted(key, np.arange(len(normals) + 1, dtype=np.uint64) << np.uint64(_BITS))


def bands(key: np.ndarray, offset: np.ndarray, orders: int, rows: int = 3) -> np.ndarray:
    """A row per text, a value for each place where the circle is entered, of the ``rows`` next members; sets must not be empty."""
    return _bands(key, offset, orders, rows, np.arange(len(offset) - 1))


def _bands(key: np.ndarray, offset: np.ndarray, orders: int, rows: int, which: np.ndarray) -> np.ndarray:
    """``bands`` of some texts."""
    size, start = np.diff(offset)[which], offset[:-1][which]
    text = which.astype(np.uint64) << np.uint64(_BITS)
    step = (1 << _BITS) // orders
    out = np.empty((len(which), orders), np.uint64)
    for j in range(orders):
        at = np.searchsorted(key, text | np.uint64(step // 2 + j * step)) - start
        band = np.full(len(which), rows << 8 | j + 1, np.uint64)
        for k in range(rows):
            band = _mix(band * _FACTOR + (key[start + (at + k) % size] & _MASK))
        out[:, j] = band
    return out


def tier_bands(key: np.ndarray, offset: np.ndarray, similarity: float = SIMILARITY, tiers=TIERS) -> tuple[np.ndarray, np.ndarray]:
    """The bands of each text by the size of its set, one text's after the other's, and how many each has; sets must not be empty."""
    size = np.diff(offset)
    out = np.zeros((len(size), sum(x[1] for x in tiers)), np.uint64)
    has = np.zeros(out.shape, bool)
    first = least = 0
    for rows, orders, most in tiers:
        which = np.flatnonzero((size >= least) & (size <= most))
        out[which, first:first + orders] = _bands(key, offset, orders, rows, which)
        has[which, first:first + orders] = True
        first, least = first + orders, similarity * most
    return out[has], has.sum(axis=1)


def counts(key: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """A row per text: its shingles in each cell, up to 15."""
    cell = (key >> np.uint64(_BITS)) * np.uint64(PARTS) + (key & np.uint64(PARTS - 1))
    return np.minimum(np.bincount(cell.astype(np.int64), minlength=(len(offset) - 1) * PARTS), 15).astype(np.uint8).reshape(-1, PARTS)


def _packed(found: np.ndarray) -> np.ndarray:
    """Counts, two a byte."""
    return found[:, ::2] << 4 | found[:, 1::2]


def _sign(similarity: float, tiers, schema: StructType):
    """Arrow batches (doc_id, key, text) -> a row per line; ``size``, ``buckets`` and ``counts`` only at a batch's first of equal lines."""
    names = schema.names

    def run(batches):
        for batch in batches:
            row, number, normals = [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                found = normal_lines(text or "")
                normals += found
                row += [i] * len(found)
                number += range(len(found))
            line = [value(x) if x else None for x in normals]
            fresh, seen = [], set()
            for i, x in enumerate(normals):
                if len(x) >= MIN_CHARS and line[i] not in seen and len(x.decode()) >= MIN_CHARS:
                    seen.add(line[i])
                    fresh.append(i)
            size, many, buckets = np.zeros(len(normals), np.int32), np.zeros(len(normals), np.int32), [np.zeros(0, np.uint64)]
            cells = np.zeros((len(fresh), PARTS // 2), np.uint8)
            for a, b in _pieces([normals[i] for i in fresh]):
                key, offset = sets([normals[i] for i in fresh[a:b]])
                size[fresh[a:b]] = np.diff(offset)
                found, many[fresh[a:b]] = tier_bands(key, offset, similarity, tiers)
                buckets.append(found)
                cells[a:b] = _packed(counts(key, offset))
            has = np.append(0, np.cumsum(size > 0)).astype(np.int32)
            take = pa.array(row, pa.int32())
            short = [len(x) < 4 * MIN_CHARS and len(x.decode()) < MIN_CHARS for x in normals]
            columns = [batch.column(0).take(take), batch.column(1).take(take), pa.array(number, pa.int32()), pa.array(line, pa.int64()),
                       pa.array(short, pa.bool_()), pa.array(size), pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(many)).astype(np.int32)), pa.array(np.concatenate(buckets).view(np.int64))),
                       pa.Array.from_buffers(pa.binary(), len(normals), [None, pa.py_buffer(has * (PARTS // 2)), pa.py_buffer(cells)])]
            out = pa.RecordBatch.from_arrays(columns, names)
            for a in range(0, len(out), 50_000):
                yield out.slice(a, 50_000)
    return run


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    ready(docs.sparkSession)
    out = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), body(F.col(f"`{text}`")).alias("text"))
    return out.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")


def signed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, tiers=TIERS) -> DataFrame:
    """doc_id, key (of the row), line_no, line, short, size (of its set), buckets, counts (two a byte): every line; ``line`` is null for lines without a word."""
    rows = _rows(docs, doc_id, text)
    schema = (StructType().add(rows.schema["doc_id"]).add("key", "long").add("line_no", "integer").add("line", "long").add("short", "boolean")
              .add("size", "integer").add("buckets", ArrayType(LongType())).add("counts", "binary"))
    return rows.mapInArrow(_sign(similarity, tiers, schema), schema)


def _long_lines(batches):
    for batch in batches:
        kinds = list({x for text in batch.column(0).to_pylist() for x in normal_lines(text or "") if len(x) >= MIN_CHARS})
        for a in range(0, len(kinds), 50_000):
            part = kinds[a:a + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([value(x) for x in part], pa.int64()), pa.array(part, pa.binary())], ["line", "normal"])


def _unpacked(column) -> np.ndarray:
    """The counts of a column of packed ones, a row each."""
    found = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, PARTS // 2)
    return np.stack([found >> 4, found & 15], axis=2).reshape(-1, PARTS).astype(np.int8)


def _may(size: tuple, cells: tuple, a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """For the pairs (a[i], b[i]) of two tables, each with its sizes and counts: false where those rule the similarity out."""
    one, two = size[0][a].astype(np.int64), size[1][b].astype(np.int64)
    ok = np.minimum(one, two) >= similarity * np.maximum(one, two)
    at = np.flatnonzero(ok)
    for part in (at[i:i + 65536] for i in range(0, len(at), 65536)):
        apart = np.abs(cells[0][a[part]] - cells[1][b[part]]).sum(axis=1, dtype=np.int64)
        # similar sets of t members together differ in at most t * (1 - s) / (1 + s); the addend keeps rounding out of it
        ok[part] = apart <= (one[part] + two[part]) * (1 - similarity) / (1 + similarity) + 1e-6
    return ok


def _step(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``written``; the shuffle files of the write are removed when it ends, not when the driver next collects garbage."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        return written(df, name, codec)
    finally:
        conf.set(key, before)


def members(places: DataFrame, passes: int = PASSES) -> DataFrame:
    """bucket, line, size, lead: the lines of each bucket that has several, and its smallest line."""
    out = []
    for p in range(passes):
        rows = places.select("line", "size", F.explode("buckets").alias("bucket")).where(F.pmod("bucket", F.lit(passes)) == p)
        lead = rows.groupBy("bucket").agg(F.min("line").alias("lead"), F.max("line").alias("last")).where("lead < last").select("bucket", "lead")
        out.append(_step(rows.hint("merge").join(lead, "bucket").select("bucket", "line", "size", "lead").distinct(), "buckets"))
    return reduce(DataFrame.unionByName, out)


def cells_of(places: DataFrame) -> DataFrame:
    """line, counts: those of the set of each line that has one."""
    return places.where("size > 0").select("line", "counts").dropDuplicates(["line"])


def texts_of(docs: DataFrame, wanted: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """line, normal: the normal forms (bytes) of the lines in ``wanted``."""
    kinds = _rows(docs, doc_id, text).select("text").mapInArrow(_long_lines, "line long, normal binary")
    return kinds.hint("merge").join(wanted.select("line").distinct(), "line").dropDuplicates(["line"])


def _overlap(key: np.ndarray, offset: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The number of common members of the sets a[i] and b[i]."""
    out = np.zeros(len(a), np.int64)
    size = np.diff(offset)
    weight = np.cumsum(size[a] + size[b])
    first = 0
    while first < len(a):
        before = weight[first - 1] if first else 0
        last = max(first + 1, min(int(np.searchsorted(weight, before + _BYTES)), first + _LINES))
        both = []
        for side in (a[first:last], b[first:last]):
            many = size[side]
            at = np.arange(many.sum()) + np.repeat(offset[side] - np.append(0, np.cumsum(many)[:-1]), many)
            both.append((key[at] & _MASK) | np.repeat(np.arange(last - first, dtype=np.uint64) << np.uint64(_BITS), many))
        merged = np.concatenate(both)
        merged.sort()
        twice = merged[1:][merged[1:] == merged[:-1]] >> np.uint64(_BITS)
        out[first:last] = np.bincount(twice.astype(np.int64), minlength=last - first)
        first = last
    return out


def _alike(key, offset, a, b, similarity: float) -> np.ndarray:
    size = np.diff(offset)
    both = _overlap(key, offset, a, b)
    return both >= similarity * (size[a] + size[b] - both)


def _verify(similarity: float):
    """Arrow batches (a, b, normal_a, normal_b) -> the pairs (a, b) whose sets reach the similarity."""
    def run(batches):
        for batch in batches:
            one, two = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            keep = np.zeros(len(batch), bool)
            for x, y in _pieces([p + q for p, q in zip(one, two)]):
                for first in range(x, y, _LINES // 2):
                    last = min(first + _LINES // 2, y)
                    n = last - first
                    key, offset = sets(one[first:last] + two[first:last])
                    keep[first:last] = _alike(key, offset, np.arange(n), np.arange(n, 2 * n), similarity)
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return run


def _possible(similarity: float):
    """Arrow batches (a, b, size_a, size_b, counts_a, counts_b) -> the pairs (a, b) that sizes and counts don't rule out."""
    def run(batches):
        for batch in batches:
            at = np.arange(len(batch))
            size = (batch.column(2).to_numpy(), batch.column(3).to_numpy())
            cells = (_unpacked(batch.column(4)), _unpacked(batch.column(5)))
            yield batch.select(["a", "b"]).filter(pa.array(_may(size, cells, at, at, similarity)))
    return run


def _with(pairs: DataFrame, lines: DataFrame, column: str) -> DataFrame:
    """``pairs`` (a, b) with that column of both lines."""
    one, two = (lines.select(F.col("line").alias(x), F.col(column).alias(f"{column}_{x}")) for x in ("a", "b"))
    return pairs.hint("merge").join(two, "b").hint("merge").join(one, "a")


def _likely(pairs: DataFrame, cells: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b), with size_a and size_b, that sizes and counts don't rule out."""
    pairs = pairs.where(F.least("size_a", "size_b") >= similarity * F.greatest("size_a", "size_b"))
    return (_with(pairs, cells, "counts").select("a", "b", "size_a", "size_b", "counts_a", "counts_b")
            .mapInArrow(_possible(similarity), "a long, b long"))


def _similar(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity."""
    return _with(pairs, texts, "normal").select("a", "b", "normal_a", "normal_b").mapInArrow(_verify(similarity), "a long, b long")


def _pairs(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places with the same value of a sorted array."""
    many = np.searchsorted(group, group, "right") - np.arange(len(group)) - 1
    a = np.repeat(np.arange(len(group)), many)
    return a, np.arange(many.sum()) - np.repeat(np.append(0, np.cumsum(many)[:-1]), many) + a + 1


def _settled(k, size, most: int):
    """The groups of a sorted array: runs of whole groups of up to ``SMALL`` members and ``most`` in sum (True), or one larger group (False)."""
    _, first, many = np.unique(k, return_index=True, return_counts=True)
    weight = np.append(0, np.cumsum(size))
    held = []
    for a, b in zip(first.tolist(), (first + many).tolist()):
        if b - a > SMALL or weight[b] - weight[a] > most:
            yield np.arange(a, b), False
            continue
        if held and (sum(y - x for x, y in held) + b - a > _LINES or sum(weight[y] - weight[x] for x, y in held) + weight[b] - weight[a] > most):
            yield np.concatenate([np.arange(x, y) for x, y in held]), True
            held = []
        held.append((a, b))
    if held:
        yield np.concatenate([np.arange(x, y) for x, y in held]), True


def _by_key(settle):
    """Arrow batches sorted by k, line and outside -> what ``settle`` makes of tables of whole groups."""
    def ready_table(t: pa.Table):
        k, line = t["k"].to_numpy(), t["line"].to_numpy()
        # a line that is on both sides of its pair of blocks stands twice, the outside one first
        return settle(t.filter(pa.array(np.append(True, (k[1:] != k[:-1]) | (line[1:] != line[:-1])))))

    def run(batches):
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            k = held["k"].to_numpy()
            cut = int(np.searchsorted(k, k[-1], "left")) if len(k) else 0
            if cut:
                yield from ready_table(held.slice(0, cut)).to_batches()
                held = held.slice(cut)
        if held is not None and len(held):
            yield from ready_table(held).to_batches()
    return run


def _screen(similarity: float):
    """(k, line, root, outside, size, counts) -> (k, line, root, outside) of the lines that may be similar to one of another component."""
    def settle(t: pa.Table) -> pa.Table:
        k, root, outside, size = (t[x].to_numpy() for x in ("k", "root", "outside", "size"))
        cells = _unpacked(t["counts"])
        flag = np.zeros(len(t), bool)
        for at, several in _settled(k, np.zeros(len(k), np.int64), 0):
            if several:
                a, b = (at[x] for x in _pairs(k[at]))
                apart = (root[a] != root[b]) & (outside[a] | outside[b])
                todo = [(a[apart], b[apart])]
            else:
                todo = ((np.full(len(b), i), b) for i in at[outside[at]] for b in [at[root[at] != root[i]]])
            for a, b in todo:
                ok = _may((size, size), (cells, cells), a, b, similarity)
                flag[a[ok]] = flag[b[ok]] = True
        return t.select(["k", "line", "root", "outside"]).filter(pa.array(flag))
    return _by_key(settle)


def _compare(similarity: float):
    """(k, line, root, outside, normal) -> links (a, b) between components, at most one less than a group has of them but for small groups."""
    def small(k, root, outside, texts):
        a, b = _pairs(k)
        apart = (root[a] != root[b]) & (outside[a] | outside[b])
        a, b = a[apart], b[apart]
        key, offset = sets(texts)
        ok = _may((np.diff(offset),) * 2, (counts(key, offset).astype(np.int8),) * 2, a, b, similarity)
        a, b = a[ok], b[ok]
        ok = _alike(key, offset, a, b, similarity)
        return zip(root[a[ok]].tolist(), root[b[ok]].tolist())

    def large(root, outside, texts):
        """Each outside line against all, less what is joined by then."""
        if len(texts) > (1 << (64 - _BITS)) - 1:
            raise ValueError("more lines than a group may have: use smaller blocks")
        key, offset = sets(texts)
        size, cells = np.diff(offset), counts(key, offset).astype(np.int8)
        now = root.copy()
        for i in np.flatnonzero(outside).tolist():
            b = np.flatnonzero(now != now[i])
            b = b[_may((size, size), (cells, cells), np.full(len(b), i), b, similarity)]
            b = b[_alike(key, offset, np.full(len(b), i), b, similarity)]
            met = np.unique(now[b])
            yield from ((int(now[i]), x) for x in met.tolist())
            now[np.isin(now, met)] = now[i]

    def settle(t: pa.Table) -> pa.Table:
        k, root, outside = (t[x].to_numpy() for x in ("k", "root", "outside"))
        texts = t["normal"].to_pylist()
        out = set()
        for at, several in _settled(k, np.fromiter(map(len, texts), np.int64, len(texts)), _BYTES):
            mine = [texts[i] for i in at.tolist()]
            out.update(small(k[at], root[at], outside[at], mine) if several else large(root[at], outside[at], mine))
        found = np.array(sorted(out), np.int64).reshape(-1, 2)
        return pa.table([found[:, 0], found[:, 1]], ["a", "b"])
    return _by_key(settle)


def _blocks(inside: DataFrame, roots: DataFrame, cells: DataFrame, block: int) -> DataFrame:
    """(k, line, root, outside, size, counts): the lines of each pair of blocks k of the buckets that have several components.

    All lines of a bucket's main component are linked, so one of two lines to compare is
    outside of it: blocks of those meet blocks of all.
    """
    # the root is null where it is the line itself
    rows = inside.hint("merge").join(roots.select(F.col("node").alias("line"), F.expr("nullif(root, node)").alias("root")), "line", "left")
    rows = _step(rows.select("bucket", "line", "size", "root"), "members").withColumn("root", F.coalesce("root", "line"))
    groups = rows.groupBy("bucket", "root").agg(F.count("*").alias("n"), F.sum("size").alias("s"))
    crowds = groups.groupBy("bucket").agg(F.max(F.struct("n", "root", "s")).alias("top"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.count("*").alias("of"))
    # two lines have been compared
    deal = lambda n, s: F.ceil(F.greatest(n / F.lit(block), s / F.lit(CELLS))).cast("int")
    crowds = (crowds.where("n > 2 and of > 1")
              .select("bucket", F.col("top.root").alias("main"), deal(F.col("n") - F.col("top.n"), F.col("s") - F.col("top.s")).alias("gx"),
                      deal(F.col("n"), F.col("s")).alias("gy")))
    crowds = _step(crowds, "crowds")
    mine = lambda g: F.pmod(F.xxhash64("line"), g).cast("int")
    every = lambda g, k, flag: F.transform(F.sequence(F.lit(0), g - 1), lambda i: F.struct(k(i).alias("k"), F.lit(flag).alias("outside")))
    at = rows.hint("merge").join(crowds, "bucket").withColumn("x", mine(F.col("gx"))).withColumn("y", mine(F.col("gy")))
    outside = F.when(F.col("root") != F.col("main"), every(F.col("gy"), lambda y: F.xxhash64("bucket", "x", y), True))
    # where there is one block of all, it has the outside lines already
    rest = F.when((F.col("root") == F.col("main")) | (F.col("gy") > 1), every(F.col("gx"), lambda x: F.xxhash64("bucket", x, "y"), False))
    dealt = at.select("line", "root", "size", F.inline(F.flatten(F.array_compact(F.array(outside, rest)))))
    return dealt.hint("merge").join(cells, "line").select("k", "line", "root", "outside", "size", "counts")


def _near(blocks: DataFrame, similarity: float) -> DataFrame:
    """(k, line, root, outside) of the lines that counts leave in a pair of two components."""
    return blocks.repartition("k").sortWithinPartitions("k", "line", F.desc("outside")).mapInArrow(_screen(similarity), "k long, line long, root long, outside boolean")


def _across(near: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(a, b): links between components that have similar lines in one bucket."""
    dealt = near.hint("merge").join(texts, "line").select("k", "line", "root", "outside", "normal")
    return dealt.repartition("k").sortWithinPartitions("k", "line", F.desc("outside")).mapInArrow(_compare(similarity), "a long, b long")


def line_components(docs: DataFrame, places: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                    block: int = BLOCK) -> DataFrame:
    """line, root: the lines that are similar to another, and their component."""
    inside = members(places)
    cells = _step(cells_of(places), "counts")
    size = inside.select(F.col("line").alias("a"), F.col("size").alias("size_a")).distinct()
    pairs = inside.where("line <> lead").select(F.col("lead").alias("a"), F.col("line").alias("b"), F.col("size").alias("size_b")).distinct()
    pairs = _step(_likely(pairs.join(size, "a"), cells, similarity), "pairs")
    lines = lambda wanted: _step(texts_of(docs, wanted, doc_id, text), "lines", codec="zstd")
    texts = lines(pairs.select(F.explode(F.array("a", "b")).alias("line")))
    roots = stable(components(_step(_similar(pairs, texts, similarity), "links")))
    near = _step(_near(_blocks(inside, roots, cells, block), similarity), "near")
    more = _step(_across(near, lines(near), similarity), "links")
    return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)).withColumnRenamed("node", "line")


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("line_no"))


def decide(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, tiers=TIERS,
           block: int = BLOCK) -> DataFrame:
    """One row per line of ``docs``: doc_id, key, line_no, component (null: no word, or a short line that is alone) and kept."""
    places = _step(signed(docs, doc_id, text, similarity, tiers), "places")
    roots = stable(line_components(docs, places, doc_id, text, similarity, block))
    places = places.drop("size", "buckets", "counts")
    first = places.where("line is not null").groupBy("line").agg(F.min(_place()).alias("at"), F.first("short").alias("short"), F.count("*").alias("n"))
    first = first.where("not short or n > 1").join(roots, "line", "left")
    of_root = first.where("root is not null").groupBy("root").agg(F.min("at").alias("keeper"))
    named = (first.where("root is null").select("line", F.col("line").alias("component"), F.col("at").alias("keeper"))
             .unionByName(first.join(of_root, "root").select("line", F.col("root").alias("component"), "keeper")))
    return (places.join(named, "line", "left")
            .select("doc_id", "key", "line_no", "component",
                    (F.col("component").isNull() | (_place() == F.col("keeper"))).alias("kept")))


def clean(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, tiers=TIERS) -> DataFrame:
    """``docs`` with the texts that the kept lines make, in their columns and order."""
    gone = decide(docs, doc_id, text, similarity, tiers).where("not kept")
    gone = gone.groupBy("key").agg(F.collect_set("line_no").alias("__gone")).withColumnRenamed("key", "__key")
    t = body(F.col(f"`{text}`"))
    out = docs.withColumn("__key", F.xxhash64(F.col(f"`{doc_id}`"), t)).join(gone, "__key", "left")
    left = F.array_join(F.filter(F.split(t, "\n"), lambda x, i: ~F.array_contains("__gone", i)), "\n")
    out = out.withColumn("__left", F.when(F.col("__gone").isNull(), F.col(f"`{text}`")).otherwise(left))
    return (out.where(F.col("__gone").isNull() | (F.regexp_replace("__left", WS, "") != ""))
            .select(*[F.col("__left").alias(x) if x == text else F.col(f"`{x}`") for x in docs.columns]))
