"""Benchmark decontamination by CGK embedding and bit-sampling LSH over item-sized windows.

A document is contaminated by an item where a run of its words is within
``allowed(n)`` word edits of the item's n words (a fifth of them).

1. Window filter, without loss: an edit spoils at most two of the item's word
   pairs, so a matching run has at least n - 1 - 2e of them, the first at most 3e words
   from its start.  For each item size, only starts with as many pairs of items of
   that size go on.
2. CGK: a random walk reads the window; at each step it writes the word under it
   and a random bit of (step, word) says whether it moves on.  Few edits lead to
   few differing steps, so edit distance becomes Hamming distance.
3. Bit sampling: each of L repetitions (own walk, own sample) keeps K steps; equal
   samples, looked up among the items of the same size, are candidates.  K (at most
   ``MOST_STEPS``) and L (at most ``MOST_REPEATS``) are set from measured collisions of
   items edited ``allowed(n)`` times, the most edits there can be, so that their recall
   reaches ``RECALL``.
4. Exact edit distance of the item to the best run of the candidate's words.

Items go to the tasks in blocks of at most ``BLOCK_BYTES`` of text, one after the
other, so what is broadcast is bounded for any benchmark.  Documents are not shuffled.

Cases: case of A-Z and kinds of white space don't matter; null or empty texts match
nothing; an item of under ``MIN_WORDS`` words is too common a phrase and counts only
where it is the whole text; an item without words is ignored; null item ids are
kept as null; equal items each match; texts of any length are searched whole;
repeated rows are searched each; empty tables give empty tables or leave all
documents; other columns are passed through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import ByteWords, _mix, body, encode

MIN_WORDS, MOST_STEPS, RECALL, MOST_REPEATS, BLOCK_BYTES = 8, 4, 0.995, 96, 4 << 20
#: The walk moves on at every other step, so after 1.5 n steps it is inside n words nearly always.
REACH = 1.5


def allowed(n: int) -> int:
    return n // 5


def edit_infix(item: list[bytes], text: list[bytes]) -> tuple[int, int]:
    """Smallest edit distance of ``item`` to a run of ``text``, and the first word of such a run."""
    row = [(0, j) for j in range(len(text) + 1)]
    for i, a in enumerate(item, 1):
        new = [(i, 0)]
        for j, b in enumerate(text, 1):
            x, y, z = row[j - 1], row[j], new[j - 1]
            new.append(min((x[0] + (a != b), x[1]), (y[0] + 1, y[1]), (z[0] + 1, z[1])))
        row = new
    return min(row)


def _pairs(h: np.ndarray) -> np.ndarray:
    """A value for each word and its successor (the last one's is arbitrary)."""
    return _mix(h * np.uint64(0x9E3779B97F4A7C15) + np.roll(h, -1))


class Block:
    """Items of bounded size, prepared for the search."""

    def __init__(self, ids: list, texts: list[bytes], seed: int = 8):
        words = ByteWords(texts)
        self.hash = words.hash()
        self.ids = ids
        self.words = [[words.word(j) for j in range(words.offset[i], words.offset[i + 1])] for i in range(len(texts))]
        size = words.count
        self.short = {}
        for i in np.flatnonzero((size > 0) & (size < MIN_WORDS)):
            self.short.setdefault(b" ".join(self.words[i]), []).append(int(i))
        self.sizes = [int(n) for n in np.unique(size[size >= MIN_WORDS])]
        self.at = {n: np.flatnonzero(size == n) for n in self.sizes}
        inner = np.ones(len(self.hash), bool)
        inner[words.offset[1:][size > 0] - 1] = False
        use = inner & (size[words.doc] >= MIN_WORDS)
        self.pairs, at = np.unique(_pairs(self.hash)[use], return_inverse=True)
        # for each pair, a bit for each size of the items it is in (sizes share bits beyond 64)
        self.of = np.zeros(len(self.pairs), np.uint64)
        if len(self.pairs):
            np.bitwise_or.at(self.of, at, self._bit(np.searchsorted(self.sizes, size[words.doc[use]])))
        bits = max(16, int(np.ceil(np.log2(16 * max(1, len(self.pairs))))))
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[self.pairs >> self.shift] = True
        rng = np.random.default_rng(seed)
        self.seeds = rng.integers(1, 1 << 63, MOST_REPEATS, dtype=np.uint64)
        start, end = words.offset[:-1], words.offset[1:]
        for sample in range(MOST_STEPS, 0, -1):
            self.place = rng.random((MOST_REPEATS, sample))
            self.repeats = self._calibrate(start, end, rng)
            if self.repeats:
                break
        else:
            self.repeats = MOST_REPEATS
        self.keys = {}
        for n in self.sizes:
            key = self.embed(self.hash, start[self.at[n]], end[self.at[n]], n, self.repeats)
            order = np.argsort(key, axis=0, kind="stable")
            self.keys[n] = np.take_along_axis(key, order, 0), order

    @staticmethod
    def _bit(rank):
        return np.uint64(1) << (np.asarray(rank) % 64).astype(np.uint64)

    def embed(self, h: np.ndarray, start: np.ndarray, end: np.ndarray, n: int, repeats: int) -> np.ndarray:
        """Sampled CGK embedding of the words [start, end) for each repetition, as one value: (windows, repeats)."""
        steps = np.floor(self.place[:repeats] * REACH * n).astype(np.int64)
        at = np.repeat(start[:, None], repeats, axis=1)
        stop, key = end[:, None], np.zeros(at.shape, np.uint64)
        padded = np.append(h, np.uint64(0))
        for t in range(int(steps.max()) + 1):
            here = np.where(at < stop, padded[np.minimum(at, len(h))], np.uint64(0))
            taken = (steps == t).sum(axis=1)
            for _ in range(int(taken.max())):
                key = np.where(taken > 0, _mix(key + here + np.uint64(1)), key)
                taken = taken - 1
            at = at + (_mix(here ^ (self.seeds[:repeats] + np.uint64(t))) & np.uint64(1)).astype(np.int64)
        return key

    def _calibrate(self, start, end, rng) -> int:
        """Repetitions for the target recall, from items with as many random edits as are allowed; 0: not reached."""
        items = np.flatnonzero(end - start >= MIN_WORDS)
        if not len(items):
            return 1
        hit = []
        for i in rng.choice(items, min(48, len(items)), replace=False):
            own = self.hash[start[i]:end[i]]
            n = len(own)
            for _ in range(4):
                new = own.tolist()
                for _ in range(allowed(n)):
                    p = int(rng.integers(0, len(new)))
                    new[p:p + int(rng.integers(0, 2))] = [int(x) for x in rng.integers(1, 1 << 63, rng.integers(0, 2))]
                new += [int(x) for x in rng.integers(1, 1 << 63, n)]
                both = np.concatenate([own, np.array(new, np.uint64)])
                key = self.embed(both, np.array([0, n]), np.array([n, n + n + allowed(n)]), n, MOST_REPEATS)
                hit.append((key[0] == key[1]).mean())
        p = np.array(hit)
        for repeats in range(1, MOST_REPEATS):
            if (1 - (1 - p) ** repeats).mean() >= RECALL:
                return repeats
        return 0

    def search(self, texts: list[bytes]) -> list[list[dict]]:
        """For each text its matches: item, start (word), distance; the nearest run for each item."""
        found: list[dict] = [{} for _ in texts]
        w = ByteWords(texts)
        if self.short:
            for d in np.flatnonzero((w.count > 0) & (w.count < MIN_WORDS)):
                for i in self.short.get(b" ".join(w.word(j) for j in range(w.offset[d], w.offset[d + 1])), ()):
                    found[d][i] = (0, 0)
        if self.sizes and len(w.start):
            h = w.hash()
            p = _pairs(h)
            hit = self.table[p >> self.shift]
            hit[w.offset[1:][w.count > 0] - 1] = False
            maybe = np.flatnonzero(hit)
            at = np.minimum(np.searchsorted(self.pairs, p[maybe]), len(self.pairs) - 1)
            maybe, at = maybe[self.pairs[at] == p[maybe]], at[self.pairs[at] == p[maybe]]
            of = self.of[at]
            for rank, n in enumerate(self.sizes):
                e = allowed(n)
                need = max(n - 1 - 2 * e, 1)
                mine = maybe[(of & self._bit(rank)) > 0]
                if len(mine) < need:
                    continue
                first, last = mine[:len(mine) - need + 1], mine[need - 1:]
                before = np.concatenate([[-1], mine[:len(first) - 1]])
                low = np.maximum(np.maximum(last - (n + e) + 1, first - 3 * e), np.maximum(before + 1, w.offset[w.doc[first]]))
                rows = np.flatnonzero((low <= first) & (w.doc[first] == w.doc[last]))
                for x in range(0, len(rows), 1 << 10):
                    a, z = low[rows[x:x + (1 << 10)]], first[rows[x:x + (1 << 10)]]
                    size = z - a + 1
                    starts = np.repeat(a - np.cumsum(size) + size, size) + np.arange(size.sum())
                    for y in range(0, len(starts), 1 << 12):
                        self._look_up(w, h, starts[y:y + (1 << 12)], n, found)
        return [[{"item": i, "start": s, "distance": e} for i, (e, s) in sorted(f.items())] for f in found]

    def _look_up(self, w, h, starts, n, found):
        e, doc = allowed(n), w.doc[starts]
        end = np.minimum(starts + n + e, w.offset[doc + 1])
        key = self.embed(h, starts, end, n, self.repeats)
        keys, order = self.keys[n]
        near: dict[tuple[int, int], list[int]] = {}
        for r in range(self.repeats):
            low, high = np.searchsorted(keys[:, r], key[:, r]), np.searchsorted(keys[:, r], key[:, r], "right")
            for x in np.flatnonzero(high > low):
                for i in self.at[n][order[low[x]:high[x], r]]:
                    near.setdefault((int(doc[x]), int(i)), []).append(int(starts[x]))
        for (d, i), places in near.items():
            places = sorted(set(places))
            cut = [0, *[k for k in range(1, len(places)) if places[k] - places[k - 1] > n], len(places)]
            for a, b in zip(cut, cut[1:]):
                first, end = max(places[a] - e, int(w.offset[d])), min(places[b - 1] + n + e, int(w.offset[d + 1]))
                best, at = edit_infix(self.words[i], [w.word(j) for j in range(first, end)])
                if best <= e:
                    mine = (best, first + at - int(w.offset[d]))
                    found[d][i] = min(found[d].get(i, mine), mine)


def blocks(items: DataFrame, item_id: str, text: str, block_bytes: int):
    """The benchmark in blocks of bounded size; one block is on the driver at a time."""
    ids, texts, size = [], [], 0
    ordered = items.select(F.col(f"`{item_id}`").alias("i"), body(F.col(f"`{text}`")).alias("t")).orderBy("i", "t")
    for r in ordered.toLocalIterator():
        t = r["t"].encode()
        if texts and size + len(t) > block_bytes:
            yield Block(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(r["i"])
        texts.append(t)
        size += len(t)
    if texts:
        yield Block(ids, texts)


_MATCH = "array<struct<item:long,start:long,distance:int>>"


def with_matches(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                 name: str = "matches", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with an array column ``name`` of the items in its text: item (its id), start (word), distance (edits)."""
    out = docs.withColumn(name, F.array().cast(_MATCH))
    kind = pa.list_(pa.struct([("item", pa.int64()), ("start", pa.int64()), ("distance", pa.int32())]))
    for block in blocks(items, item_id, item_text, block_bytes):
        search = _searcher(docs.sparkSession.sparkContext.broadcast(block), kind)
        out = out.withColumn(name, F.concat(name, F.arrow_udf(search, _MATCH)(body(F.col(f"`{text}`")))))
    return out


def _searcher(shared, kind):
    def search(texts: pa.Array) -> pa.Array:
        block, rows = shared.value, encode(texts)
        out, at = [], 0
        while at < len(rows):  # some MB of text at a time
            to, size = at, 0
            while to < len(rows) and (to == at or size + len(rows[to]) <= 1 << 21):
                size += len(rows[to])
                to += 1
            out += [[m | {"item": block.ids[m["item"]]} for m in found] for found in block.search(rows[at:to])]
            at = to
        return pa.array(out, kind)
    return search


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """One row per document and item in it: doc_id, item_id, start, distance."""
    found = with_matches(docs, items, name="__matches", **options)
    return (found.select(F.col(f"`{doc_id}`").alias("doc_id"), F.explode("__matches").alias("m"))
            .select("doc_id", F.col("m.item").alias("item_id"), "m.start", "m.distance"))


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents without a match, as they came."""
    return with_matches(docs, items, name="__matches", **options).where(F.size("__matches") == 0).drop("__matches")
