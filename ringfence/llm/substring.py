"""Repeated passages removed, with a count-min prefilter that is merged by slices.

A window is ``WINDOW`` consecutive words of a document.  Every word goes that is covered
by a window whose words also start earlier (a smaller document, or further left in the
same).  Documents are dealt to parts of about ``PART`` bytes.

* *Sketch.*  A window is counted through its anchor, the ``GRAM`` words with the
  smallest hash inside it: equal windows have equal anchors at equal places, so an
  anchor that occurs once has no repeated window.  A part sets the cells of its anchors
  in ``DEPTH`` rows; the cells travel as one block for each slice of the sketch, and a
  slice's blocks are added up in one task.  The sums overestimate, none is too small.
  Back goes one bit for each cell a part has set: counted twice or more.  The sketch
  grows with the input (``LOAD`` cells a row and anchor); no task, driver or broadcast
  holds more than a slice of ``SLICE`` cells.
* *Exact grouping.*  A second pass takes the windows of the anchors whose cells are all
  repeated.  Each part sends the first place of each of its distinct windows (96 bits of
  hash) to the window's slice, which answers with one bit: it occurs earlier elsewhere.
* *Removal.*  The third pass marks the words and returns the text that is left.

A window that many documents share reaches a slice once from each part, whatever the
number of its documents.  The three passes read one shuffle of the texts.

Two different windows are taken for equal with a probability of about n*n/2^97 for n
windows, two words with n*n/2^65 for n distinct words.

Cases: null text has no words and leaves empty text; documents of under ``WINDOW``
words stay whole; a null id counts as larger than all others; rows that share an id are
one document as to order, so of equal rows none is earlier than the other and all are
treated alike; long texts are never cut, and held by one task each; an empty table gives
an empty table; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import ByteWords, _mix, body, encode

WINDOW, GRAM = 20, 8
DEPTH, LOAD, SLICE = 2, 4, 1 << 21
PART, LEAST_PARTS = 4 << 20, 64

_LAST = np.iinfo(np.int64).max
_FACTORS = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


def grams(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """A hash of each ``n`` consecutive values, in order of their starts (doubling: of 1, 2, 4, ...)."""
    size = len(words) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    join = lambda a, b: _mix(a * _FACTORS[seed] + b)
    now, length, out, covered = _mix(words ^ _FACTORS[seed]), 1, None, 0
    while True:
        if n & length:
            out = now[:size] if out is None else join(out, now[covered:covered + size])
            covered += length
        length *= 2
        if length > n:
            return out
        now = join(now[:-(length // 2)], now[length // 2:])


def smallest(values: np.ndarray, n: int) -> np.ndarray:
    """For each ``n`` consecutive values the place of the smallest, the leftmost of equal ones."""
    place, at, length = np.arange(len(values)), values, 1
    size = len(values) - n + 1
    while length < n:
        step = min(length, n - length)
        a, b = at[:len(at) - step], at[step:]
        left = a <= b
        at, place = np.where(left, a, b), np.where(left, place[:len(left)], place[step:])
        length += step
    return place[:size]


class Part:
    """The windows of one part's documents."""

    def __init__(self, docs: pa.Table, cells: int, window: int = WINDOW, gram: int = GRAM):
        self.window = window
        self.ids = docs["doc_id"].fill_null(_LAST).to_numpy()
        self.nulls = docs["doc_id"]
        self.texts = encode(docs["text"])
        found = ByteWords(self.texts, lower=False)
        self.words, self.count = found.hash(), found.count
        self.first = found.offset[:-1]
        n = len(self.words)
        self.start = np.flatnonzero(found.doc[:max(n - window + 1, 0)] == found.doc[window - 1:]) if n >= window else np.empty(0, np.int64)
        self.doc = found.doc[self.start]
        hashed = grams(self.words, gram)
        place = smallest(hashed, window - gram + 1)[self.start] if len(self.start) else np.empty(0, np.int64)
        new = np.append(True, place[1:] != place[:-1]) if len(place) else np.empty(0, bool)
        self.anchor = np.cumsum(new) - 1  # of each window
        value = hashed[place[new]] if len(place) else np.empty(0, np.uint64)
        self.cells = np.stack([_mix(value + np.uint64((r + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(cells) + np.uint64(r * cells) for r in range(DEPTH)])
        self.set, times = np.unique(self.cells, return_counts=True)
        self.twice = times > 1

    def blocks(self):
        """(slice, cells): the place in the slice, shifted, with one bit for a cell that was set twice here."""
        at = (self.set // np.uint64(SLICE)).astype(np.int64)
        packed = ((self.set % np.uint64(SLICE)) << np.uint64(1) | self.twice).astype("<u4")
        return [(int(at[a]), packed[a:b].tobytes()) for a, b in _runs(at)]

    def candidates(self, answer: np.ndarray) -> None:
        """Takes the windows whose cells are all repeated: ``h1``, ``h2``, ``at`` (into ``start``) and the distinct ones' ``head``."""
        repeated = answer[np.searchsorted(self.set, self.cells)].all(axis=0) if len(self.set) else np.empty(0, bool)
        at = np.flatnonzero(repeated[self.anchor]) if len(self.anchor) else np.empty(0, np.int64)
        h1 = grams(self.words, self.window)[self.start[at]]
        h2 = (grams(self.words, self.window, 1)[self.start[at]] >> np.uint64(32)).astype("<u4")
        doc, left = self.ids[self.doc[at]], (self.start[at] - self.first[self.doc[at]]).astype("<i4")
        order = np.lexsort((left, doc, h2, h1))
        self.at, self.h1, self.h2, self.id, self.left = at[order], h1[order], h2[order], doc[order], left[order]
        same = (self.h1[1:] == self.h1[:-1]) & (self.h2[1:] == self.h2[:-1])
        self.head = np.flatnonzero(np.append(True, ~same)) if len(at) else np.empty(0, np.int64)
        self.kind = np.cumsum(np.append(True, ~same)) - 1 if len(at) else np.empty(0, np.int64)

    def firsts(self, bits: int):
        """(slice, h1, h2, doc, start) of the first place of each distinct candidate; slices are ranges of ``h1``."""
        at = (self.h1[self.head] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(self.head), np.int64)
        return [(int(at[a]), *(x[self.head[a:b]].tobytes() for x in (self.h1, self.h2, self.id, self.left))) for a, b in _runs(at)]

    def covered(self, answer: np.ndarray) -> np.ndarray:
        """The words to remove, given the answer of ``firsts``."""
        head = self.head[self.kind]
        own = (self.id > self.id[head]) | (self.id == self.id[head]) & (self.left > self.left[head])
        gone = self.start[self.at[own | answer[self.kind]]]
        mark = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(mark, gone, 1)
        np.add.at(mark, gone + self.window, -1)
        return np.cumsum(mark)[:-1] > 0

    def kept(self, gone: np.ndarray) -> list[tuple[int, str]]:
        """(number of words removed, the others joined by one blank) of each document."""
        out = []
        for text, first, n in zip(self.texts, self.first.tolist(), self.count.tolist()):
            words, lost = text.split(), gone[first:first + n]
            if lost.any():
                words = itertools.compress(words, ~lost)
            out.append((int(lost.sum()), b" ".join(words)))
        return out


def _runs(at: np.ndarray) -> list[tuple[int, int]]:
    if not len(at):
        return []
    edge = np.flatnonzero(at[1:] != at[:-1]) + 1
    return list(zip(np.append(0, edge).tolist(), np.append(edge, len(at)).tolist()))


def _bits(rows: pa.Table, kind: int, n: int) -> np.ndarray:
    """The answers of one kind, in the order of their slices, as one row of bits."""
    got = sorted((s, size, bits) for k, s, size, bits in zip(*(rows[c].to_pylist() for c in ("kind", "slice", "size", "bits"))) if k == kind)
    out = [np.unpackbits(np.frombuffer(bits, np.uint8), count=size).astype(bool) for _, size, bits in got]
    found = np.concatenate(out) if out else np.empty(0, bool)
    if len(found) != n:
        raise ValueError(f"{len(found)} answers for {n} questions")
    return found


_REPLY = "part int, kind int, slice int, size int, bits binary"


def _reply(parts: list[int], kind: int, slice_: int, sizes: list[int], answers: np.ndarray) -> pa.Table:
    ends = np.cumsum(sizes).tolist()
    return pa.table([pa.array(parts, pa.int32()), pa.array([kind] * len(parts), pa.int32()), pa.array([slice_] * len(parts), pa.int32()),
                     pa.array(sizes, pa.int32()), pa.array([np.packbits(answers[b - n:b]).tobytes() for n, b in zip(sizes, ends)], pa.binary())],
                    ["part", "kind", "slice", "size", "bits"])


def _merged(rows: pa.Table) -> pa.Table:
    """The blocks of one slice of the sketch added up; which of each block's cells are counted twice or more."""
    blocks = [np.frombuffer(b, "<u4") for b in rows["cells"].to_pylist()]
    total = np.zeros(SLICE, np.uint32)
    for b in blocks:  # a block has each of its cells once
        total[b >> 1] += 1 + (b & 1)
    return _reply(rows["part"].to_pylist(), 1, rows["slice"][0].as_py(), [len(b) for b in blocks], total[np.concatenate(blocks) >> 1] > 1)


def _earlier(rows: pa.Table) -> pa.Table:
    """Exact groups of one slice's windows; which of each part's firsts are not the first of all."""
    sizes = [len(b) // 8 for b in rows["h1"].to_pylist()]
    h1, h2, doc, left = (np.frombuffer(b"".join(rows[c].to_pylist()), t) for c, t in (("h1", "<u8"), ("h2", "<u4"), ("doc", "<i8"), ("left", "<i4")))
    order = np.lexsort((left, doc, h2, h1))
    new = np.append(True, (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1]))
    head = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    later = np.zeros(len(order), bool)
    later[order] = (doc[order] > doc[head]) | (doc[order] == doc[head]) & (left[order] > left[head])
    return _reply(rows["part"].to_pylist(), 2, rows["slice"][0].as_py(), sizes, later)


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.table([pa.array([r[i] for r in rows], types[t]) for i, (_, t) in enumerate(fields)], [n for n, _ in fields])


_CELLS = "part int, slice int, cells binary"
_FIRSTS = "part int, slice int, h1 binary, h2 binary, doc binary, left binary"
_KEPT = "doc_id long, n_words long, n_removed long, kept string"


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed`` and ``kept``, the words left, joined by one blank."""
    own = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), body(F.col(f"`{text}`")).alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(LEAST_PARTS, size // PART)
    anchors = size / 6 * 2 / (window - gram + 2)  # six bytes a word; of each run of places the smallest hash
    cells = max(1 << 16, int(LOAD * anchors))
    bits = math.ceil(math.log2(parts))
    dealt = own.withColumn("part", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int"))

    def part_of(docs):
        return docs["part"][0].as_py(), Part(docs, cells, window, gram)

    def sketch(docs: pa.Table) -> pa.Table:
        n, part = part_of(docs)
        return _table(_CELLS, [(n, *b) for b in part.blocks()])

    def firsts(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(docs):
            return _table(_FIRSTS, [])
        n, part = part_of(docs)
        part.candidates(_bits(answers, 1, len(part.set)))
        return _table(_FIRSTS, [(n, *b) for b in part.firsts(bits)])

    def remove(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(docs):
            return _table(_KEPT, [])
        _, part = part_of(docs)
        part.candidates(_bits(answers, 1, len(part.set)))
        kept = part.kept(part.covered(_bits(answers, 2, len(part.head))))
        return pa.table([part.nulls, pa.array(part.count, pa.int64()), pa.array([n for n, _ in kept], pa.int64()),
                         pa.array([k for _, k in kept], pa.binary()).cast(pa.string())], [x.split()[0] for x in _KEPT.split(", ")])

    by_part = dealt.groupBy("part")
    repeated = by_part.applyInArrow(sketch, _CELLS).groupBy("slice").applyInArrow(_merged, _REPLY)
    first = by_part.cogroup(repeated.groupBy("part")).applyInArrow(firsts, _FIRSTS)
    later = first.groupBy("slice").applyInArrow(_earlier, _REPLY)
    return by_part.cogroup(repeated.unionByName(later).groupBy("part")).applyInArrow(remove, _KEPT)
