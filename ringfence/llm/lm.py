"""Language-model scoring: causal self-attention over subword ids, trained in numpy.

Text is lower-cased (A-Z) and read as words, then an end.  A frequent word (of
those that training texts have twice, the ``HEAD`` most frequent, a fixed bound) is the ids that a public
byte-level tokenizer gives it; any other word is spelled in that vocabulary's
single-byte ids.  The model gives every word and end a probability given all before it
in its window:

    P(next | past) = sum over experts k of gate_k(past) * P_k(next)

The gate is a causal self-attention layer over the words so far, each the mean of its
subword ids' embeddings.  Experts are distributions estimated from the counts of all
training texts: one for each of ``EXPERTS`` kinds of passage (found by a mixture of
multinomials that is fitted on all of them) that gives frequent words their smoothed share and others their share
times a byte-trigram spelling model, and one that repeats the word before.  Each sums
to at most one over all words, so the score is the log probability of a text.

Training: counts are grouped aggregations over all training texts.  The attention
layer and the embeddings are trained by every task on all of its training texts, from
common first weights, and averaged by tokens.  What a task sends is a fixed number of
weights, so the gathered bytes grow with the number of tasks, that is with the input.

Scoring: windows of ``WINDOW`` positions start every ``STRIDE``; each position is scored
in one window only, the first that gives it ``WINDOW - STRIDE`` positions of context
(the beginning of a text has what there is).  Windows are scored in batches with a causal mask.

The unigram baseline's counts are exact: frequent words are looked up in the table,
all others are joined with the counts of the whole training vocabulary.

Cases: null text is empty and consists of an end; texts of any length are scored
whole; equal texts have equal scores; repeated rows are scored each; without training
texts every count is zero and the score that of a uniform model over bytes; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_path
from .graph import stable
from .text import ByteWords, body, encode

HEAD, EXPERTS, DIM, WINDOW, STRIDE = 1 << 17, 8, 16, 64, 48
#: Bounds of the sample that only finds the kinds of passages to start from.
START_DOCS, START_PASSAGES, PASSAGE, CELLS = 2000, 20_000, 64, 1 << 14
#: Steps over all passages: at most so many, until a word gains less than so much; fractions of counts that are summed.
STEPS, GAIN, FINE = 12, 1e-3, 1 << 16
SYMBOLS = 48  # the most frequent bytes of a spelling, one for all others, one for the word's edge
SMOOTH, CHUNK, BATCH, RATE = 200.0, 1 << 20, 128, 0.01
#: Word types that a task holds before it sends them on, and rows that it sends at a time.
HELD, ROWS = 250_000, 20_000
LOG10 = np.log(10.0)
_NEVER = -60.0


def chunks(texts: list[bytes], most: int = CHUNK):
    """(first text, slice) of about ``most`` bytes."""
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) <= most):
            size += len(texts[to])
            to += 1
        yield at, texts[at:to]
        at = to


# --- kinds of passages -------------------------------------------------------------


def passages(w: ByteWords) -> np.ndarray:
    """First word of each run of ``PASSAGE`` words (the last of a text may be shorter)."""
    n = -(-w.count // PASSAGE)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(w.offset[:-1], n) + k * PASSAGE


def find_kinds(cells: np.ndarray, first: np.ndarray, kinds: int = EXPERTS, steps: int = 12, starts: int = 2) -> np.ndarray:
    """Mixture of multinomials over hashed words by expectation maximisation: log probability of (cell, kind)."""
    rng = np.random.default_rng(1)
    if not len(cells):
        return np.full((CELLS, kinds), -np.log(CELLS), np.float32)
    row = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(cells))))
    best, out = -np.inf, None
    for _ in range(starts):
        # each kind starts from a few passages
        resp = np.full((len(first), kinds), 0.5 / kinds)
        resp[np.arange(len(first)), rng.integers(0, kinds, len(first))] += 0.05
        seeds = rng.permutation(len(first))[:8 * kinds]
        resp[seeds, np.arange(len(seeds)) % kinds] = 20
        for _ in range(steps):
            counts = np.stack([np.bincount(cells, resp[row, k], CELLS) for k in range(kinds)], axis=1)
            table = np.log((counts + 0.01) / (counts.sum(axis=0) + 0.01 * CELLS))
            share = np.log(resp.sum(axis=0) / resp.sum())
            logs = np.add.reduceat(table[cells], first, axis=0) + share
            top = logs.max(axis=1, keepdims=True)
            resp = np.exp(logs - top)
            total = resp.sum(axis=1, keepdims=True)
            resp /= total
        fit = float((top + np.log(total)).sum())
        if fit > best:
            best, out = fit, table
    return out.astype(np.float32)


# --- tables ------------------------------------------------------------------------


class Tables:
    """Everything that is counted: frequent words, their ids and expert probabilities, the spelling model."""

    def __init__(self, words: list[bytes], counts: np.ndarray, tail: np.ndarray, n: int, v: int, spelling: np.ndarray,
                 symbols: np.ndarray, tokenizer: str):
        """``words`` and ``counts`` (words, kinds): the frequent ones, the end (b"") among them; ``tail``: other words by kind;
        ``n`` and ``v``: tokens and types; ``spelling``: (symbol, symbol, symbol, kind) counts."""
        self.n, self.v, self.kinds = n, v, counts.shape[1]
        self.words = words
        self.count = counts.sum(axis=1)
        self.end = words.index(b"")
        h = ByteWords([w for w in words], lower=False)
        hashes = np.zeros(len(words), np.uint64)
        hashes[h.doc] = h.hash()
        hashes[self.end] = 0
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        total = counts.sum() + tail.sum()
        p = counts.sum(axis=1) / max(total, 1)
        own = counts.sum(axis=0) + tail + SMOOTH
        with np.errstate(divide="ignore"):
            self.log_p = np.log(np.maximum((counts + SMOOTH * p[:, None]) / own, 1e-26)).astype(np.float32)
        self.escape = np.log((tail + SMOOTH * max(tail.sum(), 1) / max(total, 1)) / own) if total else np.zeros(self.kinds)
        self.symbols = symbols
        self.other = -np.log(max(1, 256 - int((symbols < SYMBOLS - 2).sum())))
        both = spelling.sum(axis=3, keepdims=True)
        pair = both.sum(axis=0, keepdims=True)
        single = pair.sum(axis=1, keepdims=True) + 1
        single = single / single.sum(axis=2, keepdims=True)
        pair = (pair + 4 * single) / (pair.sum(axis=2, keepdims=True) + 4)
        both = (both + 4 * pair) / (both.sum(axis=2, keepdims=True) + 4)
        self.spelling = np.log((spelling + 4 * both) / (spelling.sum(axis=2, keepdims=True) + 4)).astype(np.float32).reshape(-1, self.kinds)
        self.base = np.log10(self.count + 1.0)
        self._ids(tokenizer)

    def _ids(self, path: str):
        """Public subword ids of the frequent words, the ids of single bytes."""
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True
        texts = [" " + w.decode("utf-8", "replace") for w in self.words]
        ids = [x.ids for x in tok.encode_batch_fast(texts, add_special_tokens=False)]
        self.vocabulary = tok.get_vocab_size()
        ids[self.end] = [self.vocabulary - 1]
        self.ids = np.array([i for x in ids for i in x], np.int32)
        self.ids_at = np.append(0, np.cumsum([len(x) for x in ids]))
        vocab, spare = tok.get_vocab(), 256
        # byte-level vocabularies show printable bytes as themselves and the others, in order, from U+0100 on
        self.byte_id = np.zeros(256, np.int32)
        for b in range(256):
            shown = chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b else chr(spare)
            spare += shown != chr(b)
            self.byte_id[b] = vocab.get(shown, b)

    def look_up(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash among the frequent words, or -1."""
        at = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
        return np.where(self.sorted[at] == h, self.order[at], -1)

    def spell(self, w: ByteWords, which: np.ndarray) -> np.ndarray:
        """Log probability of the words ``which`` under each kind."""
        if not len(which):
            return np.zeros((0, self.kinds), np.float32)
        size = w.end[which] - w.start[which]
        flat, first = _ranges(w.start[which], size)
        s = self.symbols[w.data[flat]]
        edge = SYMBOLS - 1
        # one step more for the edge that ends each word
        at = np.arange(len(s)) + np.repeat(np.arange(len(which)), size)
        full = np.full(len(s) + len(which), edge, np.int64)
        full[at] = s
        start = first + np.arange(len(which))
        one, two = np.roll(full, 1), np.roll(full, 2)
        one[start] = edge
        two[start] = edge
        long = start[size >= 1] + 1
        two[long] = edge
        logs = self.spelling[(two * SYMBOLS + one) * SYMBOLS + full]
        logs = np.add.reduceat(logs, start, axis=0)
        rest = np.add.reduceat((full == SYMBOLS - 2).astype(np.float32), start) * self.other
        return (logs + rest[:, None] + self.escape).astype(np.float32)


def _ranges(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(all of start[i] .. start[i] + size[i] - 1, where each begins)."""
    first = np.cumsum(size) - size
    return np.repeat(start - first, size) + np.arange(int(size.sum())), first


class Chunk:
    """Some texts as codes: a place among the frequent words, or beyond them a word of ``tail``."""

    def __init__(self, tables: Tables, texts: list[bytes]):
        w = self.words = ByteWords(texts)
        h = w.hash()
        place = tables.look_up(h)
        self.tail = np.flatnonzero(place < 0)
        place[self.tail] = len(tables.words) + np.arange(len(self.tail))
        self.size = w.count + 1  # with the end
        self.first = np.append(0, np.cumsum(self.size))
        self.code = np.full(int(self.first[-1]), tables.end, np.int64)
        value = np.zeros(len(self.code), np.uint64)
        at = np.arange(len(place)) + w.doc
        self.code[at], value[at] = place, h
        before = np.empty_like(self.code)
        before[1:], before[self.first[:-1]] = self.code[:-1], tables.end
        self.before = before  # what stands before each position: the end, where a text begins
        last = np.zeros_like(value)
        last[1:] = value[:-1]
        last[self.first[:-1]] = 0
        self.same = (value == last) & (value > 0)  # this word is the one before
        again = np.zeros(len(value), np.float32)
        again[1:] = self.same[:-1]
        again[self.first[:-1]] = 0
        self.again = again  # the word before repeats its own predecessor
        spelled = tables.spell(w, self.tail)
        self.logs = np.concatenate([tables.log_p, spelled]) if len(spelled) else tables.log_p  # of each code under each kind

    def windows(self, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(positions, which exist, which are scored), each (windows, WINDOW)."""
        n = 1 + np.maximum(0, -(-(self.size - WINDOW) // stride))
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        local = k[:, None] * stride + np.arange(WINDOW)
        there = local < np.repeat(self.size, n)[:, None]
        scored = there & ((k[:, None] == 0) | (np.arange(WINDOW) >= WINDOW - stride))
        at = np.minimum(local + np.repeat(self.first[:-1], n)[:, None], len(self.code) - 1)
        return at, there, scored


# --- the attention layer -------------------------------------------------------------


def first_weights(tables: Tables, seed: int = 3) -> dict[str, np.ndarray]:
    """Embeddings from counts (how much likelier an id is in each kind), attention that averages them."""
    rng, kinds = np.random.default_rng(seed), tables.kinds
    size = np.diff(tables.ids_at)
    shown = np.repeat(tables.count, size)[:, None] * np.exp(np.clip(np.repeat(tables.log_p, size, axis=0) - np.repeat(np.log(np.maximum(tables.count, 1e-9) / max(tables.n, 1)), size)[:, None], -6, 6))
    mass = np.stack([np.bincount(tables.ids, shown[:, k], tables.vocabulary) for k in range(kinds)], axis=1) + 1.0
    mass /= mass.sum(axis=0)
    e = np.log(mass) - np.log(mass.mean(axis=1, keepdims=True))
    eye = np.eye(kinds)
    out = {"e": np.clip(e, -3, 3), "q": rng.normal(0, 0.1, (kinds, DIM)), "k": rng.normal(0, 0.1, (kinds, DIM)),
           "v": eye.copy(), "bias": -np.arange(WINDOW) / WINDOW, "att": np.zeros((kinds, kinds + 1)), "own": np.zeros((kinds + 2, kinds + 1))}
    out["att"][:, :kinds], out["own"][:kinds, :kinds] = 4 * eye, 0.5 * eye
    out["own"][-1, kinds] = -4  # the repeating expert is rare at first
    return {k: v.astype(np.float32) for k, v in out.items()}


_BACK = np.arange(WINDOW)[:, None] - np.arange(WINDOW)[None, :]
_FUTURE = np.where(_BACK < 0, np.float32(-1e9), np.float32(0))


def forward(w: dict, x: np.ndarray, again: np.ndarray):
    """Gate logits of each position and what the backward pass needs.  x: (windows, WINDOW, kinds)."""
    q, k, v = x @ w["q"], x @ w["k"], x @ w["v"]
    s = q @ k.transpose(0, 2, 1)
    s *= np.float32(DIM ** -0.5)
    s += (w["bias"][np.maximum(_BACK, 0)] + _FUTURE)
    s -= s.max(axis=2, keepdims=True)
    np.exp(s, out=s)
    s /= s.sum(axis=2, keepdims=True)
    att = s @ v
    own = np.concatenate([x, again[..., None], np.ones_like(again)[..., None]], axis=2)
    return att @ w["att"] + own @ w["own"], (q, k, v, s, att, own)


def mix(logits: np.ndarray, logs: np.ndarray):
    """(log probability, responsibilities, gates) from gate logits and expert log probabilities."""
    gate = logits - logits.max(axis=-1, keepdims=True)
    np.exp(gate, out=gate)
    gate /= gate.sum(axis=-1, keepdims=True)
    top = logs.max(axis=-1, keepdims=True)
    part = gate * np.exp(logs - top)
    total = part.sum(axis=-1, keepdims=True)
    total = np.maximum(total, np.float32(1e-30))
    return (np.log(total) + top)[..., 0], part / total, gate


def backward(w: dict, x: np.ndarray, kept, d: np.ndarray):
    """Gradients of all weights and of x, given that of the logits."""
    q, k, v, s, att, own = kept
    flat = lambda a: a.reshape(-1, a.shape[-1])
    g = {"att": flat(att).T @ flat(d), "own": flat(own).T @ flat(d)}
    datt, dx = d @ w["att"].T, (d @ w["own"].T)[..., :x.shape[-1]]
    ds = datt @ v.transpose(0, 2, 1)
    dv = s.transpose(0, 2, 1) @ datt
    ds -= (ds * s).sum(axis=2, keepdims=True)
    ds *= s
    by = ds.sum(axis=0)
    g["bias"] = np.bincount(np.maximum(_BACK, 0).ravel(), np.where(_BACK >= 0, by, 0).ravel(), WINDOW).astype(np.float32)
    ds *= np.float32(DIM ** -0.5)
    dq, dk = ds @ k, ds.transpose(0, 2, 1) @ q
    for name, part in (("q", dq), ("k", dk), ("v", dv)):
        g[name] = flat(x).T @ flat(part)
        dx = dx + part @ w[name].T
    return g, dx


def expert_logs(tables: Tables, chunk: Chunk, at: np.ndarray) -> np.ndarray:
    """Log probability of each position's word under each expert, the repeating one last."""
    out = np.empty((*at.shape, tables.kinds + 1), np.float32)
    out[..., :-1] = chunk.logs[chunk.code[at]]
    out[..., -1] = np.where(chunk.same[at], np.float32(0), np.float32(_NEVER))
    return out


class Trainer:
    """Adam for the layer, plain steps for the embeddings of the ids that occur."""

    def __init__(self, tables: Tables, weights: dict):
        self.t, self.w = tables, {k: v.copy() for k, v in weights.items()}
        self.m = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in weights.items() if k != "e"}
        self.step, self.tokens = 0, 0

    def id_ranges(self, chunk: Chunk):
        """Subword ids of the codes of a chunk: (ids, start, size) where codes index start and size."""
        w, tail = chunk.words, chunk.tail
        size = w.end[tail] - w.start[tail]
        flat, first = _ranges(w.start[tail], size)
        ids = np.concatenate([self.t.ids, self.t.byte_id[w.data[flat]]])
        return ids, np.concatenate([self.t.ids_at[:-1], len(self.t.ids) + first]), np.concatenate([np.diff(self.t.ids_at), size])

    def learn(self, texts: list[bytes]):
        chunk = Chunk(self.t, texts)
        ids, start, size = self.id_ranges(chunk)
        at, there, scored = chunk.windows(WINDOW)  # end to end: each position is learned once
        order = np.random.default_rng(len(at)).permutation(len(at))
        for a in range(0, len(order), BATCH):
            rows = order[a:a + BATCH]
            pos, mask = at[rows], scored[rows]
            code = chunk.before[pos]
            kinds, back = np.unique(code, return_inverse=True)
            flat, first = _ranges(start[kinds], size[kinds])
            use, many = ids[flat], size[kinds]
            x = (np.add.reduceat(self.w["e"][use], first, axis=0) / many[:, None]).astype(np.float32)
            seen = x[back.reshape(pos.shape)]
            logits, kept = forward(self.w, seen, chunk.again[pos])
            _, resp, gate = mix(logits, expert_logs(self.t, chunk, pos))
            n = max(1, int(mask.sum()))
            d = ((gate - resp) * mask[..., None] / n).astype(np.float32)
            g, dx = backward(self.w, seen, kept, d)
            flat_dx = dx.reshape(-1, dx.shape[-1])
            by = np.stack([np.bincount(back.ravel(), flat_dx[:, j], len(kinds)) for j in range(flat_dx.shape[1])], axis=1)
            np.add.at(self.w["e"], use, (-RATE * 20 * np.repeat(by / many[:, None], many, axis=0)).astype(np.float32))
            self.step += 1
            self.tokens += n
            for name, grad in g.items():
                m, s = self.m[name]
                m += 0.1 * (grad - m)
                s += 0.01 * (grad * grad - s)
                self.w[name] -= RATE * (m / (1 - 0.9 ** self.step)) / (np.sqrt(s / (1 - 0.99 ** self.step)) + 1e-7)


class Scorer:
    def __init__(self, tables: Tables, weights: dict):
        self.t, self.w = tables, weights
        self.x = (np.add.reduceat(weights["e"][tables.ids], tables.ids_at[:-1], axis=0) / np.diff(tables.ids_at)[:, None]).astype(np.float32)

    def score(self, texts: list[bytes]):
        """(log10 probability of each text, the chunk)."""
        chunk = Chunk(self.t, texts)
        w, tail = chunk.words, chunk.tail
        x = self.x
        if len(tail):
            size = w.end[tail] - w.start[tail]
            flat, first = _ranges(w.start[tail], size)
            own = np.add.reduceat(self.w["e"][self.t.byte_id[w.data[flat]]], first, axis=0) / size[:, None]
            x = np.concatenate([x, own.astype(np.float32)])
        at, _, scored = chunk.windows()
        doc = np.repeat(np.arange(len(texts)), 1 + np.maximum(0, -(-(chunk.size - WINDOW) // STRIDE)))
        out = np.zeros(len(texts))
        for a in range(0, len(at), BATCH):
            pos, mask = at[a:a + BATCH], scored[a:a + BATCH]
            logits, _ = forward(self.w, x[chunk.before[pos]], chunk.again[pos])
            logs, _, _ = mix(logits, expert_logs(self.t, chunk, pos))
            np.add.at(out, doc[a:a + BATCH], np.where(mask, logs, 0).sum(axis=1, dtype=np.float64))
        return out / LOG10, chunk


# --- Spark -----------------------------------------------------------------------------


class LanguageModel:
    """Tables and weights (broadcast, of fixed bound) and the counts of all training words (a table)."""

    def __init__(self, tables, weights, vocabulary):
        self.tables, self.weights, self.vocabulary = tables, weights, vocabulary


def _kinds_of(w: ByteWords, table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Kind of each word: that of its passage."""
    first = passages(w)
    if not len(first):
        return np.empty(0, np.int64)
    cells = (h & np.uint64(CELLS - 1)).astype(np.int64)
    kind = np.add.reduceat(table[cells], first, axis=0).argmax(axis=1)
    return np.repeat(kind, np.diff(np.append(first, len(h))))


def _start(rows: DataFrame) -> np.ndarray:
    """Kinds of passages from a bounded sample of texts, for ``_refine`` to start from."""
    def cut(batches):
        for batch in batches:
            for _, piece in chunks(encode(batch.column(0))):
                w = ByteWords(piece)
                cells = (w.hash() & np.uint64(CELLS - 1)).astype(np.uint16)
                first = passages(w)
                yield pa.RecordBatch.from_pydict({"cells": pa.array([c.tobytes() for c in np.split(cells, first[1:])] if len(first) else [], pa.binary())})

    chosen = rows.select(F.xxhash64("text").alias("h")).distinct().orderBy("h").limit(START_DOCS)
    some = rows.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen), "h").dropDuplicates(["h"]).select("text").mapInArrow(cut, "cells binary")
    found = sorted(r["cells"] for r in some.orderBy(F.xxhash64("cells"), "cells").limit(START_PASSAGES).collect())
    cells = np.frombuffer(b"".join(found), np.uint16).astype(np.int64)
    first = np.cumsum([0] + [len(c) // 2 for c in found])[:-1]
    return find_kinds(cells, first)


def _refine(rows: DataFrame, table: np.ndarray, most: int = STEPS) -> np.ndarray:
    """The mixture fitted on all passages of all texts, from the kinds ``table``; each step is one aggregation of expected counts."""
    kinds = table.shape[1]
    cells_end, end = CELLS * kinds, (CELLS + 1) * kinds
    share, before = np.full(kinds, -np.log(kinds)), -np.inf

    def expect(shared):
        def run(batches):
            table, share = shared.value
            total = np.zeros(end + 1)
            for batch in batches:
                for _, piece in chunks(encode(batch.column(0))):
                    w = ByteWords(piece)
                    first = passages(w)
                    if not len(first):
                        continue
                    cells = (w.hash() & np.uint64(CELLS - 1)).astype(np.int64)
                    logs = np.add.reduceat(table[cells], first, axis=0) + share
                    top = logs.max(axis=1, keepdims=True)
                    resp = np.exp(logs - top)
                    sums = resp.sum(axis=1, keepdims=True)
                    resp /= sums
                    row = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(cells))))
                    for k in range(kinds):
                        total[k:cells_end:kinds] += np.bincount(cells, resp[row, k], CELLS)
                    total[cells_end:end] += resp.sum(axis=0)
                    total[end] += (top + np.log(sums)).sum()
            at = np.flatnonzero(total)
            # whole numbers: their sum doesn't depend on the order of the tasks
            yield pa.RecordBatch.from_pydict({"at": pa.array(at), "x": pa.array(np.round(total[at] * FINE).astype(np.int64))})
        return run

    for _ in range(most):
        shared = rows.sparkSession.sparkContext.broadcast((table, share))
        got = rows.select("text").mapInArrow(expect(shared), "at long, x long").groupBy("at").agg(F.sum("x").alias("x")).toArrow()  # a row for each cell and kind
        total = np.zeros(end + 1)
        total[np.asarray(got["at"], dtype=np.int64)] = np.asarray(got["x"], dtype=np.float64) / FINE
        counts, passed = total[:cells_end].reshape(CELLS, kinds), total[cells_end:end]
        if not counts.any():
            break
        table = np.log((counts + 0.01) / (counts.sum(axis=0) + 0.01 * CELLS)).astype(np.float32)
        share = np.log(np.maximum(passed, 1 / FINE) / passed.sum())
        fit = total[end] / counts.sum()
        if fit - before < GAIN:
            break
        before = fit
    return table


def _counting(table, n: int):
    """Arrow batches (text) -> (word, c0 ... c7), in batches of up to ``ROWS`` rows; a word may come several times."""
    def merge(held):
        word, many = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
        text = [t for x in held for t in x[2]]
        held.clear()
        key, first, back = np.unique(word, return_index=True, return_inverse=True)
        total = np.stack([np.bincount(back, many[:, k], len(key)) for k in range(n)], axis=1).astype(np.int64)
        return key, total, [text[i] for i in first]

    def pack(_, total, text):
        for a in range(0, len(text), ROWS):
            part = total[a:a + ROWS]
            yield pa.RecordBatch.from_pydict({"word": pa.array(text[a:a + ROWS], pa.binary())} | {f"c{k}": pa.array(part[:, k]) for k in range(n)})

    def run(batches):
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for _, piece in chunks(encode(batch.column(0))):
                w = ByteWords(piece)
                h = w.hash()
                kind = _kinds_of(w, table.value, h)
                key, first, back = np.unique(h, return_index=True, return_inverse=True)
                total = np.bincount(back * n + kind, minlength=len(key) * n).reshape(-1, n)
                # the end counts where its text's last word does
                last = w.offset[1:] - 1
                ends = np.bincount(np.where(w.count > 0, kind[np.maximum(last, 0)] if len(kind) else 0, 0), minlength=n)
                held.append((np.append(key, np.uint64(0)), np.vstack([total, ends]), [w.word(i) for i in first.tolist()] + [b""]))
                size += len(key)
                if size > HELD:
                    held = [merge(held)]
                    size = len(held[0][0])
                    if size > HELD // 2:
                        yield from pack(*held.pop())
                        size = 0
        if held:
            yield from pack(*merge(held))
    return run


def _count(rows: DataFrame, kinds: np.ndarray) -> DataFrame:
    """(word, c0 ... c7): how often each word, and the end (empty), occurs in each kind of passage."""
    table = rows.sparkSession.sparkContext.broadcast(kinds)
    n = kinds.shape[1]
    schema = "word binary, " + ", ".join(f"c{k} long" for k in range(n))
    return rows.select("text").mapInArrow(_counting(table, n), schema).groupBy("word").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(n)])


def _spellings(words: DataFrame, kinds: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the bytes and (symbol, symbol, symbol, kind) counts over all words that aren't frequent, by their tokens."""
    def of_bytes(batches):
        total = np.zeros(256, np.int64)
        for batch in batches:
            data = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8)
            total += np.bincount(data, minlength=256)
        yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(256)), "n": pa.array(total)})

    seen = np.zeros(256, np.int64)
    for r in words.select("word").mapInArrow(of_bytes, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        seen[r["at"]] = r["n"]
    symbols = np.full(256, SYMBOLS - 2, np.int64)
    symbols[np.argsort(-seen, kind="stable")[:SYMBOLS - 2]] = np.arange(SYMBOLS - 2)
    edge = SYMBOLS - 1

    def of_symbols(batches):
        total = np.zeros((SYMBOLS ** 3, kinds), np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            if not texts:
                continue
            size = np.array([len(t) for t in texts]) + 3
            s = np.full(int(size.sum()), edge, np.int64)
            at, _ = _ranges(np.cumsum(size) - size + 2, size - 3)
            s[at] = symbols[np.frombuffer(b"".join(texts), np.uint8)]
            row = np.repeat(np.arange(len(texts)), size)
            code = (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]
            inner = row[:-2] == row[2:]
            for k in range(kinds):
                weight = np.asarray(batch.column(1 + k))[row[:-2][inner]]
                total[:, k] += np.bincount(code[inner], weight, SYMBOLS ** 3).astype(np.int64)
        for k in range(kinds):
            at = np.flatnonzero(total[:, k])
            yield pa.RecordBatch.from_pydict({"at": pa.array(at * kinds + k), "n": pa.array(total[at, k])})

    out = np.zeros(SYMBOLS ** 3 * kinds)
    counted = words.select("word", *[f"c{k}" for k in range(kinds)]).mapInArrow(of_symbols, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    got = counted.toArrow()  # at most SYMBOLS^3 * kinds rows
    out[np.asarray(got["at"])] = np.asarray(got["n"])
    return symbols, out.reshape(SYMBOLS, SYMBOLS, SYMBOLS, kinds)


def _average(rows: DataFrame, tables, weights: dict) -> dict:
    """Every task trains on all of its rows; the weights are averaged by tokens."""
    shared = rows.sparkSession.sparkContext.broadcast((tables, weights))
    names = sorted(weights)

    def train(batches):
        trainer = Trainer(*shared.value)
        for batch in batches:
            for _, piece in chunks(encode(batch.column(0))):
                trainer.learn(piece)
        if trainer.tokens:
            for name in names:
                flat = (trainer.w[name] - shared.value[1][name]).ravel().astype(np.float64) * trainer.tokens
                for part in range(0, len(flat), 1 << 15):
                    at = np.flatnonzero(flat[part:part + (1 << 15)])
                    yield pa.RecordBatch.from_pydict({"name": pa.array([name] * len(at), pa.string()), "at": pa.array(at + part), "x": pa.array(flat[part + at])})
            yield pa.RecordBatch.from_pydict({"name": ["tokens"], "at": [0], "x": [float(trainer.tokens)]})

    summed = rows.select("text").mapInArrow(train, "name string, at long, x double").groupBy("name", "at").agg(F.sum("x").alias("x"))
    got = summed.toArrow()  # as many numbers as the model has weights
    name, at, x = np.asarray(got["name"]), np.asarray(got["at"]), np.asarray(got["x"])
    total = x[name == "tokens"].sum()
    out = {k: v.copy() for k, v in weights.items()}
    for k in names if total else ():
        mine = name == k
        flat = out[k].ravel()
        flat[at[mine]] += (x[mine] / total).astype(np.float32)
    return out


def learn(docs: DataFrame, tokenizer: str, text: str = "text", head: int = HEAD) -> LanguageModel:
    """Fits the model on all rows of ``docs``; ``tokenizer`` is the path of a public byte-level tokenizers file."""
    spark = docs.sparkSession
    rows = docs.select(body(F.col(f"`{text}`")).alias("text"))
    kinds = _refine(rows, _start(rows))
    n = kinds.shape[1]
    folder = shared_path(spark, "lm", unique=True)
    _count(rows, kinds).write.parquet(f"{folder}/words")
    words = spark.read.parquet(f"{folder}/words")
    each = [F.col(f"c{k}") for k in range(n)]
    c = sum(each[1:], each[0])
    words = words.withColumn("c", c)
    whole = words.agg(F.sum("c"), F.count("*"), *[F.sum(x) for x in each]).first()
    # words seen once stand for those never seen: they count as rare, which gives unseen words their share
    twice = words.where("word <> X'' and c > 1")
    top = twice.orderBy(F.col("c").desc(), "word").limit(head - 1)
    top = top.unionByName(words.where("word = X''")).toArrow()  # at most ``head`` rows
    listed = [bytes(w) for w in top["word"].to_pylist()]
    counts = np.stack([np.asarray(top[f"c{k}"], dtype=np.int64) for k in range(n)], axis=1) if listed else np.zeros((0, n), np.int64)
    if b"" not in listed:
        listed, counts = [*listed, b""], np.vstack([counts, np.zeros((1, n), np.int64)])
    rare = F.col("c") < 2
    if len(listed) == head:  # the rest of the words, by the same order
        total = [(x, w) for x, w in zip(counts.sum(axis=1).tolist(), listed) if w]
        least = min(total)[0]
        last = max(w for x, w in total if x == least)
        rare = rare | (F.col("c") < least) | ((F.col("c") == least) & (F.col("word") > F.lit(last)))
    rare = words.where(F.col("word") != F.lit(b"")).where(rare)
    tail = np.array([x or 0 for x in whole[2:]], np.float64) - counts.sum(axis=0)
    symbols, spelling = _spellings(rare, n)
    tables = Tables(listed, counts.astype(np.float64), np.maximum(tail, 0), int(whole[0] or 0), int(whole[1]), spelling, symbols, tokenizer)
    return LanguageModel(tables, _average(rows, tables, first_weights(tables)), words.select("word", "c"))


def score(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, n_known, train_tokens, base_score, score."""
    shared = docs.sparkSession.sparkContext.broadcast((model.tables, model.weights))

    def run(batches):
        tables, weights = shared.value
        scorer, number = Scorer(tables, weights), TaskContext.get().partitionId() << 33
        for batch in batches:
            for at, piece in chunks(encode(batch.column(1))):
                got, chunk = scorer.score(piece)
                doc = np.repeat(np.arange(len(piece)), chunk.size)
                known = chunk.code < len(tables.words)
                c = np.where(known, tables.count[np.where(known, chunk.code, 0)], 0)
                logs = np.where(known, tables.base[np.where(known, chunk.code, 0)], 0)
                w = chunk.words
                owner = w.doc[chunk.tail]
                cut = np.searchsorted(owner, np.arange(len(piece) + 1)).astype(np.int32)
                rare = pa.ListArray.from_arrays(pa.array(cut), pa.array([w.word(i) for i in chunk.tail.tolist()], pa.binary()))
                yield pa.RecordBatch.from_pydict({
                    "row": pa.array(number + np.arange(len(piece))), "doc_id": batch.column(0).slice(at, len(piece)), "n_tokens": pa.array(chunk.size),
                    "known": pa.array(np.bincount(doc, c > 0, len(piece)).astype(np.int64)), "logs": pa.array(np.bincount(doc, logs, len(piece))),
                    "score": pa.array(got), "rare": rare})
                number += len(piece)

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), body(F.col(f"`{text}`")).alias("text"))
    folder = shared_path(docs.sparkSession, "lm", unique=True)
    rows.mapInArrow(run, "row long, doc_id long, n_tokens long, known long, logs double, score double, rare array<binary>").write.parquet(f"{folder}/scored")
    scored = docs.sparkSession.read.parquet(f"{folder}/scored")
    rare = (scored.select("row", F.explode("rare").alias("word")).join(model.vocabulary, "word")
            .groupBy("row").agg(F.sum(F.log10(F.col("c") + 1)).alias("more"), F.count("*").alias("found")))
    size = F.lit(float(np.log10(model.tables.n + model.tables.v + 1)))
    return scored.drop("rare").join(rare, "row", "left").select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("found", F.lit(0))).alias("n_known"), F.lit(model.tables.n).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * size).alias("base_score"), "score")
