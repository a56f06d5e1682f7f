"""Toxicity: Levenshtein automata intersected with a lexicon trie, and context windows around each hit.

The lexicon is learned: words and word beginnings (written with a star) that toxic
training documents have far more often than others.  It becomes a trie; the
Levenshtein automata of all its terms run over the trie at once and are made
deterministic, so a misspelled term is caught while a word is read letter by letter,
and most words leave the automaton after a few letters.  Each hit is scored by its
window: between quotation marks or beside a word of reporting it counts as
quotation, beside a word of address as abuse, else as plain use.  A logistic model
over the hit counts gives the score.

Fitting takes at most ``SAMPLE`` labelled rows (the smallest hashes of their ids) and
at most ``TERMS`` terms, so the model and what is broadcast have a fixed bound.
Scoring reads every text whole.

Cases: null text is empty; an empty text has the score of a text without hits; texts
of any length are scored whole; equal texts have equal scores; repeated labels weigh
as often as they occur; without labelled rows of both kinds the score is 0.5; an
empty table gives an empty table; other columns are passed through.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import body

SAMPLE, TERMS, LEAST, WINDOW = 20_000, 96, 5, 6

#: Fixed values.
QUOTES = "\"'«»„“”‘’"
REPORTING = frozenset("said says saying wrote writes called calls quote quoted quotes dit sagt sagte schrieb nannte dijo dice escribió".split())
ADDRESS = frozenset("you your you're yourself u du dich dir dein ihr euch tu toi vous vos te usted ustedes eres".split())

#: A mark between two letters is an apostrophe and quotes nothing.
_APOSTROPHE = re.compile(r"(?<=\w)['’](?=\w)")

_ALNUM = np.array([chr(i).isalnum() for i in range(1 << 16)])


class Lexicon:
    """Terms compiled to one deterministic table: state and letter class to state."""

    def __init__(self, terms: list[str], least: int = LEAST):
        self.terms = terms
        letters = sorted({c for t in terms for c in t.rstrip("*")})
        self.code = {c: i + 1 for i, c in enumerate(letters)}
        children, ends, edits = [{}], {}, {}
        for k, t in enumerate(terms):
            at, word = 0, t.rstrip("*")
            for c in word:
                if self.code[c] not in children[at]:
                    children[at][self.code[c]] = len(children)
                    children.append({})
                at = children[at][self.code[c]]
            ends.setdefault(at, []).append((k, t.endswith("*")))
            edits[k] = 1 if len(word) >= least else 0
        # the most edits any term below a node allows
        room = [0] * len(children)
        for at in range(len(children) - 1, -1, -1):
            room[at] = max([edits[k] for k, _ in ends.get(at, ())] + [room[x] for x in children[at].values()], default=0)

        def close(items):
            """Skipped term letters: each costs an edit."""
            out = dict(items)
            for at, e in list(items.items()):
                if e < room[at]:
                    for x in children[at].values():
                        if room[x] > e:
                            out[x] = min(out.get(x, 9), e + 1)
            return out

        def settle(items, done):
            """(items, best stem hit so far): a stem counts when its last letter is read."""
            for at, e in items.items():
                for k, stem in ends.get(at, ()):
                    if stem and e <= edits[k]:
                        done = min(done, (e, -len(terms[k]), k))
            keep = tuple(sorted((at, e) for at, e in items.items() if e < done[0]))
            return keep, done

        none = (9, 0, -1)
        first = settle(close({0: 0}), none)
        index, states, table = {first: 1}, [None, first], [[0] * (len(letters) + 1)]
        at = 1
        while at < len(states):
            items, done = states[at]
            row = []
            for c in range(len(letters) + 1):
                new: dict[int, int] = {}
                for node, e in items:
                    if c in children[node]:
                        x = children[node][c]
                        new[x] = min(new.get(x, 9), e)
                    if e < room[node]:
                        new[node] = min(new.get(node, 9), e + 1)  # a letter too many
                        for x in children[node].values():  # another letter
                            if room[x] > e:
                                new[x] = min(new.get(x, 9), e + 1)
                state = settle(close(new), done)
                if not state[0] and state[1] == none:
                    row.append(0)
                    continue
                if state not in index:
                    index[state] = len(states)
                    states.append(state)
                row.append(index[state])
            table.append(row)
            at += 1
        self.table = np.array(table, np.int32)
        self.open = np.array([False] + [bool(s[0]) for s in states[1:]])
        hit = []
        for s in states[1:]:
            best = s[1]
            for node, e in s[0]:
                for k, stem in ends.get(node, ()):
                    if not stem and e <= edits[k]:
                        best = min(best, (e, -len(terms[k]), k))
            hit.append((best[2], best[0] if best[2] >= 0 else 0))
        self.hit = np.array([(-1, 0), *hit], np.int32)
        self.classes = np.zeros(1 << 16, np.uint16)
        for c, i in self.code.items():
            self.classes[min(ord(c), 65535)] = i

    def match(self, chars: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """(term or -1, edits) of each word [start, end) of ``chars``."""
        code = self.classes[chars]
        state = np.ones(len(start), np.int32)
        live = np.arange(len(start))
        j = 0
        while len(live):
            live = live[start[live] + j < end[live]]
            state[live] = self.table[state[live], code[start[live] + j]]
            live = live[self.open[state[live]]]
            j += 1
        return self.hit[state]


def features(lexicon: Lexicon, texts: list[str]) -> np.ndarray:
    """One row per text: hits of each term, misspelled, quoted, addressed and plain hits, their share, length."""
    n_terms = len(lexicon.terms)
    out = np.zeros((len(texts), n_terms + 7))
    joined = "\n\n".join(t.lower() for t in texts) + "\n\n"
    chars = np.minimum(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), 65535).astype(np.uint16)
    size = np.array([len(t.lower()) + 2 for t in texts], np.int64)
    bound = np.append(0, np.cumsum(size))
    inside = _ALNUM[chars]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.append(0, edge)
    start, end = edge[0::2], edge[1::2]
    first = np.searchsorted(start, bound)
    n_words = np.diff(first)
    hit = lexicon.match(chars, start, end)
    at = np.flatnonzero(hit[:, 0] >= 0)
    doc = np.searchsorted(first, at, "right") - 1
    for i, d in zip(at.tolist(), doc.tolist()):
        a, b = max(i - WINDOW, int(first[d])), min(i + WINDOW + 1, int(first[d + 1]))
        before, after = (_APOSTROPHE.sub("", x) for x in (joined[start[a]:start[i]], joined[end[i]:end[b - 1] + 2]))
        near = {joined[start[k]:end[k]] for k in range(a, b) if k != i}
        quoted = (any(q in before for q in QUOTES) and any(q in after for q in QUOTES)) or bool(near & REPORTING)
        kind = 1 if quoted else 2 if near & ADDRESS else 3
        if hit[i, 1]:
            out[d, n_terms] += 1
        else:
            out[d, hit[i, 0]] += 1
        out[d, n_terms + kind] += 1
    out[:, n_terms + 4] = 100 * (out[:, n_terms + 2] + out[:, n_terms + 3]) / np.maximum(n_words, 1)
    out[:, n_terms + 5] = n_words
    out = np.log1p(out)
    out[:, n_terms + 6] = 1
    return out


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Logistic regression by damped Newton steps."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def choose_terms(rows: list[tuple[str, int, int]], n_toxic: int, n_clean: int, most: int = TERMS) -> list[str]:
    """Of (term, toxic documents, other documents) those that tell most; of terms that begin alike the longest or the far sharper."""
    scored = []
    for term, a, b in rows:
        odds = math.log((a + 0.5) / (n_toxic + 1)) - math.log((b + 0.5) / (n_clean + 1))
        if odds >= math.log(3):
            scored.append((a * odds, not term.endswith("*"), len(term), term, odds))
    out: dict[str, float] = {}
    for _, _, _, term, odds in sorted(scored, reverse=True):
        word = term.rstrip("*")
        alike = [o for t, o in out.items() if t.rstrip("*").startswith(word) or word.startswith(t.rstrip("*"))]
        if alike and odds < max(alike) + 0.7:
            continue
        out[term] = odds
        if len(out) == most:
            break
    return list(out)


class Model:
    def __init__(self, lexicon: Lexicon, weights: np.ndarray):
        self.lexicon, self.weights = lexicon, weights

    def score(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features(self.lexicon, texts) @ self.weights, -30, 30)))


def _pieces(texts: list[str]):
    """Slices of some MB of text."""
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) <= 1 << 20):
            size += len(texts[to])
            to += 1
        yield texts[at:to]
        at = to


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          sample: int = SAMPLE, terms: int = TERMS) -> Model | None:
    """Fits on at most ``sample`` rows of ``labels`` and their texts in ``docs``; None without rows of both kinds."""
    spark = docs.sparkSession
    chosen = (labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y")).where("y is not null and id is not null")
              .orderBy(F.xxhash64("id"), "id", "y").limit(sample))
    # at most ``sample`` pairs of numbers
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), body(F.col(f"`{text}`")).alias("t")).join(F.broadcast(chosen), "id").select("t", "y")
    word = F.split(F.lower("t"), "[^\\p{L}\\p{N}]+")
    terms_of = F.array_distinct(F.concat(F.filter(word, lambda w: F.length(w) >= 3), *[_begins(word, n) for n in (4, 5, 6, 7)]))
    counted = rows.agg(F.sum("y"), F.sum(1 - F.col("y"))).first()
    n_toxic, n_clean = int(counted[0] or 0), int(counted[1] or 0)
    if not n_toxic or not n_clean:
        return None
    least = max(4, n_toxic // 100)
    found = (rows.select(F.explode(terms_of).alias("term"), "y").groupBy("term").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
             .where((F.col("a") >= least) & (F.col("a") * (n_clean + 1) >= 2 * F.col("b") * (n_toxic + 1)))
             .orderBy(F.col("a").desc(), "b", "term").limit(20 * terms).collect())
    lexicon = Lexicon(choose_terms([tuple(r) for r in found], n_toxic, n_clean, terms))
    shared = spark.sparkContext.broadcast(lexicon)

    @F.arrow_udf("array<double>")
    def vector(texts: pa.Array) -> pa.Array:
        return pa.array([row.tolist() for piece in _pieces(texts.to_pylist()) for row in features(shared.value, piece)], pa.list_(pa.float64()))

    got = rows.select(vector("t").alias("x"), "y").collect()
    return Model(lexicon, fit(np.array([r["x"] for r in got]), np.array([r["y"] for r in got], float)))


def _begins(word, n: int):
    return F.transform(F.filter(word, lambda w: F.length(w) >= n), lambda w: F.concat(F.substring(w, 1, n), F.lit("*")))


def with_score(docs: DataFrame, model: Model | None, text: str = "text", name: str = "score") -> DataFrame:
    if model is None:
        return docs.withColumn(name, F.lit(0.5))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        parts = [shared.value.score(piece) for piece in _pieces(texts.to_pylist())]
        return pa.array(np.concatenate(parts) if parts else np.empty(0))

    return docs.withColumn(name, score(body(F.col(f"`{text}`"))))
