import math
import random
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from ringfence.llm import lm, queries
from ringfence.llm.text import ByteWords

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


def tables(kinds=3, seed=0):
    rng = np.random.default_rng(seed)
    words = [b"", b"the", b"of", "é".encode(), b"thing", b"over,"]
    symbols = np.full(256, lm.SYMBOLS - 2, np.int64)
    for i, b in enumerate(b"abcdefghinortv,"):
        symbols[b] = i
    spelling = rng.integers(0, 4, (lm.SYMBOLS,) * 3 + (kinds,)).astype(float)
    return lm.Tables(words, rng.integers(1, 50, (len(words), kinds)).astype(float), rng.integers(5, 20, kinds).astype(float), 400, 20, spelling, symbols, PATH)


TEXTS = [b"the thing of the over, zebra of", b"", b"of " * 150 + b"unknown words here", "é Éx \xff".encode("latin-1"), b"the the the the"]


def test_words_and_windows():
    w = ByteWords(TEXTS)
    assert [[w.word(i) for i in range(w.offset[d], w.offset[d + 1])] for d in range(len(TEXTS))] == [t.lower().split() for t in TEXTS]
    h = dict(zip(w.hash().tolist(), [w.word(i) for i in range(len(w.start))]))
    assert len(h) == len(set(h.values()))
    chunk = lm.Chunk(tables(), TEXTS)
    at, there, scored = chunk.windows()
    assert sorted(at[scored].tolist()) == list(range(len(chunk.code)))
    assert (there | ~scored).all()
    first = (at - np.arange(lm.WINDOW))[:, 0]
    for row in range(len(at)):
        if (first[row] != chunk.first[:-1]).all():
            assert scored[row].argmax() >= lm.WINDOW - lm.STRIDE


def test_gradients():
    t = tables()
    weights = lm.first_weights(t)
    rng = np.random.default_rng(4)
    weights = {k: (v + rng.normal(0, 0.2, v.shape)).astype(np.float64) for k, v in weights.items()}
    x = rng.normal(0, 1, (2, lm.WINDOW, 3))
    again = (rng.random((2, lm.WINDOW)) < 0.3).astype(float)
    logs = rng.normal(-5, 2, (2, lm.WINDOW, 4))

    def loss(w, x):
        return -lm.mix(lm.forward(w, x, again)[0], logs)[0].sum()

    logits, kept = lm.forward(weights, x, again)
    _, resp, gate = lm.mix(logits, logs)
    g, dx = lm.backward(weights, x, kept, gate - resp)
    for name, grad in [*g.items(), ("x", dx)]:
        place = x if name == "x" else weights[name]
        for i in rng.integers(0, place.size, 6):
            old = place.flat[i]
            place.flat[i] = old + 1e-4
            up = loss(weights, x)
            place.flat[i] = old - 1e-4
            down = loss(weights, x)
            place.flat[i] = old
            assert abs((up - down) / 2e-4 - grad.flat[i]) < 2e-2 * max(1, abs(grad.flat[i])), name


def test_probabilities_and_causality():
    t = tables()
    s = lm.Scorer(t, lm.first_weights(t))
    # the words the tables know and every spelling together have at most the whole mass
    mass = np.exp(t.log_p.astype(float)).sum(axis=0) + np.exp(t.escape)
    assert (mass <= 1 + 1e-5).all()
    a, _ = s.score([b"the of"])
    b, _ = s.score([b"the of thing"])
    c, _ = s.score([b"of the thing"])
    assert b[0] < a[0] + 3 and b[0] != c[0]
    chunk = lm.Chunk(t, [b"the of thing over, the"])
    pos, _, _ = chunk.windows()
    x = s.x[chunk.before[pos]]
    one = lm.forward(s.w, x, chunk.again[pos])[0]
    x2 = x.copy()
    x2[:, 4:] += 1
    two = lm.forward(s.w, x2, chunk.again[pos])[0]
    assert np.allclose(one[:, :4], two[:, :4], atol=1e-5) and not np.allclose(one[:, 4:6], two[:, 4:6])


def test_training_lowers_the_loss():
    t = tables()
    text = [b"the of the of thing over, " * 40 + b"of"]
    trainer = lm.Trainer(t, lm.first_weights(t))
    before = lm.Scorer(t, trainer.w).score(text)[0][0]
    for _ in range(20):
        trainer.learn(text)
    assert lm.Scorer(t, trainer.w).score(text)[0][0] > before


def brute(rows):
    count = Counter()
    split = {}
    for doc, text in rows:
        tokens = [*(text or "").encode().lower().split(), b""]
        split[doc] = tokens
        if zlib.crc32(str(doc).encode()) % 7 != 2:
            count.update(tokens)
    n, v = sum(count.values()), len(count)
    return {d: (zlib.crc32(str(d).encode()) % 7 == 2, len(t), sum(count[x] > 0 for x in t), n,
                sum(math.log10((count[x] + 1) / (n + v + 1)) for x in t)) for d, t in split.items()}


def test_query_against_brute_force(spark):
    want = brute([(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])
    out = queries.op1_lm_scoring(spark, SF).collect()
    assert len(out) == len(want)
    for r in out:
        held, n, known, total, base = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert abs(r["base_score"] - base) < 1e-6 * abs(base) and r["score"] < 0


@pytest.mark.parametrize("head", [4, lm.HEAD])
def test_small_tables(spark, head):
    rows = [(i, "the thing of a thing " * (i % 4) + ("Rare%d" % i)) for i in range(12)] + [(50, None), (51, ""), (None, "the"), (52, "word " * 30000), (1, "the thing")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int")
    model = lm.learn(df, PATH, head=head)
    out = lm.score(df, model).collect()
    count = Counter(t for _, text in rows for t in [*(text or "").encode().lower().split(), b""])
    assert len(out) == len(rows) and model.tables.n == sum(count.values()) and model.tables.v == len(count)
    assert all(r["n_known"] == r["n_tokens"] and math.isfinite(r["score"]) for r in out)
    base = {r["doc_id"]: r["base_score"] for r in out}
    n = sum(count.values()) + len(count) + 1
    assert abs(base[51] - math.log10((count[b""] + 1) / n)) < 1e-9 and base[50] == base[51]
    nothing = lm.learn(df.limit(0), PATH, head=head)
    again = lm.score(df, nothing).collect()
    assert {r["train_tokens"] for r in again} == {0} and all(math.isfinite(r["score"]) and r["n_known"] == 0 for r in again)
    assert lm.score(df.limit(0), model).count() == 0


def test_kinds_are_fitted_on_all_passages(spark, monkeypatch):
    monkeypatch.setattr(lm, "START_DOCS", 3)
    rnd = random.Random(4)
    texts = [" ".join(rnd.choices([f"{'abcdefgh'[i % 8]}{k}" for k in range(30)], k=40)) for i in range(80)]
    rows = spark.createDataFrame([(x,) for x in [*texts, "", texts[0]]], "text string")
    w = ByteWords([x.encode() for x in [*texts, texts[0]]])
    cells, first = (w.hash() & np.uint64(lm.CELLS - 1)).astype(np.int64), lm.passages(w)
    row = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(cells))))
    start = lm._start(rows)
    table, share, fits = start, np.full(start.shape[1], -np.log(start.shape[1])), []
    for _ in range(4):
        logs = np.add.reduceat(table[cells], first, axis=0) + share
        fits.append(np.logaddexp.reduce(logs, axis=1).sum())
        resp = np.exp(logs - np.logaddexp.reduce(logs, axis=1)[:, None])
        counts = np.stack([np.bincount(cells, resp[row, k], lm.CELLS) for k in range(start.shape[1])], axis=1)
        table = np.log((counts + 0.01) / (counts.sum(axis=0) + 0.01 * lm.CELLS))
        share = np.log(resp.sum(axis=0) / resp.sum())
    monkeypatch.setattr(lm, "GAIN", -np.inf)
    assert np.allclose(lm._refine(rows, start, 4), table, atol=0.02)
    assert fits[-1] > fits[0] + 100


def test_counting_holds_few_words_at_a_time():
    """A task's memory and the batches it sends are bounded, however many different words it reads; counts stay exact."""
    texts = [" ".join(f"w{i * 4000 + j:07x}" for j in range(4000)) + " the the" for i in range(150)]
    table = np.full((lm.CELLS, 2), -1.0, np.float32)
    run = lm._counting(SimpleNamespace(value=table), 2)
    batches = [pa.RecordBatch.from_pydict({"text": texts[a:a + 50]}) for a in range(0, len(texts), 50)]
    got, most = Counter(), 0
    tracemalloc.start()
    for out in run(batches):
        most = max(most, len(out))
        for word, c0, c1 in zip(*(x.to_pylist() for x in out.columns)):
            got[word[:2]] += c0 + c1
        assert out.schema.names == ["word", "c0", "c1"]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == Counter({b"w0": 600_000, b"th": 300, b"": 150})
    assert most <= 20_000 and peak < 130e6, (most, peak)
