import random

import numpy as np
from pyspark.sql import functions as F

from ringfence.llm import substring

SCHEMA = "doc_id long, text string, part int, slice string, kept string"
SPACE = " \t\n\x0b\x0c\r"


def split(text):
    out = text or ""
    for c in SPACE:
        out = out.replace(c, " ")
    return [w for w in out.split(" ") if w]


def brute(rows, window=20):
    last = 2**63 - 1
    where = {}
    for doc, text, *_ in rows:
        w = split(text)
        for i in range(len(w) - window + 1):
            where.setdefault(tuple(w[i:i + window]), []).append((last if doc is None else doc, i))
    first = {k: min(v) for k, v in where.items()}
    out = []
    for doc, text, *_ in rows:
        w = split(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < (last if doc is None else doc, i):
                gone.update(range(i, i + window))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def rows_of(rnd):
    vocab = [f"w{i}" for i in range(400)] + ["É\u00a0x", "W1", "日本", "\U0001f600"]
    passage = [rnd.choices(vocab, k=60) for _ in range(3)]
    rows = []
    for i in range(150):
        w = rnd.choices(vocab, k=rnd.choice([0, 3, 19, 20, 21, 50, 200]))
        for p in passage:
            if rnd.random() < 0.3:
                a, b = sorted(rnd.sample(range(61), 2))
                at = rnd.randrange(len(w) + 1)
                w[at:at] = p[a:b]
        rows.append((rnd.randrange(10**6), rnd.choice(SPACE).join(w)))
    rows += [(2 * 10**6 + i, rows[i][1]) for i in range(30)]  # copies
    rows += [(3, "a b " * 40), (4, "x " * 100), (5, None), (6, " \n"), (None, rows[3][1]), (None, rows[140][1]), (7, "long text of words " * 8000)]
    rows += [rows[20], rows[20], (rows[20][0], rows[21][1]), (rows[20][0], rows[20][1] + " tail")]  # repeated rows, a shared id
    return [(*r, 1, "s", "k") for r in rows]


def test_against_brute_force(spark, monkeypatch):
    rows = rows_of(random.Random(8))
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute(rows)
    assert sorted((tuple(r) for r in substring.dedup(df).collect()), key=repr) == want
    # a crowded sketch lets everything pass and changes nothing; several slices
    monkeypatch.setattr(substring, "SLICE", 1 << 12)
    monkeypatch.setattr(substring, "LEAST_PARTS", 1)
    assert sorted((tuple(r) for r in substring.dedup(df).collect()), key=repr) == want
    assert sorted((tuple(r) for r in substring.dedup(df, window=6, gram=3).collect()), key=repr) == brute(rows, 6)
    assert substring.dedup(df.limit(0)).count() == 0


def test_texts_are_shuffled_once(spark):
    df = spark.createDataFrame(rows_of(random.Random(9)), SCHEMA).repartition(4)
    out = substring.dedup(df)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") >= 2


def test_grams_and_anchors():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 4, 500).astype(np.uint64)
    for n in (1, 3, 8, 20):
        h = substring.grams(words, n)
        seen = {}
        for i in range(500 - n + 1):
            assert seen.setdefault(tuple(words[i:i + n].tolist()), h[i]) == h[i]
        assert len(set(seen.values())) == len(seen)
        assert substring.smallest(words, n).tolist() == [i + int(words[i:i + n].argmin()) for i in range(500 - n + 1)]
