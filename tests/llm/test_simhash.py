import random

import numpy as np
import xxhash

from ringfence.llm import simhash


def brute_print(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    s = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(nodes, linked):
    root = list(range(len(nodes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(nodes)):
        for j in range(i):
            if linked(nodes[i], nodes[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(nodes))]


def test_fingerprints_and_components(spark):
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(300)] + ["Ñandú", "é\u00a0x"]
    base = [" ".join(rnd.choices(vocab, k=rnd.choice([1, 2, 5, 200, 400]))) for _ in range(40)]
    texts = list(base)
    for t in base[:20]:
        w = t.split(" ")
        for _ in range(3):
            w[rnd.randrange(len(w))] = rnd.choice(vocab)
            texts.append("\n".join(w))
    texts += [None, "", " \t", base[3], base[3].upper(), "x " * 20000]
    ids = list(range(len(texts)))
    rnd.shuffle(ids)
    rows = list(zip(ids, texts, ["root"] * len(texts)))
    df = spark.createDataFrame(rows, "doc_id long, text string, root string")
    got = {r["doc_id"]: r for r in simhash.near_duplicates(df).collect()}
    order = sorted(rows)
    prints = [brute_print(t) for _, t, _ in order]
    roots = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    for i, (doc, _, _) in enumerate(order):
        assert got[doc]["fp"] & (2**64 - 1) == prints[i]
        assert got[doc]["component_id"] == order[roots[i]][0]
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({order[r][0] for r in roots})
    twice = df.unionByName(df).unionByName(spark.createDataFrame([(None, "alone in the world", "x"), (None, None, None), (5, "of another text", "x")], df.schema))
    left = simhash.keep_one(twice).collect()
    assert len(left) == len(set(roots)) + 2
    assert simhash.near_duplicates(df.limit(0)).count() == 0 and simhash.keep_one(df.limit(0)).count() == 0


def test_blocks_find_every_link(spark):
    rng = np.random.default_rng(1)
    values = set()
    for c in rng.integers(-(2**62), 2**62, 6).tolist():
        v = c
        for _ in range(60):
            for b in rng.integers(0, 63, rng.integers(0, 4)).tolist():
                v ^= 1 << b
            values.add(v)
    values = sorted(values)
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    want = brute_components(values, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 3)
    from ringfence.llm.graph import components
    for block in (1000, 7):
        found = {r["node"]: r["root"] for r in components(simhash.links(df, block=block)).collect()}
        assert [found.get(v, v) for v in values] == [values[i] for i in want]
