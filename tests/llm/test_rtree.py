import numpy as np
from pyspark.sql import functions as F

from ringfence.llm import rtree

SCHEMA = "vec_id long, label int, embedding array<float>, shard long, v string, key string, dim int"


def brute(rows, positives=5, negatives=3, low=50, high=95):
    seen = {(i, y, tuple(int(np.floor(np.float64(256) * np.float64(np.float32(x)))) for x in v)) for i, y, v, *_ in rows
            if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for a in seen:
        if a[0] % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1]) for b in seen if b != a and len(b[2]) == len(a[2]))
        for s, i, _ in [x for x in scored if x[2] == a[1]][:positives]:
            near = [x for x in scored if x[2] != a[1] and low * -s <= 100 * -x[0] <= high * -s][:negatives]
            out += [(a[0], i, r + 1, x[1], -s, -x[0]) for r, x in enumerate(near)]
    return sorted(out)


def rows_of(rng, n, dim, scale=1.0):
    centre = rng.normal(size=(6, dim))
    rows = []
    for i in range(n):
        x = centre[rng.integers(6)] + rng.normal(size=dim) * 0.4
        rows.append((i, int(rng.integers(4)), [float(np.float32(scale * c)) for c in x / np.linalg.norm(x)]))
    return rows


def test_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = rows_of(rng, 700, 16)
    rows += [(2000 + i, i % 3, rows[7][2]) for i in range(150)]  # one vector many times, anchors among them
    rows += [(5000 + i, 1, [0.0] * 16) for i in range(60)]
    rows += [(7000 + i, i % 2, r[2][:3]) for i, r in enumerate(rows[:120])]  # another length
    rows += [(None, 1, rows[0][2]), (8000, None, rows[0][2]), (8050, 1, None), (8100, 1, [float("nan")] * 16), (8150, 1, [None] * 16),
             (8200, 1, [float("inf")] * 16), (8250, 1, []), (8251, 1, []), (8252, 2, [])]
    rows = [(*r, 9, "v", "k", 1) for r in rows + rows[:5]]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    want = brute(rows)
    vectors = rtree.usable(df, F.col("label"))
    for shard in (rtree.SHARD, 64):
        got = sorted(tuple(r) for r in rtree.mine(vectors, F.col("vec_id") % 50 == 0, shard=shard).collect())
        assert got == want, shard
    monkeypatch.setattr(rtree, "BOXES", 3)
    monkeypatch.setattr(rtree, "PIECE", 5)
    got = sorted(tuple(r) for r in rtree.mine(vectors, F.col("vec_id") % 50 == 0, shard=64).collect())
    assert got == want


def test_scores_above_53_bits_and_empty_tables(spark):
    rng = np.random.default_rng(5)
    rows = [(*r, 1, "", "", 1) for r in rows_of(rng, 160, 4, scale=3e5)]
    df = spark.createDataFrame(rows, SCHEMA)
    vectors = rtree.usable(df, F.col("label"))
    got = sorted(tuple(r) for r in rtree.mine(vectors, F.col("vec_id") % 50 == 0, shard=40).collect())
    assert got == brute(rows) and max(r[4] for r in got) > 2**52
    assert rtree.mine(rtree.usable(df.limit(0), F.col("label")), F.col("vec_id") % 50 == 0).count() == 0


def test_boxes_bound_the_scores_and_prune():
    rng = np.random.default_rng(6)
    v = np.floor(256 * np.array([r[2] for r in rows_of(rng, 3000, 6)]))
    ids, labels = np.arange(3000), rng.integers(0, 4, 3000)
    tree = rtree.Tree(ids, labels, ids, v, leaf=16, fanout=4)
    q = v[:20]
    low, high = tree.bounds(q)
    score = q @ tree.v.T
    for i in range(tree.leaves):
        part = score[:, i * 16:(i + 1) * 16]
        assert (part.min(axis=1) >= low[:, i]).all() and (part.max(axis=1) <= high[:, i]).all()
    opened = []
    for i in range(20):
        scores = rtree.Scores(tree, q[i:i + 1])
        best = tree.search(labels[i], ids[i], True, [(-np.inf, np.inf, 5)], low[i], high[i], scores.of(0))[0]
        assert [b[1] for b in best] == sorted((j for j in ids.tolist() if labels[j] == labels[i] and j != i), key=lambda j: (-(v[j] @ q[i]), j))[:5]
        opened.append(scores.done.mean())
    assert np.mean(opened) < 0.7
