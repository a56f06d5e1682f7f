from itertools import combinations

import numpy as np
import pytest

from ringfence.llm import packing


def padding(length, count, bounds):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(length, count))


@pytest.mark.parametrize("seed", range(8))
def test_boundaries_are_optimal(seed):
    rng = np.random.default_rng(seed)
    length = np.sort(rng.choice(np.arange(1, 60), 9, replace=False))
    count = rng.integers(1, 20, 9)
    for k in (1, 2, 3, 4, 20):
        got = packing.boundaries(length, count, k)
        assert len(got) <= k and got[-1] == length[-1]
        best = min(padding(length, count, [*c, int(length[-1])]) for n in range(min(k, 9)) for c in combinations(length[:-1].tolist(), n))
        assert padding(length, count, got) == best


def test_batches(spark):
    rows = [(i, "w " * (i % 40), "x") for i in range(500)] + [(None, None, None), (7, "w " * 7, "x"), (9000, "w " * 9000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, bucket string")
    out = packing.assign(df, buckets=4, budget=100, shard_rows=50).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["length"]) for r in out) == sorted((-1 if d is None else d, len((t or "").split()) + 1) for d, t, _ in rows)
    batches = {}
    for r in out:
        assert r["length"] <= r["padded"]
        batches.setdefault((r["bucket"], r["shard"], r["batch"]), []).append(r)
    for rows in batches.values():
        assert len(rows) == 1 or len(rows) * rows[0]["padded"] <= 100
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    short = {}
    for key, rows in batches.items():
        short[key[:2]] = short.get(key[:2], 0) + (len(rows) < max(1, 100 // rows[0]["padded"]))
    assert max(short.values()) <= 1
    assert packing.assign(df.limit(0)).count() == 0


def test_long_lengths_share_cells(spark):
    df = spark.range(1, 200000).selectExpr("id doc_id", "id length")
    n = len(packing.histogram(df)[0])
    assert n <= packing.FINE + 256 * 9
