import random

from ringfence.llm import decontam


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def brute(docs, items):
    out = {}
    for doc, text, _ in docs:
        w = (text or "").lower().split()
        for item, said, _ in items:
            q = (said or "").lower().split()
            n, e = len(q), decontam.allowed(len(q))
            if not n or n < decontam.MIN_WORDS:
                if n and w == q:
                    out[doc, item] = 0
                continue
            best = min((edits(q, w[i:j]) for i in range(len(w)) for j in range(i + 1, min(len(w), i + n + e) + 1) if j - i >= n - e), default=n)
            if best <= e:
                out[doc, item] = best
    return out


def test_against_brute_force(spark):
    rnd = random.Random(9)
    vocab = [f"{a}{b}" for a in "thonerinedst" for b in ("a", "é", "ion", "")]
    say = lambda n: rnd.choices(vocab, k=n)
    items = [(i, " ".join(say(rnd.choice([8, 15, 20, 30]))), "x") for i in range(12)]
    items += [(100, "the end", ""), (101, None, ""), (102, " ", ""), (103, items[0][1].encode().upper().decode(), ""), (None, "one two three four five six seven eight nine", "")]
    docs = []
    for d in range(60):
        w = say(rnd.randrange(60))
        if d % 2:
            q = items[rnd.randrange(12)][1].split()
            for _ in range(rnd.randrange(decontam.allowed(len(q)) + 1)):
                p = rnd.randrange(len(q))
                q[p:p + rnd.randrange(2)] = say(rnd.randrange(2))
            at = rnd.randrange(len(w) + 1)
            w[at:at] = q
        docs.append((d, "\n".join(w) if d % 3 else "  ".join(w), "m"))
    docs += [(200, "The  END", "m"), (201, "not the end", "m"), (202, None, "m"), (203, "", "m"), (204, docs[1][1], "m"), (None, docs[1][1], "m"),
             (205, "one two three four five six seven eight nine ten", "m"), (206, " ".join(say(30000)) + " " + items[3][1], "m")]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string, matches string"), spark.createDataFrame(items, "item_id long, text string, doc_id string")
    want = brute(docs[:-1], items)
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontam.contaminated(df, bench).collect()}
    assert got.pop((206, 3)) == 0
    got = {k: v for k, v in got.items() if k[0] != 206}
    assert set(got) <= set(want) and all(want[k] == v for k, v in got.items())
    assert all(k in got for k, v in want.items() if v == 0)
    assert len(got) >= 0.97 * len(want)
    small = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(df, bench, block_bytes=200).collect()}
    assert len(small ^ {*got, *[x for x in small if x[0] == 206]}) <= 0.06 * len(want)
    kept = decontam.clean(df, bench)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {d[0] for d in docs} - {k[0] for k in got} - {206} - ({None} if (None, 1) in got else set())
    assert decontam.contaminated(df.limit(0), bench).count() == 0 and decontam.clean(df, bench.limit(0)).count() == len(docs)


def test_recall_at_the_largest_distance():
    rnd = random.Random(4)
    items = [[f"w{rnd.randrange(2000)}" for _ in range(rnd.randrange(15, 60))] for _ in range(150)]
    block = decontam.Block(list(range(150)), [" ".join(i).encode() for i in items])
    texts = []
    for q in items:
        w = list(q)
        for _ in range(decontam.allowed(len(q))):
            p = rnd.randrange(len(w))
            w[p:p + rnd.randrange(2)] = [f"w{rnd.randrange(2000)}"] * rnd.randrange(2)
        texts.append(" ".join([f"x{i}" for i in range(20)] + w + [f"y{i}" for i in range(20)]).encode())
    found = block.search(texts)
    assert sum(i in {m["item"] for m in f} for i, f in enumerate(found)) >= 0.97 * 150
