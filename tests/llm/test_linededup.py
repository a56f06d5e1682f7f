import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ringfence.llm import linededup


def normal(line):
    for c in "\t\n\x0b\x0c\r":
        line = line.replace(c, " ")
    return [w for w in line.lower().split(" ") if w]


def shingles(normal):
    """Every run of CHARS characters; a short line equals itself alone."""
    n = linededup.CHARS
    return {normal[i:i + n] for i in range(len(normal) - n + 1)} if len(normal) >= linededup.MIN_CHARS else {normal}


def brute(rows, similarity):
    """(doc, line_no) -> kept, by all pairs of lines."""
    at = [(d is None, d or 0, n, line) for d, t, _ in rows for n, line in enumerate((t or "").split("\n"))]
    kinds = sorted({" ".join(normal(x[3])) for x in at if normal(x[3])})
    sets = [shingles(k) for k in kinds]
    root = list(range(len(kinds)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(kinds)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= similarity * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    place = {k: i for i, k in enumerate(kinds)}
    first, out = {}, {}
    for none, d, n, line in sorted(at, key=lambda x: x[:3]):
        key = " ".join(normal(line))
        if key in place:
            first.setdefault(find(place[key]), (none, d, n))
    for none, d, n, line in at:
        key = " ".join(normal(line))
        out[None if none else d, n] = key not in place or first[find(place[key])] == (none, d, n)
    return out


def make(seed, n=40):
    rnd = random.Random(seed)
    vocab = [f"{a}{b}{c}" for a in ("th", "on", "Er", "in") for b in ("ed", "é", "or") for c in ("", "st", "wh")]
    base = [rnd.choices(vocab, k=rnd.choice([3, 8, 20, 60])) for _ in range(30)]
    rows = []
    for d in range(n):
        text = []
        for _ in range(rnd.randrange(5)):
            w = list(rnd.choice(base)) if rnd.random() < 0.7 else rnd.choices(vocab, k=rnd.randrange(40))
            for _ in range(rnd.randrange(3)):
                if w:
                    w[rnd.randrange(len(w))] = rnd.choice(vocab)
            text.append((" ", "  ", "\t")[rnd.randrange(3)].join(w))
        rows.append((d, "\n".join(text), "mine"))
    return rows


def test_against_all_pairs(spark):
    rows = make(2) + [(100, None, "x"), (101, "", "x"), (102, "\n\n", "x"), (103, "a " * 30000, "x"), (104, "a " * 30000 + "b", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, line string")
    got = {(r["doc_id"], r["line_no"]): r["kept"] for r in linededup.decide(df).collect()}
    want = brute(rows, linededup.SIMILARITY)
    assert set(got) == set(want)
    wrong = [k for k in want if got[k] != want[k]]
    assert len(wrong) <= 0.02 * len(want), wrong
    kept = {r["doc_id"]: r["text"] for r in linededup.clean(df).collect()}
    assert linededup.clean(df).columns == df.columns
    for d, text, _ in rows:
        left = [x for i, x in enumerate((text or "").split("\n")) if got[d, i]]
        if all(got[d, i] for i in range(len((text or "").split("\n")))):
            assert kept[d] == text
        elif any(normal(x) for x in left):
            assert kept[d] == "\n".join(left)
        else:
            assert d not in kept
    assert linededup.decide(df.limit(0)).count() == 0 and linededup.clean(df.limit(0)).count() == 0


def test_chains_in_one_bucket_are_linked(spark):
    """a ~ b ~ c without a ~ c: all in one bucket with a first; c is found by way of b."""
    words = [f"word{i:03d}and" for i in range(100)]
    rows = [(i, " ".join(words[i * 4:i * 4 + 60]), "") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, x string")
    out = linededup.decide(df).collect()
    assert [r["doc_id"] for r in out if r["kept"]] == [0]


def test_repeated_and_missing_ids(spark):
    line = "five words make a line here"
    rows = [(7, line, ""), (7, line, ""), (7, "other\n" + line, ""), (None, line, ""), (3, f"{line}\n{line.upper()}\nx", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, x string")
    out = linededup.decide(df).where(F.col("component").isNotNull()).collect()
    assert [(r["doc_id"], r["line_no"]) for r in out if r["kept"]] == [(3, 0)]
    assert sorted(r["text"] for r in linededup.clean(df).collect()) == [line + "\nx", "other"]


def test_plan_makes_no_cross_join(spark):
    df = spark.createDataFrame(make(1, 5), "doc_id long, text string, x string")
    plan = linededup.decide(df)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Cartesian", "NestedLoop"))


def test_sets_and_bands():
    rnd = random.Random(9)
    said = ["".join(rnd.choices("ab é中😀", k=rnd.randrange(8, 80))) for _ in range(300)] + ["aaaaaaaa", "x" * 3000]
    key, offset = linededup.sets([x.encode() for x in said])
    got = [set((key[a:b] & linededup._MASK).tolist()) for a, b in zip(offset, offset[1:])]
    value = {}
    for x, mine in zip(said, got):
        assert len(mine) == len(shingles(x))
        for g in shingles(x):
            one = linededup.sets([g.encode()])[0].tolist()
            assert value.setdefault(g, one[0]) == one[0] and one[0] in mine
    assert len(set(value.values())) == len(value)
    step = (1 << 52) // 8
    want = []
    for mine in got:
        around = sorted(mine)
        at = [sum(v < step // 2 + j * step for v in around) for j in range(8)]
        want.append([tuple(around[(p + k) % len(around)] for k in range(3)) for p in at])
    have = linededup.bands(key, offset, 8).tolist()
    names = {}
    for w, h in zip(want, have):
        for j in range(8):
            assert names.setdefault((j, w[j]), h[j]) == h[j]
    assert len(set(names.values())) == len(names)
    pairs = np.array([(i, j) for i in range(60) for j in range(i)])
    both = linededup._overlap(key, offset, pairs[:, 0], pairs[:, 1])
    cells = linededup.counts(key, offset)
    packed = pa.array([x.tobytes() for x in cells[:, ::2] << 4 | cells[:, 1::2]])
    assert (linededup._unpacked(packed) == cells).all()
    cells = cells.astype(np.int8)
    may = linededup._may((np.diff(offset),) * 2, (cells, cells), pairs[:, 0], pairs[:, 1], 0.5)
    for (i, j), n, ok in zip(pairs.tolist(), both.tolist(), may.tolist()):
        assert n == len(got[i] & got[j])
        assert ok or n < 0.5 * len(got[i] | got[j])


def test_similar_lines_of_crowded_buckets_are_linked(spark):
    """A long common passage brings many families into the same buckets; every similar pair of a bucket counts."""
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choices("abcdefghijklmnop", k=6))
    passage, rows = [word() for _ in range(30)], []
    for _ in range(150):
        own = [word() for _ in range(14)]
        for _ in range(2):
            mine = list(own)
            for _ in range(rnd.randrange(1, 4)):
                mine[rnd.randrange(14)] = word()
            rows.append((len(rows), " ".join(passage + mine), ""))
    docs = spark.createDataFrame(rows, "doc_id long, text string, x string")
    places = linededup.signed(docs)
    known = {linededup.value(x.encode()): shingles(x) for _, x, _ in rows}
    root, crowd = {x: x for x in known}, {}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for r in places.collect():
        for b in r["buckets"]:
            crowd.setdefault(b, []).append(r["line"])
    assert max(map(len, crowd.values())) > 20
    for own in crowd.values():
        for i, a in enumerate(own):
            for b in own[:i]:
                both = len(known[a] & known[b])
                if both >= linededup.SIMILARITY * (len(known[a]) + len(known[b]) - both):
                    root[find(a)] = find(b)
    group = {}
    for x in known:
        group.setdefault(find(x), set()).add(x)
    want = {frozenset(g) for g in group.values() if len(g) > 1}
    for block in (linededup.BLOCK, 7):
        got = {}
        for r in linededup.line_components(docs, places, block=block).collect():
            got.setdefault(r["root"], set()).add(r["line"])
        assert {frozenset(g) for g in got.values()} == want


def test_lines_that_differ_in_a_long_words_tail_stay(spark):
    base = "read the full report here: https://www.example.org/reports/"
    thai = "ขอเชิญทุกท่านเข้าร่วมงานประชุมประจำปีของสมาคม"
    said = [base + "2019-annual", base + "2024-climate", f"{thai} one two three {thai}กรุงเทพ", f"{thai} one two three {thai}เชียงใหม่ในเดือนหน้า"]
    out = linededup.decide(spark.createDataFrame(list(enumerate(said)), "doc_id long, text string")).collect()
    assert len(out) == 4 and all(r["kept"] for r in out)


def test_lines_with_one_letter_changed_are_found(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(60):
        line = " ".join("".join(rnd.choices("abcdefghijklmnopqrst", k=rnd.randrange(2, 10))) for _ in range(12))
        at = rnd.choice([k for k, c in enumerate(line) if c != " "])
        rows += [(2 * i, line), (2 * i + 1, line[:at] + "z" + line[at + 1:])]
    out = linededup.decide(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    kept = sorted(r["doc_id"] for r in out if r["kept"])
    assert set(range(0, 120, 2)) <= set(kept) and len(kept) <= 62, kept


def test_short_lines_and_lines_without_blanks(spark):
    thai = "ขอเชิญทุกท่านเข้าร่วมงานประชุมประจำปีของสมาคมในเดือนหน้าที่กรุงเทพมหานคร"
    rows = [(0, "Read more\n\n" + thai), (1, "read  MORE\nok\n\n"), (2, "ok\nread on\n" + thai), (3, thai[:-1]), (4, "  \nno")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = linededup.decide(df).collect()
    assert sorted((r["doc_id"], r["line_no"]) for r in out if not r["kept"]) == [(1, 0), (2, 0), (2, 2), (3, 0)]
    assert {r["doc_id"]: r["text"] for r in linededup.clean(df).collect()} == {0: rows[0][1], 1: "ok\n\n", 2: "read on", 4: rows[4][1]}


def test_shuffle_files_are_gone_after_each_step(spark):
    """What a step has shuffled doesn't stay on disk until the driver collects garbage, and what is written leaves out texts."""
    df = spark.createDataFrame(make(4), "doc_id long, text string, x string")
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, written, seen = spark.conf.get(key), linededup.written, []

    def watched(df, name, *codec):
        seen.append((name, spark.conf.get(key), set(df.columns)))
        return written(df, name, *codec)
    linededup.written = watched
    try:
        linededup.decide(df)
    finally:
        linededup.written = written
    assert {"places", "buckets", "counts", "pairs", "links", "members", "crowds", "near", "lines"} == {x[0] for x in seen}
    assert {x[1] for x in seen} == {"true"} and spark.conf.get(key) == before
    assert {x[0] for x in seen if "normal" in x[2]} == {"lines"}


def test_unlike_lines_seldom_meet():
    """Bands of larger sets are longer, so the pairs of unlike lines to compare stay few; two similar sets share a tier, whatever their sizes."""
    rnd = random.Random(11)
    vocab = ["".join(rnd.choices("etaoins", k=rnd.randrange(1, 4))) for _ in range(60)]
    said = [" ".join(rnd.choices(vocab, k=rnd.randrange(60, 160))).encode() for _ in range(3000)]
    key, offset = linededup.sets(said)
    met = lambda found: sum(n * (n - 1) // 2 for n in np.unique(found, return_counts=True)[1].tolist())
    found, many = linededup.tier_bands(key, offset)
    assert many.sum() == len(found) and met(found) * 20 < met(linededup.bands(key, offset, 8).reshape(-1))
    size = np.arange(1, 600)
    have = []
    least = 0
    for _, _, most in linededup.TIERS:
        have.append((size >= least) & (size <= most))
        least = linededup.SIMILARITY * most
    for a in size.tolist():
        for b in range(a, min(int(a / linededup.SIMILARITY), 599) + 1):
            assert any(x[a - 1] and x[b - 1] for x in have), (a, b)
    long = "".join(rnd.choices("abcdefghijklmnop", k=320))
    for n in (20, 48, 60, 245, 255, 320):  # a pair of every tier and on both sides of their borders
        own = [long[:n].encode(), (long[:n] + "x").encode()]
        key, offset = linededup.sets(own)
        found, many = linededup.tier_bands(key, offset)
        assert set(found[:many[0]].tolist()) & set(found[many[0]:].tolist()), n
