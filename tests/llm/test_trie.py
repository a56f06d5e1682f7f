import hashlib
import random
import zlib

from pyspark.sql import functions as F

from ringfence.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, path string, depth int"


def own(rows):
    out = {}
    for conv in {r[0] for r in rows if r[0] is not None}:
        turns = sorted((r[1:4] for r in rows if r[0] == conv), key=lambda t: (t[0] is not None, t[0] or 0, t[1] or "", t[2] or ""))
        out[conv] = [(role or "", text or "") for _, role, text in turns]
    return out


def rebuilt(seqs):
    out = {}
    for conv, turns in seqs.items():
        h = zlib.crc32(str(conv).encode()) % 9
        out[conv] = seqs.get(conv - conv % 5, [])[:h] + turns[h:]
    return out


def brute(seqs):
    nodes = {}
    for conv, turns in seqs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(conv)
    out = []
    for node, members in nodes.items():
        below = [x for x in nodes if x[:len(node)] == node]
        parents = {x[:-1] for x in nodes if x}
        ends = sorted(c for c in members if len(seqs[c]) == len(node))
        out.append((min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members),
                    sum(len(x) == len(node) + 1 for x in below), sum(x not in parents for x in below),
                    sum((len(nodes[x]) - 1) * len(x[-1][1].encode()) for x in below if x),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(rnd):
    said = [("user", "hallo"), ("assistant", "é" * 5), ("user", ""), (None, None), ("a", "1:b"), ("a1:", "b"), ("system", "x\ny")]
    rows = []
    for conv in range(60):
        for turn in range(rnd.choice([1, 1, 2, 4, 7, 12, 20])):
            rows.append((conv * rnd.choice([1, 1, 3]), rnd.choice([turn, turn, None]), *said[min(rnd.randrange(9), 6) if turn > 4 else 0 if turn < 3 else rnd.randrange(3)]))
    rows += [(1000 + c, t, "user", f"same {t}") for c in range(40) for t in range(3)]  # equal conversations
    rows += [(2000, t, "user", "long") for t in range(300)] + [(2001, t, "user", "long") for t in range(299)]
    rows += [(None, 0, "user", "no conversation"), (7003, 0, "user", "one turn"), (3000, 0, "user", "z" * 200000)]
    return [(*r, "k", "p", 3) for r in rows + rows[:10]]


def nodes(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=repr)


def test_against_brute_force(spark):
    rows = rows_of(random.Random(2))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    seqs = own(rows)
    want, again = brute(seqs), brute(rebuilt(seqs))
    made = trie.sequences(df)
    for limit, hop in ((trie.LIMIT, trie.HOP), (3, 4), (1, 64)):
        assert nodes(trie.build(made, limit, hop)) == want, (limit, hop)
    turns = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    assert nodes(trie.build(trie.spliced(made, F.col("conv_id") - F.col("conv_id") % 5, turns), 2, 3)) == again


def test_empty_tables_and_turnless_conversations(spark):
    df = spark.createDataFrame([(7003, 0, "user", "x", "", "", 0)], SCHEMA)
    assert trie.build(trie.sequences(df.limit(0))).count() == 0
    seqs = trie.sequences(df)
    bare = trie.spliced(seqs, F.lit(-1).cast("long"), F.lit(5))
    assert nodes(trie.build(bare)) == [(7003, 0, None, 1, 0, 1, 0, hashlib.sha256(b"7003").hexdigest())]
    assert nodes(trie.build(trie.spliced(seqs, F.lit(-1).cast("long"), F.lit(0)))) == brute({7003: [("user", "x")]})
