import random

import numpy as np

from ringfence.llm import queries, toxicity

SF = "/root/testdata/sf0.01"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_automaton_against_brute_force():
    rnd = random.Random(7)
    terms = ["clown", "idiot", "réeux*", "scum", "clowns", "disgusting", "abab*"]
    lexicon = toxicity.Lexicon(terms)
    words = [t.rstrip("*") for t in terms] + ["abc", "x", "clow", "klown", "cloown", "scumm", "réeuxment", "reeuxment", "ababxyz", "abbbxyz", "idiots"]
    for _ in range(600):
        w = list(rnd.choice(words))
        for _ in range(rnd.randrange(3)):
            p = rnd.randrange(len(w) + 1)
            w[p:p + rnd.randrange(2)] = rnd.choices("abclownsé日", k=rnd.randrange(2))
        words.append("".join(w) or "q")
    text = " ".join(words)
    chars = np.minimum(np.frombuffer(text.encode("utf-32-le"), np.uint32), 65535).astype(np.uint16)
    size = np.array([len(w) for w in words])
    start = np.cumsum(size + 1) - size - 1
    got = lexicon.match(chars, start, start + size)
    for w, (k, e) in zip(words, got.tolist()):
        best = {}
        for i, t in enumerate(terms):
            s, most = t.rstrip("*"), 1 if len(t.rstrip("*")) >= toxicity.LEAST else 0
            d = min(edits(s, w[:n]) for n in range(len(w) + 1)) if t.endswith("*") else edits(s, w)
            if d <= most:
                best[i] = d
        assert (k >= 0) == bool(best), w
        if best:
            assert e == min(best.values()) and best[k] == e, w


def test_context_windows():
    lexicon = toxicity.Lexicon(["idiot"])
    texts = ['he wrote idiot there', 'the "idiot" word', "you idiot", "some idiot here", "an idiott", "", "you said " + "x " * 20 + "idiot"]
    x = np.expm1(toxicity.features(lexicon, texts)[:, :5]).round().astype(int).tolist()
    assert x == [[1, 0, 1, 0, 0], [1, 0, 1, 0, 0], [1, 0, 0, 1, 0], [1, 0, 0, 0, 1], [0, 1, 0, 0, 1], [0] * 5, [1, 0, 0, 0, 1]]


def test_held_out_accuracy(spark):
    scored = queries.op4_toxicity(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.93 * len(rows)
    assert scored.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_odd_rows(spark):
    docs = spark.createDataFrame([(i, ("you scum " if i % 2 else "kind words ") + "x y z " * (i % 7), "s") for i in range(60)]
                                 + [(100, None, "s"), (101, "", "s"), (102, "scum " * 30000, "s"), (1, "you scum x y z ", "s"), (None, "scum", None)],
                                 "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(60)] + [(None, 1, 1), (5, None, 1), (1, 1, 1)], "doc_id long, toxic int, text int")
    model = toxicity.learn(docs, labels)
    out = {r["doc_id"]: r["p"] for r in toxicity.with_score(docs, model, name="p").collect()}
    assert out[1] > 0.5 and out[102] > 0.5 and out[0] < 0.5 and out[100] == out[101] < 0.5
    assert toxicity.learn(docs, labels.limit(0)) is None and toxicity.learn(docs, labels.where("toxic = 1")) is None
    assert {r["p"] for r in toxicity.with_score(docs, None, name="p").collect()} == {0.5}
    assert toxicity.with_score(docs.limit(0), model, name="p").count() == 0


def test_terms_of_more_than_255_letters():
    terms = [chr(0x4e00 + 5 * i) + chr(0x4e00 + 5 * i + 1) + chr(0x4e02 + 5 * i) for i in range(120)]
    lexicon = toxicity.Lexicon(terms)
    words = [*terms, "\u4e00\u4e00\u4e00"]
    chars = np.frombuffer(" ".join(words).encode("utf-16-le"), np.uint16)
    start = np.arange(len(words)) * 4
    assert lexicon.match(chars, start, start + 3)[:, 0].tolist() == [*range(120), -1]


def test_apostrophes_are_no_quotation_marks():
    lexicon = toxicity.Lexicon(["idiot"])
    plain, short, quoted = toxicity.features(lexicon, ["do not be an idiot, it is bad", "don't be an idiot, it's bad", "so 'an idiot', it is bad"])
    assert np.array_equal(plain[1:5], short[1:5]) and not np.array_equal(plain[1:5], quoted[1:5])
