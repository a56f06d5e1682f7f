"""The pipeline against the brute-force versions of its stages, run one after the other."""

import random

import corpus_pipeline
from ringfence.llm import decontam, packing
from ringfence.session import shared_path

import test_linededup
import test_quality
import test_simhash

STOP = "the of and to in is that for it with".split()


def fixture():
    rnd = random.Random(12)
    vocab = [a + b + c for a in ("th", "on", "er", "in", "st") for b in ("ed", "or", "al", "ish") for c in ("", "st", "wh", "ly")]
    say = lambda n: " ".join(rnd.choice(STOP) if rnd.random() < 0.3 else rnd.choice(vocab) for _ in range(n))
    items = [(i, say(rnd.choice([15, 25, 40]))) for i in range(5)]
    line = say(30)
    docs = ["\n".join(say(rnd.randrange(8, 60)) for _ in range(rnd.randrange(2, 6))) for _ in range(50)]
    docs[3] += "\n" + line
    docs[4] += "\n" + line
    docs[5] = docs[6]
    docs[7] = docs[8].replace("the", "a", 1)
    docs[9] += " " + items[1][1]
    docs[10] = docs[10] + "\n" + items[2][1].upper()
    docs[11] = ("spam " * 3 + "eggs ") * 40
    docs[12] = docs[12].replace(" ", "%%% ")
    docs += ["short one", None, ""]
    rows = [(i, d, "en", f"src{i % 3}", len(d or "")) for i, d in enumerate(docs)]
    return rows, items


def by_hand(rows, items):
    rows = [r for r in rows if test_quality.passes(test_quality.brute(r[1]))]
    quality = [r[0] for r in rows]
    kept = test_linededup.brute([(r[0], r[1], "") for r in rows], 0.8)
    after = []
    for r in rows:
        text = "\n".join(x for i, x in enumerate(r[1].split("\n")) if kept[r[0], i])
        if text.strip():
            after.append((r[0], text))
    lines = dict(after)
    prints = [test_simhash.brute_print(t) for _, t in after]
    roots = test_simhash.brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    after = [x for i, x in enumerate(after) if roots[i] == i]
    near = [x[0] for x in after]
    words = lambda t: t.lower().encode().split()
    dirty = {d for d, t in after for _, q in items if decontam.edit_infix(words(q), words(t))[0] <= decontam.allowed(len(q.split()))}
    return quality, lines, near, [x for x in after if x[0] not in dirty]


def test_run_and_its_stages(spark, monkeypatch):
    rows, items = fixture()
    folder = shared_path(spark, "test", unique=True)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    quality, lines, near, last = by_hand(rows, items)
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    monkeypatch.setattr(corpus_pipeline, "shared_path", lambda *a, **b: f"{folder}/out")
    result = corpus_pipeline.run(spark, folder)
    seen = {}
    for name, _ in corpus_pipeline.STAGES[:-1]:
        docs = spark.read.parquet(f"{folder}/out/{name}")
        assert docs.columns == columns
        seen[name] = {r["doc_id"]: r for r in docs.collect()}
    assert sorted(seen["quality_rules"]) == quality
    assert {k: r["text"] for k, r in seen["line_dedup"].items()} == lines
    assert all(r["n_chars"] == len(r["text"]) for r in seen["line_dedup"].values())
    assert sorted(seen["simhash_near_dedup"]) == near
    assert sorted(seen["benchmark_decontamination"]) == [x[0] for x in last]
    assert {9, 10}.isdisjoint(seen["benchmark_decontamination"])
    assert sorted((r["doc_id"], r["length"]) for r in result.collect()) == [(d, len(t.split()) + 1) for d, t in last]


def test_stages_on_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, root string, fp long, line string"
    odd = [(None, None, None, None, None, None, None, None), (1, "", "en", "s", 0, "r", 1, "l"), (1, "", "en", "s", 0, "r", 1, "l"),
           (2, "the thing of it " * 900, None, "s", None, "r", None, None), (2, "another text", "en", None, 3, "r", 1, "l"), (None, None, "en", "s", 1, "r", 1, "l")]
    folder = shared_path(spark, "test", unique=True)
    spark.createDataFrame([(1, "a b c d e f g h i j"), (None, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for rows in (odd, []):
        df = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, folder)
            assert out.count() <= max(len(rows), 0)
            if name != "packing":
                assert out.columns == df.columns
    assert packing.assign(spark.createDataFrame(odd, schema)).count() == len(odd)
    assert decontam.MIN_WORDS > 1
