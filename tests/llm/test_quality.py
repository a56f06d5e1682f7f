import random
import re

import duckdb

import __spark_entry__ as E
from ringfence.llm import quality
from tools.check_oracle import TABLES, canon

SF = "/root/testdata/sf0.01"


def brute(text):
    text = text or ""
    words = [w for w in re.split("[ \t-\r]+", text) if w]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = {p for i, w in enumerate(windows) if seen[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search("[^ \t-\r]", x)]
    n, m = len(words), len(lines)
    out = {"n_words": n, "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
           "n_dup_lines": m - len(set(lines)), "n_repeat_words": len(covered), "n_lines": m,
           "n_stop_words": sum(w.lower() in quality.STOP_WORDS for w in words)}
    for name, a, b in (("mean_word_chars", "word_chars", n), ("symbol_ratio", "n_symbols", n), ("stop_word_ratio", "n_stop_words", n),
                       ("dup_line_ratio", "n_dup_lines", m), ("repeat_word_ratio", "n_repeat_words", n)):
        out[name] = out[a] / b if b else 0.0
    return out


def passes(m):
    return all(m[name] >= bound if side == "min" else m[name] <= bound for name, side, bound in quality.RULES)


def test_against_brute_force(spark):
    rnd = random.Random(2)
    vocab = ["the", "of", "Thing", "and,", "über", "né", "x#", "|", "%%%", "日本"]
    texts = [None, "", " ", "\n\n\t", "a", "a b c a b c", "a a a a", "x y\nx y\n \nx y", "\U0001f600 ok ok", "w " * 3000]
    texts += ["".join(rnd.choice(vocab) + rnd.choice([" ", " ", "\n", "  ", "\t"]) for _ in range(rnd.randrange(120))) for _ in range(80)]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(3, "a b", "y", 2), (3, "a b", "y", 2), (None, "the thing", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, q_words int")
    out = quality.apply_rules(df).collect()
    assert len(out) == len(rows)
    for r in out:
        want = brute(r["text"])
        got = r["__q_m"].asDict()
        assert {k: got[k] for k in want} == want, r["text"]
        assert r["__kept"] == passes(want)
    kept = quality.keep(df)
    assert kept.columns == df.columns and kept.count() == sum(passes(brute(r[1])) for r in rows)
    assert quality.apply_rules(df.limit(0)).count() == 0


def test_plan_has_no_user_function_and_no_shuffle(spark):
    plan = quality.apply_rules(spark.createDataFrame([(1, "x")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Exchange"))


def test_query_matches_sql(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()["op7_quality_rules"](spark, SF)
    res = con.execute(E.oracle_sql()["op7_quality_rules"])
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon([d[0] for d in res.description], res.fetchall())


def test_agrees_with_labels(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = E.queries()["op7_quality_rules"](spark, SF).join(labels, "doc_id").collect()
    assert all(r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"])
    assert not any(r["kept"] for r in rows if r["quality"] == 0)
