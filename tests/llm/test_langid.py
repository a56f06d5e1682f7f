import re

import numpy as np

from ringfence.llm import langid, queries

SF = "/root/testdata/sf0.01"


def brute(pages, model):
    """The same answer for (host, domain, suffix, declaration, text) rows, by plain sums."""
    n = len(model.languages)
    text = langid.TEMPER * model.likelihood([p[4] for p in pages])
    own = np.exp(text - text.max(axis=1, keepdims=True))
    own /= own.sum(axis=1, keepdims=True)
    total, out = own.sum(axis=0), []
    for i, p in enumerate(pages):
        prior = (total + langid.STRENGTH / n) / (total.sum() + langid.STRENGTH)
        for level in (2, 1, 0):
            left = np.maximum(sum(own[j] for j, q in enumerate(pages) if q[level] == p[level]) - own[i], 0)
            prior = (left + langid.STRENGTH * prior) / (left.sum() + langid.STRENGTH)
        same = sum(own[j] for j, q in enumerate(pages) if q[3] == p[3])
        guess = np.array([0.9 if p[3] == k + 2 else 0.1 / (n + 1) for k in range(n)])
        logs = text[i] + np.log((same + langid.STRENGTH * guess) / (total + langid.STRENGTH)) + np.log(prior)
        logs = np.exp(logs - logs.max())
        out.append((model.languages[int(logs.argmax())], float(logs.max() / logs.sum())))
    return out


SAYS = {"en": "the thing of that and this with", "de": "der und nicht die von mit zu", "fr": "le des que pour dans une les"}


def make(spark):
    docs = [(10 * i + j, t, lang) for i in range(5) for j, (lang, t) in enumerate(SAYS.items())]
    docs += [(900, None, "en"), (901, "no language", None), (902, "", "fr"), (None, "no id", "xx")]
    model = langid.learn(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    pages = []
    for i in range(60):
        lang = ("en", "de", "fr", "fr")[i % 4]
        host = (f"h{i % 5}.site.example.{lang}", f"www.a.co.uk", "b.example.com")[i % 3]
        said = (f'<html lang="{lang.upper()}-XX">', "<html>", "<html lang=tlh>", "<HTML class=x lang='de'>")[i % 7 % 4]
        text = SAYS[lang] if i % 5 else ""
        pages.append((i, f"https://user@{host}:80/x?y", f"{said}<script>der der der</script><p>{text}</p>&amp;<!-- le le -->", "z"))
    pages += [(100, None, None, "z"), (101, "", "", "z"), (100, None, None, "z"), (None, "not an address", "<p>the of</p>", "z"), (103, "//x.de", "<p>" + "the " * 50000, "z")]
    return model, pages


def test_against_brute_force(spark):
    model, pages = make(spark)
    assert model.languages == ["de", "en", "fr"]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, lang string")
    got = langid.identify(df, model).collect()
    hosts = {None: "", "": "", "not an address": "not an address", "//x.de": "x.de"}
    rows = []
    for _, url, html, _ in pages:
        host = hosts.get(url) if url in hosts else url.split("@")[1].split(":")[0]
        parts = host.split(".")
        domain = ".".join(parts[-3:] if host.endswith(".co.uk") else parts[-2:])
        said = re.search(r"(?i)<html[^>]*?lang=[\"']?([a-z]+)", html or "")
        said = (said[1].lower() if said else "")
        code = 0 if not said else model.languages.index(said) + 2 if said in model.languages else 1
        text = re.sub(r"<script.*?</script>|<!--.*?-->|<[^>]*>|&amp;", " ", html or "")
        rows.append((host, domain, parts[-1], code, text.encode()))
    want = sorted((-1 if p[0] is None else p[0], *r) for p, r in zip(pages, brute(rows, model)))
    got = sorted((-1 if r["page_id"] is None else r["page_id"], r["lang"], r["probability"]) for r in got)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(abs(g[2] - w[2]) < 1e-4 for g, w in zip(got, want))


def test_without_rows(spark):
    model, pages = make(spark)
    df = spark.createDataFrame(pages, "page_id long, url string, html string, lang string")
    assert langid.identify(df.limit(0), model).count() == 0
    none = langid.learn(spark.createDataFrame([(1, "x", None)], "doc_id long, text string, lang string"))
    assert none is None and {r["lang"] for r in langid.identify(df, None).collect()} == {None}


def test_accuracy(spark):
    out = queries.op5_language_id(spark, SF).collect()
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    path = {k: re.search(r"//[^/]+/(\w\w)/", u or "") for k, u in pages.items()}
    right = [r["lang"] == path[r["page_id"]][1] for r in out if path[r["page_id"]]]
    assert len(out) == len(pages) and sum(right) >= 0.97 * len(right)
