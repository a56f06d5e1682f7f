"""Language identification by Bayesian evidence fusion.

For each page and language the log posterior is the sum of
  - the text's log likelihood under a letter-trigram model, tempered by ``TEMPER``
    because neighbouring trigrams overlap,
  - log P(declared markup language | language), from how declarations and texts
    agree over all pages,
  - the log prior of the page's host, smoothed through its domain, its address suffix and
    all pages (``STRENGTH`` pages' worth at each level).
Priors are sums of the texts' own posteriors, made by grouped aggregation; a page's
own share is taken out of every level before it meets it again.

The trigram model is fitted on at most ``SAMPLE`` texts of known language (the
smallest hashes of their ids); it has ``CELLS`` cells a language whatever the input.

Cases: null or empty markup and addresses count as empty: such pages fall back on
the evidence that is left; a declaration that is no known language is one class of
its own; ties go to the alphabetically first language; texts of any length are read
whole; repeated rows are counted and returned each; without any text of known
language the answer is null; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import stable
from .text import _mix, body, encode

SAMPLE, CELLS, TEMPER, STRENGTH, MOST_LANGUAGES = 16_000, 1 << 16, 0.2, 4.0, 200

_HIDDEN = r"(?is)<(script|style|nav|footer|aside|noscript|template)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[#\w]+;"
#: Bytes that part words: ASCII that isn't a letter.
_PART = np.array([not (97 <= i <= 122 or i >= 128) for i in range(256)])


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, cell) of each byte trigram of the lower-cased words, blanks around words included."""
    joined = b" " + b"  ".join(texts) + b" "
    data = np.frombuffer(joined.lower(), np.uint8)
    data = np.where(_PART[data], np.uint8(32), data)
    keep = (data != 32) | (np.append(data[1:], 33) != 32)  # one blank of a run
    place = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in texts])[:len(data)]
    place = np.append(place, np.full(len(data) - len(place), max(len(texts) - 1, 0)))[keep]
    x = data[keep].astype(np.uint64)
    if len(x) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    code = x[:-2] << np.uint64(16) | x[1:-1] << np.uint64(8) | x[2:]
    inner = (place[:-2] == place[2:]) & (x[1:-1] != 32)
    cell = (_mix(code[inner] + np.uint64(1)) % np.uint64(CELLS)).astype(np.int64)
    return place[1:-1][inner], cell


class Model:
    """Log probability of each cell in each language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.table = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * CELLS)).astype(np.float32)

    def likelihood(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.languages)))
        place, cell = trigrams(texts)
        for k in range(len(self.languages)):
            out[:, k] = np.bincount(place, self.table[cell, k], len(texts))
        return out


def _pieces(rows: list[bytes], most: int = 1 << 21):
    at = 0
    while at < len(rows):
        to, size = at, 0
        while to < len(rows) and (to == at or size + len(rows[to]) <= most):
            size += len(rows[to])
            to += 1
        yield at, rows[at:to]
        at = to


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model | None:
    """Fits on at most ``sample`` rows of ``docs``; at most ``MOST_LANGUAGES`` languages, the most frequent ones."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.lower(F.trim(F.col(f"`{lang}`"))).alias("l"), F.col(f"`{text}`").alias("t"))
    known = rows.where("l is not null and l <> '' and id is not null")
    chosen = known.select("id").orderBy(F.xxhash64("id"), "id").limit(sample).distinct()

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), encode(batch.column(1))
            for at, piece in _pieces(texts):
                place, cell = trigrams(piece)
                own = np.array(langs[at:at + len(piece)], object)[place] if len(place) else np.empty(0, object)
                for name in set(langs[at:at + len(piece)]):
                    total.setdefault(name, np.zeros(CELLS, np.int64))
                    total[name] += np.bincount(cell[own == name], minlength=CELLS)
        for name, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"l": pa.array([name] * len(at), pa.string()), "cell": pa.array(at), "n": pa.array(counts[at])})

    got = known.join(F.broadcast(chosen), "id").select("l", body("t").alias("t")).mapInArrow(count, "l string, cell long, n long")
    summed = stable(got.groupBy("l", "cell").agg(F.sum("n").alias("n")))
    names = sorted(r["l"] for r in summed.groupBy("l").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "l").limit(MOST_LANGUAGES).collect())
    if not names:
        return None
    counts = np.zeros((CELLS, len(names)))
    where = {n: i for i, n in enumerate(names)}
    for r in summed.where(F.col("l").isin(names)).toLocalIterator():  # at most CELLS rows a language
        counts[r["cell"], where[r["l"]]] = r["n"]
    return Model(names, counts)


def address(url: Column) -> dict[str, Column]:
    """Host, domain (two labels, three below a country's shared second level) and suffix of an address."""
    host = F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][\w+.-]*:)?(?://)?(?:[^/@?#]*@)?([^/:?#]*)", 1))
    domain = F.regexp_extract(host, r"((?:[^.]+\.)?(?:(?:co|com|org|net|ac|gov|edu)\.[a-z]{2}|[^.]+))$", 1)
    return {"host": host, "domain": domain, "suffix": F.regexp_extract(host, r"([^.]*)$", 1)}


def _array(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _normal(logs: Column) -> Column:
    top = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(top, lambda x: x / F.aggregate(top, F.lit(0.0), lambda a, y: a + y))


def evidence(pages: DataFrame, model: Model, page_id: str, url: str, html: str) -> DataFrame:
    """page_id, host, domain, suffix, declared, text (log likelihoods, tempered) and own (posterior of the text alone)."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<double>")
    def likelihood(texts: pa.Array) -> pa.Array:
        out = [shared.value.likelihood(piece) for _, piece in _pieces(encode(texts))]
        return pa.array([r.tolist() for part in out for r in part], pa.list_(pa.float64()))

    markup = body(F.col(f"`{html}`"))
    declared = F.lower(F.regexp_extract(markup, r"(?i)<html[^>]*?\blang\s*=\s*[\"']?\s*([a-zA-Z]+)", 1))
    names = F.array(*[F.lit(x) for x in model.languages])
    out = pages.select(F.col(f"`{page_id}`").alias("page_id"), declared.alias("declared"),
                       likelihood(F.regexp_replace(markup, _HIDDEN, " ")).alias("text"),
                       *[v.alias(k) for k, v in address(body(F.col(f"`{url}`"))).items()])
    # 0: none, 1: a language that isn't known, else its place among the known ones plus two
    place = F.array_position(names, F.col("declared")).cast("int")
    out = out.withColumn("said", F.when(F.col("declared") == "", 0).when(place == 0, 1).otherwise(place + 1))
    out = out.withColumn("text", F.transform("text", lambda x: x * TEMPER))
    return out.withColumn("own", _normal(F.col("text")))


def _summed(rows: DataFrame, keys: list[str], n: int, name: str) -> DataFrame:
    """Posterior mass of each language by key."""
    mass = [F.sum(F.get("own", k)).alias(f"m{k}") for k in range(n)]
    return rows.groupBy(*keys).agg(*mass).select(*keys, F.array(*[f"m{k}" for k in range(n)]).alias(name))


def _smoothed(mass: str, above: Column) -> Column:
    """A level's prior without the page's own share, ``STRENGTH`` pages of the level above added."""
    left = F.zip_with(mass, "own", lambda m, o: F.greatest(m - o, F.lit(0.0)))
    total = F.aggregate(left, F.lit(STRENGTH), lambda a, x: a + x)
    return F.zip_with(left, above, lambda x, p: (x + STRENGTH * p) / total)


def identify(pages: DataFrame, model: Model | None, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: page_id, lang, probability, text_lang (of the text alone), declared, host."""
    if model is None:
        return pages.select(F.col(f"`{page_id}`").alias("page_id"), *[F.lit(None).cast(t).alias(c) for c, t in (
            ("lang", "string"), ("probability", "double"), ("text_lang", "string"), ("declared", "string"), ("host", "string"))])
    n, names = len(model.languages), F.array(*[F.lit(x) for x in model.languages])
    rows = stable(evidence(pages, model, page_id, url, html))
    # sums by declaration: at most n + 2 rows
    said = {r["said"]: r["mass"] for r in _summed(rows, ["said"], n, "mass").collect()}
    everything = np.sum(list(said.values()), axis=0) if said else np.zeros(n)
    classes = [np.array(said.get(i, np.zeros(n))) for i in range(n + 2)]
    spoken = []
    for i in range(n + 2):
        # a declaration names its language in nine cases of ten until the pages say otherwise
        guess = np.array([0.9 if i == k + 2 else 0.1 / (n + 1) for k in range(n)])
        spoken.append(np.log((classes[i] + STRENGTH * guess) / (everything + STRENGTH)))
    heard = F.element_at(F.array(*[_array(x) for x in spoken]), F.col("said") + 1)

    hosts = _summed(rows, ["host", "domain", "suffix"], n, "host_mass")
    up = lambda keys, name, of: hosts.groupBy(*keys).agg(*[F.sum(F.get(of, k)).alias(f"m{k}") for k in range(n)]).select(
        *keys, F.array(*[f"m{k}" for k in range(n)]).alias(name))
    hosts = (hosts.join(up(["domain"], "domain_mass", "host_mass"), "domain").join(up(["suffix"], "suffix_mass", "host_mass"), "suffix")
             .select("host", "host_mass", "domain_mass", "suffix_mass"))
    base = (everything + STRENGTH / n) / (everything.sum() + STRENGTH)
    out = rows.join(hosts, "host")
    above: Column = _array(base)
    for level in ("suffix", "domain", "host"):
        out = out.withColumn(f"{level}_prior", _smoothed(f"{level}_mass", above))
        above = F.col(f"{level}_prior")
    out = out.withColumn("heard", heard)
    out = out.withColumn("logs", F.zip_with(F.zip_with("text", "heard", lambda a, b: a + b), "host_prior", lambda a, p: a + F.log(p)))
    out = out.withColumn("posterior", _normal(F.col("logs")))
    best = lambda of: F.element_at(names, F.array_position(of, F.array_max(of)).cast("int"))
    return out.select("page_id", best("posterior").alias("lang"), F.array_max("posterior").alias("probability"), best("own").alias("text_lang"), "declared", "host")

