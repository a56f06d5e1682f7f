"""Registered queries of this folder: name -> ``fn(spark, sf_dir)`` and, where SQL can say it, the DuckDB form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import chat, decontam, langid, linededup, lm, packing, quality, ready, rtree, simhash, substring, tokenfile, toxicity, trie
from .graph import stable, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _rules_sql() -> str:
    return " AND ".join(f"{name} {'>=' if side == 'min' else '<='} {bound}::DOUBLE" for name, side, bound in quality.RULES)


_STOP_LIST = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)

OP7_SQL = f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents),
s AS (SELECT rid, doc_id, body, list_filter(string_split_regex(body, '[ \\t-\\r]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS ls FROM t),
win AS (SELECT rid, unnest(range(1, greatest(len(ws) - 1, 1))) AS i,
               unnest(list_transform(range(1, greatest(len(ws) - 1, 1)), lambda k: ws[k] || ' ' || ws[k + 1] || ' ' || ws[k + 2])) AS h
        FROM s),
dup AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, h) > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM dup) GROUP BY rid),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
             len(ls) AS n_lines, len(list_filter(ws, lambda w: lower(w) IN ({_STOP_LIST})))::BIGINT AS n_stop_words
      FROM s LEFT JOIN rep USING (rid)),
r AS (SELECT *, CASE WHEN n_words > 0 THEN word_chars::DOUBLE / n_words ELSE 0 END AS mean_word_chars,
             CASE WHEN n_words > 0 THEN n_symbols::DOUBLE / n_words ELSE 0 END AS symbol_ratio,
             CASE WHEN n_words > 0 THEN n_stop_words::DOUBLE / n_words ELSE 0 END AS stop_word_ratio,
             CASE WHEN n_lines > 0 THEN n_dup_lines::DOUBLE / n_lines ELSE 0 END AS dup_line_ratio,
             CASE WHEN n_words > 0 THEN n_repeat_words::DOUBLE / n_words ELSE 0 END AS repeat_word_ratio,
             n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_stop_words, base_failed,
       NOT base_failed AND {_rules_sql()} AS kept FROM r
"""


@query("op7_quality_rules", OP7_SQL)
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    m = F.col("__q_m")
    failed = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
    return out.select(
        "doc_id", *[m[x].alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words")],
        failed.alias("base_failed"), (~failed & F.col("__kept")).alias("kept"))


@query("op3_simhash_near_dedup")
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.assign(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op10_chat_formatting")
def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.digests(stable(chat.format_conversations(rows)))


@query("op2_token_file")
def op2_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    parts = tokenfile.write(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2)
    return tokenfile.read(spark, parts, tokenfile.crc32, "ids_crc32 long")


@query("op8_benchmark_decontamination")
def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


@query("op6_line_dedup")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.decide(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "line_no", "component", "kept")


def _fold(n: int):
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % n


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(_fold(5) != 0)
    out = toxicity.with_score(docs, toxicity.learn(docs, labels))
    return out.select("doc_id", (_fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "pages"), langid.learn(table(spark, sf_dir, "documents")))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL


@query("op1_lm_scoring")
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = lm.learn(docs.where(_fold(7) != 2), public_tokenizers.path("byte_bpe_50k.json"))
    return lm.score(docs, model).withColumn("held_out", _fold(7) == 2)


def _crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII string in SQL: eight shifts for each byte."""
    step = "xor(c, ascii(s))"
    for _ in range(8):
        step = f"list_transform([{step}], lambda v: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))[1]"
    return f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)), lambda c, s: {step.replace('ascii(s)', 's')}), 4294967295)"


OP13_SQL = f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
                  coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT conv_id, count(*) AS n FROM t GROUP BY 1),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc32_sql("conv_id::VARCHAR")} % 9 AS h FROM k),
w AS (SELECT c.conv_id, t.i AS d, t.r, t.x FROM c JOIN t ON t.conv_id = c.base AND t.i <= c.h
      UNION ALL SELECT c.conv_id, least(c.h, coalesce(k.n, 0)) + t.i - c.h, t.r, t.x
      FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > c.h LEFT JOIN k ON k.conv_id = c.base),
p AS (SELECT conv_id, d, x, array_to_string(list(sha256(length(r) || ':' || r || x)) OVER (PARTITION BY conv_id ORDER BY d), ',') AS key FROM w
      UNION ALL SELECT conv_id, 0, '', '' FROM c),
m AS (SELECT *, lag(key) OVER (PARTITION BY conv_id ORDER BY d) AS up, max(d) OVER (PARTITION BY conv_id) AS l FROM p),
n AS (SELECT d, key, max(up) AS up, min(conv_id) AS low, count(*) AS n, max(strlen(x)) AS size,
             coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE d = l), '') AS ends FROM m GROUP BY d, key),
kids AS (SELECT up AS key, count(*) AS n FROM n WHERE d > 0 GROUP BY up),
pairs AS (SELECT DISTINCT a.key AS above, b.key AS below FROM m a JOIN m b ON a.conv_id = b.conv_id AND b.d >= a.d),
sums AS (SELECT above, sum(CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END) AS leaves, sum((n.n - 1) * n.size) AS saved
         FROM pairs JOIN n ON n.key = below LEFT JOIN kids ON kids.key = below GROUP BY above)
SELECT n.low AS conv_id, n.d::BIGINT AS depth, q.low AS parent_conv_id, n.n::BIGINT AS n_convs, coalesce(kids.n, 0)::BIGINT AS n_children,
       sums.leaves::BIGINT AS n_leaves, sums.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n LEFT JOIN n q ON n.d > 0 AND q.key = n.up LEFT JOIN kids ON kids.key = n.key JOIN sums ON sums.above = n.key
"""


@query("op13_conversation_prefix_trie", OP13_SQL)
def op13_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    seqs = written(trie.sequences(table(spark, sf_dir, "conversations")), "trie-sequences")
    turns = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    return trie.build(trie.spliced(seqs, F.col("conv_id") - F.col("conv_id") % 5, turns))


OP11_SQL = """
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
n AS (SELECT p.a, p.b, p.score AS ps, s.b AS nb, s.score AS ns, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS r
      FROM p JOIN s ON s.a = p.a AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT a AS anchor_id, b AS positive_id, r::INT AS rank, nb AS negative_id, ps AS positive_score, ns AS negative_score FROM n WHERE r <= 3
"""


@query("op11_hard_negative_mining", OP11_SQL)
def op11_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rtree.mine(rtree.usable(table(spark, sf_dir, "embeddings"), label), F.col("vec_id") % 50 == 0)


OP12_SQL = """
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \\t-\\r]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT rid, doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS h FROM (SELECT *, unnest(range(1, len(ws) - 18)) AS i FROM t WHERE len(ws) >= 20)),
f AS (SELECT *, min(coalesce(doc_id, 9223372036854775807)) OVER (PARTITION BY h) AS d0 FROM w),
g AS (SELECT *, min(CASE WHEN coalesce(doc_id, 9223372036854775807) = d0 THEN i END) OVER (PARTITION BY h) AS i0 FROM f),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 20)) AS p FROM g WHERE coalesce(doc_id, 9223372036854775807) > d0 OR i > i0),
lost AS (SELECT rid, list(p) AS ps FROM gone GROUP BY rid),
k AS (SELECT doc_id, len(ws) AS n, coalesce(len(ps), 0) AS m,
             CASE WHEN ps IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(ps, i)) END AS kept FROM t LEFT JOIN lost USING (rid))
SELECT doc_id, n::BIGINT AS n_words, m::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""


@query("op12_substring_dedup", OP12_SQL)
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
