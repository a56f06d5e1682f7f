"""The random-forest score, against its labels and for different input layouts."""

from pyspark.sql import functions as F

from ringfence.operators.rules import predicate
from ringfence.operators.scores import FEATURES, held_out, random_forest_scores, ranges, smallest_hashes
from ringfence.sources import fixtures as fx
from ringfence.sources.tables import Tables

from paths import SF_SMALL


def _labelled(spark):
    cdr = fx.cdr(Tables(spark, SF_SMALL))
    label = F.coalesce(predicate("r01") | predicate("r02") | predicate("r03") | predicate("r04"), F.lit(False))
    return cdr.withColumn("label", label.cast("double")).withColumn("call_id", F.concat_ws("|", *cdr.columns))


def test_random_forest_learns_the_rule_labels(spark):
    rows = _labelled(spark)
    scored = random_forest_scores(rows, rows.filter(~held_out(F.col("call_id"))), trees=30)
    assert scored.count() == rows.count()                      # every event is scored
    right = ((F.col("fraud_probability") > 0.5).cast("double") == F.col("label")).cast("double")
    assert scored.filter(held_out(F.col("call_id"))).select(F.avg(right)).first()[0] > 0.8
    assert scored.filter(F.col("flagged") != (F.col("fraud_probability") > 0.85)).count() == 0


def test_model_does_not_depend_on_the_layout(spark):
    rows = _labelled(spark)
    flagged = [random_forest_scores(rows, rows.repartition(n), trees=10).filter("flagged").count() for n in (4, 8)]
    assert flagged[0] == flagged[1] > 0


def test_fit_rows_are_found_without_sorting_all(spark):
    """The rows with the smallest hashes, ties by key, as a sort of all rows gives them; few rows are sorted."""
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("k"), "id")
    order = F.xxhash64("k")
    for n in (1, 700, 5000):
        got = sorted(r.k for r in smallest_hashes(rows, order, "k", n).collect())
        assert got == sorted(r.k for r in rows.orderBy(order, "k").limit(n).collect())
    plan = smallest_hashes(rows, order, "k", 700)._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan and "shiftright" in plan


def test_forest_is_fitted_on_all_rows(spark):
    """A pattern that none but the rows with the largest hashes show, beyond the 200,000 smallest, is learned; a row without values is scored."""
    ids = spark.range(240_000).select(F.col("id").cast("string").alias("call_id"))
    late = F.xxhash64("call_id") > 7_500_000_000_000_000_000  # about 22,000 rows
    rows = ids.select("call_id", *[F.when(late, 1000).otherwise(F.pmod(F.xxhash64("call_id"), F.lit(10))).cast("int").alias(x) for x in FEATURES],
                      late.cast("double").alias("label"))
    odd = spark.range(1).select(F.lit("odd").alias("call_id"), *[F.lit(None).cast("int").alias(x) for x in FEATURES], F.lit(None).cast("double").alias("label"))
    out = random_forest_scores(rows.unionByName(odd), rows, trees=3)
    found = {r["label"]: r for r in out.groupBy("label").agg(F.min("fraud_probability").alias("low"), F.max("fraud_probability").alias("high"), F.count("*").alias("n")).collect()}
    assert found[0.0]["high"] < 0.1 and found[1.0]["low"] > 0.9
    assert found[0.0]["n"] + found[1.0]["n"] == 240_000 and found[None]["n"] == 1


def test_ranges_follow_all_rows(spark):
    """Borders at the quantiles of all values, without null, NaN and infinity; a column without values has one."""
    values = [None, float("nan"), float("inf")] + [float(i * i) for i in range(97)] + [5.0] * 60
    df = spark.createDataFrame([(v, None) for v in values], "a double, b double")
    a, b = ranges(df, ["a", "b"], 4)
    import numpy as np
    known = [v for v in values if v is not None and v == v]
    want = sorted({float(np.quantile(known, q)) for q in (0.25, 0.5, 0.75)})
    assert a[0] == float("-inf") and a[-1] == float("inf") and np.allclose(a[1:-1], want)
    assert b == [float("-inf"), 0.0, float("inf")]
