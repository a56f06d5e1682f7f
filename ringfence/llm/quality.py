"""Quality rules: a threshold table compiled into Spark projections (no user functions, no shuffle).

``RULES`` is the table.  Each row names a measure, a bound and its direction; the
measures are built-in expressions over one text, so the whole verdict is computed
where the text is read.

Cases: null text counts as empty; an empty text has zero for every measure and
fails the length rule; a text of any length costs n log n in its words; repeated
rows are judged each on its own; an empty table gives an empty table; columns of
the input other than the text are passed through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import body, words

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = tuple("""
a an and are as at be by for from has he in is it its of on or that the this to was were will with
als auch auf aus bei das dem den der des die ein eine einen er es für im ist mit nicht sich sie sind und von zu
au aux avec ce dans de des du elle en est et il la le les ne ou par pas pour que qui se sur un une
al como con del el esta la las lo los más no para por que se su sus una y
""".split())

#: (measure, "min" or "max", bound).  A document is kept if it passes every row.
RULES = (
    ("n_words", "min", 50.0),
    ("repeat_word_ratio", "max", 0.5),
    ("mean_word_chars", "min", 2.0),
    ("mean_word_chars", "max", 14.0),
    ("symbol_ratio", "max", 0.15),
    ("stop_word_ratio", "min", 0.04),
    ("dup_line_ratio", "max", 0.5),
)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def measures(docs: DataFrame, text: str = "text", prefix: str = "q_") -> DataFrame:
    """``docs`` with a struct column ``<prefix>m`` of all measures of its text.

    ``prefix`` keeps the working columns apart from those of the input.  The
    working columns are split over projections so that an array is built once,
    not once for each element that looks into it.
    """
    def c(name: str) -> Column:
        return F.col(prefix + name)

    word = c("words")
    steps = [
        {"text": body(text)},
        {"words": words(c("text")), "lines": F.filter(F.split(c("text"), "\n"), lambda x: x.rlike("[^ \\t-\\r]"))},
        {"n": F.size(word), "lower": F.transform(word, F.lower),
         "windows": F.when(F.size(word) >= 3, F.transform(
             F.sequence(F.lit(0), F.size(word) - 3),
             lambda i: F.xxhash64(F.get(word, i), F.get(word, i + 1), F.get(word, i + 2))))},
        # windows in order of their hash, with their place; only where any two are equal
        {"sorted": F.when(F.size(F.array_distinct(c("windows"))) < F.size(c("windows")), F.sort_array(
            F.transform(c("windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))))},
        {"again": F.array_sort(F.transform(F.filter(
            c("sorted"), lambda s, j: F.coalesce(F.get(c("sorted"), j - 1)["h"] == s["h"], F.lit(False))
            | F.coalesce(F.get(c("sorted"), j + 1)["h"] == s["h"], F.lit(False))), lambda s: s["i"]))},
        # a window covers three words, or as many as there are up to the next such window
        {"repeat": F.coalesce(F.aggregate(
            F.transform(c("again"), lambda x, j: F.least(F.lit(3), F.coalesce(F.get(c("again"), j + 1) - x, F.lit(3)))),
            F.lit(0), lambda a, x: a + x), F.lit(0))},
    ]
    out = docs
    for step in steps:
        out = out.withColumns({prefix + k: v for k, v in step.items()})
    n = c("n").cast("long")
    n_lines = F.size(c("lines")).cast("long")
    word_chars = F.length(F.array_join(word, "")).cast("long")
    n_symbols = F.length(F.regexp_replace(c("text"), "[^#*$%&|<>]+", "")).cast("long")
    n_dup_lines = n_lines - F.size(F.array_distinct(c("lines")))
    n_stop = F.size(F.filter(c("lower"), lambda w: w.isin(*STOP_WORDS))).cast("long")
    n_repeat = c("repeat").cast("long")
    packed = F.struct(
        n.alias("n_words"), word_chars.alias("word_chars"), n_symbols.alias("n_symbols"),
        n_dup_lines.alias("n_dup_lines"), n_repeat.alias("n_repeat_words"), n_lines.alias("n_lines"),
        n_stop.alias("n_stop_words"), _ratio(word_chars, n).alias("mean_word_chars"),
        _ratio(n_symbols, n).alias("symbol_ratio"), _ratio(n_stop, n).alias("stop_word_ratio"),
        _ratio(n_dup_lines, n_lines).alias("dup_line_ratio"), _ratio(n_repeat, n).alias("repeat_word_ratio"))
    # a generator of one row: a condition on the measures stays above it and doesn't make them again below
    own = [F.col(f"`{x}`") for x in docs.columns]
    return out.select(*own, F.explode(F.array(packed)).alias(prefix + "m"))


def verdict(measure, rules=RULES) -> Column:
    """All rules of the table as one condition; ``measure(name)`` is that measure's column."""
    out = F.lit(True)
    for name, side, bound in rules:
        out = out & (measure(name) >= F.lit(bound) if side == "min" else measure(name) <= F.lit(bound))
    return out


def apply_rules(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """One row per document of ``docs``: its columns, the measures (``quality``) and ``kept``."""
    out = measures(docs, text, prefix="__q_")
    return out.withColumn("__kept", verdict(lambda name: F.col("__q_m")[name], rules))


def keep(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The documents that pass, with the columns they came with."""
    return apply_rules(docs, text, rules).where("__kept").select(*[F.col(f"`{x}`") for x in docs.columns])
