"""Quality rules with risk-controlled cutoffs (built-in functions only).

Every rule rejects a document whose measure is above a cutoff.  A cutoff is
taken per stratum (language) from a fixed grid: going from the loosest to the
strictest, each is tested on the labelled good documents of the stratum with
the exact binomial tail ``P(Bin(n, risk) <= rejected)``, and the last one
before the first failure is used (fixed-sequence testing needs no correction
along the grid).  The risk is shared among the rules, and the error level
among rules and strata (Bonferroni); so with probability ``1 - ERROR`` no
stratum loses more than ``RISK`` of its good documents to all rules together.
A stratum with too few labels for the loosest test gets no cutoff.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.shared import written

#: Share of a stratum's good documents that all rules together may reject.
RISK = 0.02
#: Probability that any stratum exceeds it.
ERROR = 0.05
#: Measure and its grid of cutoffs, loosest first.
RULES = {
    "symbols_per_word": (2.0, 1.5, 1.0, 0.75, 0.5, 0.35, 0.25, 0.15, 0.1),
    "upper_share": (0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1),
    "dup_line_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3),
    "repeat_share": (0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1),
    "word_length": (12.0, 10.0, 9.0, 8.5, 8.0, 7.5, 7.0, 6.5),
    "word_shortness": (-2.0, -2.5, -3.0, -3.25, -3.5, -3.75, -4.0),
}
#: Terms of the binomial tail that are added one by one; the rest is bounded by a geometric series.
TAIL_TERMS = 4000

_SPACES = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _repeated(h: Column) -> Column:
    """Positions (with their neighbours) of the hashes that occur more than once, from sorted (hash, position) pairs."""
    same = lambda i, x: F.coalesce(F.get(h, i)["h"] == x["h"], F.lit(False))
    return F.filter(h, lambda x, i: same(i - 1, x) | same(i + 1, x))


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``mark`` (hash of the text) and the base counts of every whole text (null: no words).

    ``n_repeat_words`` counts words in 3-word windows found twice or more in
    the text; ``n_dup_lines`` counts lines with a word that equal an earlier
    line.  Each step's arrays are used several times by the next, which keeps
    the optimizer from computing them anew inside a lambda.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bare = F.btrim(text, F.lit(_SPACES))
    lines = F.filter(F.split(text, "\n", -1), lambda x: _without(x, _SPACES) != "")
    counted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("mark"),
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[ \\t\\n\\x0B\\f\\r]+", -1)).alias("w"),
        F.length(_without(text, _SPACES)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(_without(text, _SYMBOLS))).cast("long").alias("n_symbols"),
        (F.length(text) - F.length(_without(text, _UPPER))).cast("long").alias("n_upper"),
        lines.alias("lines"))
    n = F.size("w")
    hashed = counted.select(
        "doc_id", "lang", "mark", n.cast("long").alias("n_words"), "word_chars", "n_symbols", "n_upper",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3),
                                   lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)))).alias("h"))
    kept = ["doc_id", "lang", "mark", "n_words", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines"]
    ordered = hashed.select(*kept, F.when(F.size(F.array_distinct("h")) < F.size("h"),
                                          F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias("s"))
    places = ordered.select(*kept, F.sort_array(F.transform(_repeated(F.col("s")), lambda x: x["i"])).alias("p"))
    reach = F.transform("p", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("p", i + 1) - x, F.lit(3))))
    return places.select(*kept, F.coalesce(F.aggregate(reach, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long")).alias("n_repeat_words"))


def with_rules(base: DataFrame) -> DataFrame:
    """The rules' measures and ``base_failed`` beside the base counts (measures are null without words)."""
    some = lambda c: F.when(F.col("n_words") > 0, c)
    return (base.withColumn("base_failed", (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50))
            .withColumn("symbols_per_word", some(F.try_divide("n_symbols", "n_words")))
            .withColumn("upper_share", some(F.try_divide("n_upper", "word_chars")))
            .withColumn("dup_line_share", some(F.try_divide("n_dup_lines", "n_lines")))
            .withColumn("repeat_share", some(F.try_divide("n_repeat_words", "n_words")))
            .withColumn("word_length", some(F.try_divide("word_chars", "n_words")))
            .withColumn("word_shortness", -F.col("word_length")))


def _log_factorial(x: Column) -> Column:
    """Stirling's series for ``ln x!``, shifted by 7 so that it is exact to ten digits from 0 on."""
    x = x.cast("double")
    z = x + 8
    series = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z ** 3) + 1 / (1260 * z ** 5)
    shift = F.lit(0.0)
    for i in range(1, 8):
        shift = shift + F.log(x + i)
    return series - shift


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """``P(Bin(n, p) <= k)`` for ``k < n p``, else 1; summed downwards from ``k``, never rounded down.

    The ratio of neighbouring terms falls, so what is left after
    ``TAIL_TERMS`` terms is at most a geometric series.
    """
    top = F.exp(_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * math.log(p) + (n - k) * math.log1p(-p))
    ratio = lambda j: (k - j) / (n - k + j + 1) * ((1 - p) / p)
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))
    last = F.least(k, F.lit(TAIL_TERMS).cast("long"))
    total = F.aggregate(F.sequence(F.lit(0).cast("long"), last), start,
                        lambda a, j: F.struct((a["term"] * ratio(j)).alias("term"), (a["sum"] + a["term"] * ratio(j)).alias("sum")))
    rest = total["term"] * F.greatest(F.lit(0.0), ratio(last + 1)) / (1 - F.least(ratio(last + 1), F.lit(0.999999)))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), top * (total["sum"] + rest)))


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """One row per stratum that has a cutoff: ``lang`` and one column per rule (null: rule unused there).

    ``measured`` has ``with_rules`` columns; good documents are those with
    quality 1 in ``labels`` (the smallest, where an id is labelled twice).
    Documents that fail the base test don't count: no rule decides on them.
    """
    good = (labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(F.min("quality").alias("q")).filter("q = 1").select("doc_id"))
    holdout = measured.filter("not base_failed").join(good, "doc_id")
    counts = [F.count(F.lit(1)).alias("n")]
    for r, grid in RULES.items():
        counts += [F.count(F.when(F.col(r) > c, 1)).alias(f"{r}_{i}") for i, c in enumerate(grid)]
    cells = holdout.groupBy("lang").agg(*counts).withColumn("strata", F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))))
    own = risk / len(RULES)
    passed = []
    for r, grid in RULES.items():
        tests = F.array(*[F.struct(F.lit(c).alias("cut"), F.col(f"{r}_{i}").alias("k")) for i, c in enumerate(grid)])
        p = F.transform(tests, lambda t: F.struct(t["cut"].alias("cut"), (binomial_tail(t["k"], F.col("n"), own) * F.col("strata") * len(RULES) <= error).alias("ok")))
        # the last cutoff before the first failure
        chosen = F.aggregate(p, F.struct(F.lit(None).cast("double").alias("cut"), F.lit(True).alias("open")),
                             lambda a, t: F.struct(F.when(a["open"] & t["ok"], t["cut"]).otherwise(a["cut"]).alias("cut"), (a["open"] & t["ok"]).alias("open")))
        passed.append(chosen["cut"].alias(f"cut_{r}"))
    return cells.select("lang", *passed)


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)``, ``lang``, ``mark`` and the rules' measures.

    One row per row of ``docs``.  Null or empty texts have no words and fail
    the base test.  Null languages are a stratum of their own.  Without
    usable labels only the base test decides.  Counts are computed once and
    written to the shared folder, as the fit and the verdict both read them.
    """
    measured = with_rules(written(measures(docs), "quality"))
    cuts = cutoffs(measured, labels, risk, error).withColumnRenamed("lang", "stratum")
    over = F.lit(False)
    for r in RULES:
        over = over | F.coalesce(F.col(r) > F.col(f"cut_{r}"), F.lit(False))
    judged = measured.join(cuts, F.col("lang").eqNullSafe(F.col("stratum")), "left")
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & ~over).alias("kept"), "lang", "mark", *RULES)
