"""Similarity-threshold evaluation over labelled query pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.vectors import dot

# Fixed value: the threshold grid of the sweep.
THRESHOLDS = [0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90, 0.95]


def distinct_queries(pairs: DataFrame) -> DataFrame:
    """The distinct query keys (content ids) of both pair columns."""
    return pairs.select(F.col("ka").alias("key")).union(pairs.select(F.col("kb").alias("key"))).distinct()


def pair_similarity(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Similarity of each pair ``(ka, kb, ...)`` through two lookups by
    content id on ``vectors(key, embedding)`` (unit vectors, so cosine = dot)."""
    va = vectors.select(F.col("key").alias("ka"), F.col("embedding").alias("ea"))
    vb = vectors.select(F.col("key").alias("kb"), F.col("embedding").alias("eb"))
    return pairs.join(va, "ka").join(vb, "kb").withColumn("sim", dot("ea", "eb")).drop("ea", "eb")


def confusion(sims: DataFrame, thresholds: list[float] = THRESHOLDS) -> DataFrame:
    """tp/fp/fn/tn per threshold; ``sim >= theta`` predicts a hit.  The
    grid is a generated column (no join); one partial+final aggregation."""
    t = sims.select("sim", "expected", F.explode(F.array(*[F.lit(float(x)) for x in thresholds])).alias("theta"))
    p = F.col("sim") >= F.col("theta")
    e = F.col("expected")

    def cnt(c):
        return F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return t.groupBy("theta").agg(cnt(p & e).alias("tp"), cnt(p & ~e).alias("fp"),
                                  cnt(~p & e).alias("fn"), cnt(~p & ~e).alias("tn"))


def metrics(conf: DataFrame) -> DataFrame:
    """I4: precision (1.0 with nothing predicted), hit rate = recall (0.0
    with no positives), F1, false-positive rate; all rounded to 3."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(1.0)
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    fpr = F.when(fp + tn > 0, fp / (fp + tn)).otherwise(0.0)
    return conf.select("theta", F.round(rec, 3).alias("hit_rate"), F.round(prec, 3).alias("precision"),
                       F.round(f1, 3).alias("f1"), F.round(fpr, 3).alias("false_positive_rate"))


def sweep(pairs: DataFrame, vectors: DataFrame, thresholds: list[float] = THRESHOLDS) -> DataFrame:
    """Pair similarities -> confusion -> metrics per threshold; every
    distinct query was encoded once, in ``vectors(key, embedding)``."""
    return metrics(confusion(pair_similarity(pairs, vectors), thresholds))
