"""Cluster profiles from memberships.

Input: ``memberships(doc_id, text, category, embedding, membership,
label, entropy)``.  Per-cluster top-n lists are ``row_number`` windows that
Spark plans as WindowGroupLimit (partial top-n before the shuffle), so a
cluster holding a large share of the rows never ships them whole."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.functions import text as tx
from lodestar.functions.vectors import sq_dist_raw, top_memberships
from lodestar.operators.encode import TOKEN_SPLIT
from lodestar.operators.evaluate import exact_quantile
from lodestar.operators.fcm import MAX_CENTROIDS
from lodestar.session import ship_package

TOP_CATEGORIES = 5
REPRESENTATIVES = 5
BOUNDARY_DOCS = 3
BOUNDARY_PERCENTILE = 0.85
TOP_TERMS = 10
PROJECTION_STEPS = 24


def sizes(mem: DataFrame) -> DataFrame:
    """G1: cluster sizes (empty clusters do not appear)."""
    return mem.groupBy(F.col("label").alias("cluster")).agg(F.count(F.lit(1)).alias("size"))


def top_categories(mem: DataFrame, n: int = TOP_CATEGORIES) -> DataFrame:
    """The n most common categories per cluster (ties by name)."""
    c = mem.groupBy(F.col("label").alias("cluster"), "category").agg(F.count(F.lit(1)).alias("cnt"))
    w = Window.partitionBy("cluster").orderBy(F.col("cnt").desc(), "category")
    return c.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def representatives(mem: DataFrame, centroids: np.ndarray, n: int = REPRESENTATIVES) -> DataFrame:
    """The n members nearest their cluster centroid (Euclidean), with a
    300-character text.  The centroids (one row per cluster, already on the
    driver) are broadcast within a bound and joined beyond it."""
    spark = mem.sparkSession
    cents = spark.createDataFrame([(int(c), [float(v) for v in row]) for c, row in enumerate(centroids)], "label int, centroid array<double>")
    cents = F.broadcast(cents) if len(centroids) <= MAX_CENTROIDS else cents
    d = F.sqrt(sq_dist_raw("embedding", "centroid"))
    w = Window.partitionBy("cluster").orderBy(F.round("dist", 12), "doc_id")
    return (mem.select("label", "doc_id", "embedding", tx.snippet("text", tx.SNIPPET_REPRESENTATIVE).alias("text")).join(cents, "label")
            .select(F.col("label").alias("cluster"), "doc_id", d.alias("dist"), "text")
            .withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n))


def boundary_documents(mem: DataFrame, n: int = BOUNDARY_DOCS) -> DataFrame:
    """The n highest-entropy members per cluster (ties: lower id), with a
    250-character text and their top-4 memberships."""
    w = Window.partitionBy("cluster").orderBy(F.round("entropy", 12).desc(), "doc_id")
    return (mem.select(F.col("label").alias("cluster"), "doc_id", "entropy", "membership",
                       tx.snippet("text", tx.SNIPPET_BOUNDARY).alias("text"))
            .withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
            .select("cluster", "rank", "doc_id", F.round("entropy", 4).alias("entropy"), "text",
                    top_memberships("membership", 4).alias("membership_distribution")))


def _by_rank(arr):
    return F.array_sort(arr, lambda a, b: (a["rank"] - b["rank"]).cast("int"))


def profiles(mem: DataFrame, centroids: np.ndarray) -> DataFrame:
    """One nested row per non-empty cluster (lists are bounded: 5/5/3)."""
    cats = top_categories(mem).groupBy("cluster").agg(_by_rank(F.collect_list(
        F.struct("rank", "category", "cnt"))).alias("c"))
    reps = representatives(mem, centroids).groupBy("cluster").agg(_by_rank(F.collect_list(
        F.struct("rank", "text"))).alias("r"))
    bnd = boundary_documents(mem).groupBy("cluster").agg(_by_rank(F.collect_list(
        F.struct("rank", "text", "membership_distribution", "entropy"))).alias("b"))
    return (sizes(mem).join(cats, "cluster", "left").join(reps, "cluster", "left").join(bnd, "cluster", "left")
            .select("cluster", "size",
                    F.transform("c", lambda s: F.struct(s["category"].alias("category"), s["cnt"].alias("cnt")))
                    .alias("top_categories"),
                    F.transform("r", lambda s: s["text"]).alias("representative_texts"),
                    F.transform("b", lambda s: F.struct(s["text"].alias("text"),
                                                        s["membership_distribution"].alias("membership_distribution"),
                                                        s["entropy"].alias("entropy"))).alias("boundary_documents")))


def summary(prof: DataFrame) -> DataFrame:
    """The printable summary per cluster, as rows.

    Fixed format: ``Cluster %2d | %4d docs | <last part of category>(<count>), ...``
    and, with a boundary document, ``Boundary example: <cluster>=%.2f / ...``
    and ``Text: <start> …`` on lines of their own."""
    three = F.slice(F.coalesce("top_categories", F.array().cast("array<struct<category:string,cnt:bigint>>")), 1, 3)
    cats = F.array_join(F.transform(three, lambda c: F.concat(
        F.element_at(F.split(F.coalesce(c["category"], F.lit("")), "[.]", -1), -1), F.lit("("), c["cnt"].cast("string"), F.lit(")"))), ", ")
    first = F.get("boundary_documents", 0)
    pairs = F.slice(F.map_entries(first["membership_distribution"]), 1, 2)
    top2 = F.array_join(F.transform(pairs, lambda e: F.concat(e["key"], F.lit("="), tx.fixed_digits(e["value"], 2))), " / ")
    example = F.concat(F.lit("\n  Boundary example: "), top2, F.lit("\n  Text: "),
                       tx.strip_ws(F.substring(first["text"], 1, tx.SNIPPET_SUMMARY)), F.lit(" …"))
    line = F.format_string("Cluster %2d | %4d docs | %s", "cluster", "size", cats)
    return prof.select("cluster", F.concat(line, F.when(first.isNull(), F.lit("")).otherwise(example)).alias("summary"))


def top_terms(mem: DataFrame, n: int = TOP_TERMS, k: int | None = None) -> DataFrame:
    """Characteristic terms per cluster: tf (count in the cluster) times
    idf = ln(K / number of clusters using the term); top n, ties by term."""
    toks = mem.select(F.col("label").alias("cluster"),
                      F.explode(F.filter(F.split(F.lower("text"), TOKEN_SPLIT), lambda t: t != "")).alias("term"))
    tf = toks.groupBy("cluster", "term").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    kk = F.lit(float(k)) if k else F.lit(None)
    j = tf.join(df, "term")
    score = F.col("tf") * F.log(kk / F.col("df"))
    w = Window.partitionBy("cluster").orderBy(F.col("score").desc(), "term")
    return (j.withColumn("score", F.round(score, 9)).withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= n).select("cluster", "rank", "term", "tf", "score"))


def boundary_flags(mem: DataFrame, q: float = BOUNDARY_PERCENTILE) -> DataFrame:
    """Entropy above the q-th percentile (linear interpolation) of all rows."""
    p = exact_quantile(mem, "entropy", q)
    return mem.select("doc_id", "label", "entropy", (F.col("entropy") > F.lit(p)).alias("boundary"),
                      F.lit(p).cast("double").alias("threshold"))


def heatmap(mem_sample: DataFrame, k: int) -> DataFrame:
    """Wide membership matrix C0..C{k-1} (rounded to 4)."""
    return mem_sample.select("doc_id", *[F.round(F.get("membership", i), 4).alias(f"C{i}") for i in range(k)])


def _moments(batches):
    """Count, vector sum and product sums of each batch, as one long row set."""
    for b in batches:
        if b.num_rows:
            flat = b.column(0)
            x = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
            v = np.concatenate([[len(x)], x.sum(0), (x.T @ x).ravel()])
            yield pa.record_batch({"i": pa.array(np.arange(len(v)), pa.int64()), "s": pa.array(v)})


def principal_axes(spark: SparkSession, vectors: DataFrame, steps: int = PROJECTION_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(mean, two axes): a fixed number of power steps on the covariance from
    fixed starts, the second axis kept at a right angle to the first.  The
    covariance is summed on the executors; D x D numbers reach the driver."""
    ship_package(spark)
    rows = vectors.select("embedding").mapInArrow(_moments, "i long, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
    v = np.zeros(len(rows))
    for r in rows:
        v[r["i"]] = r["s"]
    d = int((np.sqrt(4 * len(v) - 3) - 1) / 2) if len(v) else 0
    if not d:
        return np.zeros(0), np.zeros((2, 0))
    mean = v[1:d + 1] / v[0]
    cov = v[d + 1:].reshape(d, d) / v[0] - np.outer(mean, mean)
    axes = []
    for start in (1.0 + np.arange(d) / d, 1.0 - 2 * (np.arange(d) % 2) + np.arange(d) / d):
        w = start / np.sqrt(start @ start)
        for _ in range(steps):
            w = cov @ w
            for a in axes:
                w = w - (w @ a) * a
            w = w / np.sqrt(w @ w) if w @ w > 0 else w
        axes.append(w)
    return mean, np.array(axes)


def projection_2d(spark: SparkSession, mem: DataFrame, fit_on: DataFrame | None = None, steps: int = PROJECTION_STEPS) -> DataFrame:
    """2-D projection on the leading axes; new rows are placed with the same axes."""
    mean, axes = principal_axes(spark, fit_on if fit_on is not None else mem, steps)

    def place(batches):
        for b in batches:
            flat = b.column("embedding")
            x = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
            xy = (x - mean) @ axes.T if len(x) else np.zeros((0, 2))
            yield pa.record_batch({"doc_id": b.column("doc_id"), "label": b.column("label"), "x": pa.array(xy[:, 0]), "y": pa.array(xy[:, 1])})
    return mem.select("doc_id", F.col("label").cast("int").alias("label"), "embedding").mapInArrow(place, "doc_id long, label int, x double, y double")
