"""Sampling, silhouettes, Davies-Bouldin and parameter sweeps.

Cluster means, spreads and the full-data silhouette come from per-batch
partial sums (one row per label and batch, merged by a grouped sum); only one
row per label reaches the driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions.vectors import AMBIGUOUS_U, ENTROPY_EPS
from lodestar.operators import fcm
from lodestar.session import ship_package

# Fixed sizes of the reference's evaluation samples.
SWEEP_SAMPLE = 5000
FUZZ_SAMPLE = 3000
SILHOUETTE_SAMPLE = 2000
HEATMAP_SAMPLE = 60


def sample(df: DataFrame, n: int, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """exactly min(n, rows) rows without replacement, chosen by the
    seeded hash order md5('seed|key') (partition-independent).  Planned as a
    top-n (TakeOrderedAndProject): each task keeps n rows, never a full sort."""
    h = F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def _pairwise_d(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d2 = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * (x @ y.T)
    return np.sqrt(np.maximum(d2, 0.0))


def _silhouette_fn(bc):
    def run(batches):
        ids, mat, lab = bc.value
        ks = np.unique(lab)
        for pdf in batches:
            if len(pdf) == 0:
                continue
            x = np.stack([np.asarray(v, dtype=np.float64) for v in pdf["embedding"]])
            li = pdf["label"].to_numpy()
            di = pdf["doc_id"].to_numpy()
            d = _pairwise_d(x, mat)
            d[di[:, None] == ids[None, :]] = 0.0
            sums = np.stack([d[:, lab == k].sum(1) for k in ks], axis=1)
            cnts = np.array([(lab == k).sum() for k in ks], dtype=np.float64)
            own = np.searchsorted(ks, li)
            n_own = cnts[own]
            a = np.where(n_own > 1, sums[np.arange(len(li)), own] / np.maximum(n_own - 1, 1), 0.0)
            means = sums / cnts[None, :]
            means[np.arange(len(li)), own] = np.inf
            b = means.min(axis=1)
            top = np.maximum(a, b)
            s = np.where((n_own > 1) & (top > 0), (b - a) / np.where(top > 0, top, 1.0), 0.0)
            yield pd.DataFrame({"doc_id": di.astype(np.int64), "s": s})
    return run


def sampled_silhouette(spark: SparkSession, labelled: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """F2 on a sample: mean Euclidean silhouette of the ``n`` rows of
    ``labelled(doc_id, embedding, label)`` that ``sample`` draws; the sample is
    the operator, and bounds what is broadcast.  A singleton cluster scores 0,
    so do coincident rows; fewer than two labels give NULL with a status."""
    ship_package(spark)
    data = sample(labelled.select("doc_id", "embedding", "label"), n, seed).collect()
    n_labels = len({r["label"] for r in data})
    schema = "silhouette DOUBLE, n BIGINT, n_labels BIGINT, status STRING"
    if n_labels < 2:
        return spark.createDataFrame([(None, len(data), n_labels, "fewer than 2 labels")], schema)
    ids = np.array([r["doc_id"] for r in data], dtype=np.int64)
    mat = np.array([r["embedding"] for r in data], dtype=np.float64)
    lab = np.array([r["label"] for r in data])
    bc = spark.sparkContext.broadcast((ids, mat, lab))
    rows = spark.createDataFrame([(r["doc_id"], list(r["embedding"]), r["label"]) for r in data], "doc_id long, embedding array<double>, label int")
    s = rows.repartition(8).mapInPandas(_silhouette_fn(bc), "doc_id LONG, s DOUBLE")
    return s.agg(F.avg("s").alias("silhouette"), F.count(F.lit(1)).alias("n")).select(
        "silhouette", "n", F.lit(n_labels).cast("long").alias("n_labels"), F.lit("ok").alias("status"))


_SUMS = "model int, label int, dim int, s double"


def _given(batch: pa.RecordBatch, x: np.ndarray) -> list[np.ndarray]:
    """The one labelling that a table brings along."""
    return [batch.column("label").to_numpy().astype(np.int64)]


def _fitted(models: list) -> object:
    """One labelling per fitted model: the cluster of the highest membership, the lowest number on a tie."""
    shapes = [(model.centroids, model.m) for model in models]

    def labels(batch: pa.RecordBatch, x: np.ndarray) -> list[np.ndarray]:
        return [fcm._memb(fcm._sqdist(x, v), m).argmax(axis=1) for v, m in shapes]
    return labels


def _long(model: int, labels: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    """One row per (label, column) of ``values``; columns are numbered from 0."""
    k, d = values.shape
    return pa.record_batch({"model": pa.array(np.full(k * d, model), pa.int32()), "label": pa.array(np.repeat(labels, d), pa.int32()),
                            "dim": pa.array(np.tile(np.arange(d), k), pa.int32()), "s": pa.array(values.ravel(), pa.float64())})


def _blocks(batches, labels):
    """Vectors, and their labels in every labelling, some thousand rows at a time."""
    for b in batches:
        x = fcm.matrix(b.column("embedding"))
        for lo in range(0, len(x), fcm.ROWS):
            part = x[lo:lo + fcm.ROWS]
            yield part, labels(b.slice(lo, len(part)), part)


def _sums(labels):
    """Per labelling and label: count, sum of squared norms, vector sum; once per task."""
    def run(batches):
        found: dict = {}
        for x, every in _blocks(batches, labels):
            seen = np.c_[np.ones(len(x)), (x * x).sum(1), x]
            for model, lab in enumerate(every):
                for k in np.unique(lab).tolist():
                    key = (model, k)
                    found[key] = found.get(key, 0.0) + seen[lab == k].sum(0)
        for (model, k), values in found.items():
            yield _long(model, np.array([k]), values[None])
    return run


def _scores(labels, stats: list[tuple]):
    """Per labelling and label: sum of distances to the own mean, sum of squared silhouettes' scores; once per task."""
    def run(batches):
        found = [np.zeros((len(ks), 2)) for ks, _, _, _ in stats]
        for x, every in _blocks(batches, labels):
            r, xx = np.arange(len(x)), (x * x).sum(1)
            for lab, (ks, n, mean, psi), out in zip(every, stats, found):
                if len(ks) < 2:
                    continue
                own = np.searchsorted(ks, lab)
                dot = x @ mean.T
                spread = np.sqrt(np.maximum(xx - 2 * dot[r, own] + (mean[own] ** 2).sum(1), 0.0))
                d = np.maximum(xx[:, None] - 2 * dot + psi[None, :], 0.0)  # mean squared distance to each cluster
                d[d < 1e-12] = 0.0
                a = d[r, own] * n[own] / np.maximum(n[own] - 1, 1)
                d[r, own] = np.inf
                low = d.min(axis=1)
                top = np.maximum(a, low)
                s = np.where((n[own] > 1) & (top > 0), (low - a) / np.where(top > 0, top, 1.0), 0.0)
                out[:, 0] += np.bincount(own, weights=spread, minlength=len(ks))
                out[:, 1] += np.bincount(own, weights=s, minlength=len(ks))
        for model, ((ks, _, _, _), out) in enumerate(zip(stats, found)):
            if len(ks):
                yield _long(model, ks, out)
    return run


def _merged(parts: DataFrame, models: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per labelling, its labels and their sums: one row per labelling, label and column reaches the driver."""
    rows = parts.groupBy("model", "label", "dim").agg(F.sum("s").alias("s")).toArrow()
    model, label, dim, s = (rows.column(c).to_numpy() for c in ("model", "label", "dim", "s"))
    out = []
    for i in range(models):
        own = model == i
        ks, at = np.unique(label[own], return_inverse=True)
        values = np.zeros((len(ks), int(dim[own].max(initial=1)) + 1))
        values[at, dim[own]] = s[own]
        out.append((ks.astype(np.int64), values))
    return out


def _all_scores(rows: DataFrame, labels, models: int) -> list[dict]:
    """Silhouette and Davies-Bouldin of every labelling in two passes over ``rows``."""
    stats = []
    for ks, sums in _merged(rows.mapInArrow(_sums(labels), _SUMS), models):
        n = sums[:, 0]
        stats.append((ks, n, sums[:, 2:] / n[:, None], sums[:, 1] / n))
    scored = _merged(rows.mapInArrow(_scores(labels, stats), _SUMS), models)
    out = []
    for (ks, n, mean, _), (_, scores) in zip(stats, scored):
        v = {"silhouette": None, "davies_bouldin": None, "n": int(n.sum()), "n_labels": len(ks)}
        if len(ks) > 1:
            spread = scores[:, 0] / n
            apart = np.sqrt(((mean[:, None, :] - mean[None, :, :]) ** 2).sum(-1))
            apart[apart < 1e-12] = np.inf
            worst = ((spread[:, None] + spread[None, :]) / apart).max(axis=1)
            v.update(silhouette=float(scores[:, 1].sum() / n.sum()), davies_bouldin=float(worst.mean()))
        out.append(v)
    return out


def cluster_scores(spark: SparkSession, labelled: DataFrame) -> dict:
    """F2/F3 over all rows of ``labelled(embedding, label)`` in two passes.

    ``silhouette``: with squared Euclidean distances, whose mean to a cluster
    follows from its count, mean and mean squared norm; ``davies_bouldin``:
    coincident means count as infinitely far apart.  Both are None for fewer
    than two labels; a singleton cluster and coincident rows score 0.
    """
    ship_package(spark)
    return _all_scores(labelled.select("embedding", F.col("label").cast("int").alias("label")), _given, 1)[0]


def model_scores(spark: SparkSession, vecs: DataFrame, models: list) -> list[dict]:
    """F2/F3 of every fitted model's hard labels over the same vectors, all models in the same two passes."""
    ship_package(spark)
    return _all_scores(vecs.select("embedding"), _fitted(models), len(models))


def _status(v: dict) -> str:
    return "ok" if v["n_labels"] > 1 else "fewer than 2 labels"


def silhouette(spark: SparkSession, labelled: DataFrame) -> DataFrame:
    """F2 over all rows, with squared Euclidean distances."""
    v = cluster_scores(spark, labelled)
    return spark.createDataFrame([(v["silhouette"], v["n"], v["n_labels"], _status(v))],
                                 "silhouette DOUBLE, n BIGINT, n_labels BIGINT, status STRING")


def davies_bouldin(spark: SparkSession, labelled: DataFrame) -> DataFrame:
    """Davies-Bouldin index over hard labels, all rows."""
    v = cluster_scores(spark, labelled)
    return spark.createDataFrame([(v["davies_bouldin"], v["n_labels"], _status(v))], "db_index DOUBLE, n_labels BIGINT, status STRING")


#: Size of the quantile sketch; its ranks err by some 1 / SKETCH, the bracket allows four times that on either side.
SKETCH = 2048


def exact_quantile(df: DataFrame, column: str, q: float, keep: int = 20_000, sketch: int = SKETCH) -> float | None:
    """The ``q``-th quantile of all values (linear interpolation), null for none.

    One pass merges quantile sketches and brackets the value; a second one
    counts what lies below the bracket and the values inside of it, which
    settles the two neighbouring ranks exactly.  With more than ``keep``
    different values inside, or a bracket that missed, the range is narrowed
    by counts in 1,024 equal steps until at most ``keep`` values (or one
    single value) are left; only those are read.
    """
    v = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
    at = lambda p: F.kll_sketch_get_quantile_double("sk", F.lit(float(min(1.0, max(0.0, p)))))
    lo, hi, n, low, high = (v.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("v", sketch).alias("sk"))
                            .select("lo", "hi", "n", *[F.when(F.col("n") > 0, at(q + side * 4 / sketch)) for side in (-1, 1)]).first())
    if not n:
        return None
    rank = q * (n - 1)
    first, second = int(rank), min(int(rank) + 1, n - 1)

    def between(values: dict) -> float:
        return values[first] + (values[second] - values[first]) * (rank - first)

    inside = F.when(F.col("v") >= low, F.col("v"))  # null: below the bracket
    counts = v.where(F.col("v") <= high).groupBy(inside.alias("x")).agg(F.count(F.lit(1)).alias("c")).limit(keep + 2).collect()
    below = sum(r["c"] for r in counts if r["x"] is None)
    found = sorted((r["x"], r["c"]) for r in counts if r["x"] is not None)
    if len(found) <= keep and below <= first and second < below + sum(c for _, c in found):
        return between(_at_ranks(found, below, (first, second)))
    below = 0
    if len(found) > keep:  # a bracket with many values: narrow it further, if it holds both ranks
        less, n_in = v.agg(F.count_if(F.col("v") < low), F.count_if((F.col("v") >= low) & (F.col("v") <= high))).first()
        if less <= first and second < less + n_in:
            lo, hi, below, n = low, high, less, n_in
    while n > keep and lo < hi:
        width = (hi - lo) / 1024
        if not width or lo + width == lo:
            break
        step = F.least(F.floor((F.col("v") - lo) / width), F.lit(1023))
        inside = v.where((F.col("v") >= lo) & (F.col("v") <= hi))
        rows = sorted(inside.groupBy(step.alias("b")).agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect(), key=lambda r: r["b"])
        left, chosen = below, []
        for r in rows:
            if left <= second and left + r["c"] > first:
                chosen.append((left, r))
            left += r["c"]
        new = (chosen[0][1]["lo"], chosen[-1][1]["hi"], sum(r["c"] for _, r in chosen))
        below = chosen[0][0]
        if new == (lo, hi, n):
            break
        lo, hi, n = new
    counts = v.where((F.col("v") >= lo) & (F.col("v") <= hi)).groupBy("v").agg(F.count(F.lit(1)).alias("c")).collect()
    return between(_at_ranks(sorted((r["v"], r["c"]) for r in counts), below, (first, second)))


def _at_ranks(counted: list[tuple[float, int]], below: int, ranks: tuple[int, ...]) -> dict[int, float]:
    """The values at some ranks, from sorted values with their counts that start at rank ``below``."""
    out, left = {}, below
    for value, c in counted:
        out.update({k: value for k in ranks if left <= k < left + c})
        left += c
    return out


def _softness(models: list):
    """Per model: sums of membership entropy, highest membership, ambiguous rows, rows; once per task."""
    def run(batches):
        sums = np.zeros((len(models), 4))
        for x, _ in _blocks(batches, lambda *_: []):
            for model, out in zip(models, sums):
                u = fcm._memb(fcm._sqdist(x, model.centroids), model.m)
                out += [-(u * np.log(u + ENTROPY_EPS)).sum(), u.max(axis=1).sum(), ((u > AMBIGUOUS_U).sum(axis=1) >= 2).sum(), len(u)]
        yield pa.record_batch({"model": pa.array(np.arange(len(models)), pa.int32()),
                               **{c: pa.array(sums[:, i].copy()) for i, c in enumerate(("entropy", "highest", "ambiguous", "n"))}})
    return run


def fuzziness_sweep(spark: SparkSession, vecs: DataFrame, m_values, k: int, max_iter: int, tol: float,
                    seed: int = 42) -> DataFrame:
    """per m: mean entropy, mean max membership, share ambiguous (plus
    entropy / ln K so a collapsed fit is visible).  ``vecs`` should be a
    materialised table: all fits share a pass a step, and one more pass gives
    every model's figures."""
    vecs = vecs.select("doc_id", "embedding")
    models = fcm.fit_many(spark, vecs, [(k, m) for m in m_values], max_iter, tol, seed, checkpoint=False)
    sums = (vecs.select("embedding").mapInArrow(_softness(models), "model int, entropy double, highest double, ambiguous double, n double")
            .groupBy("model").agg(*[F.sum(c).alias(c) for c in ("entropy", "highest", "ambiguous", "n")]))
    about = spark.createDataFrame([(i, float(model.m), model.n_iter) for i, model in enumerate(models)], "model int, m double, n_iter int")
    mean = lambda c: F.try_divide(F.col(c), F.col("n"))
    return about.join(F.broadcast(sums), "model", "left").select(  # one row a model on either side
        "m", mean("entropy").alias("mean_entropy"), mean("highest").alias("mean_max_membership"), mean("ambiguous").alias("pct_ambiguous"),
        (mean("entropy") / F.lit(float(np.log(k)))).alias("entropy_over_ln_k"), "n_iter")


def k_sweep(spark: SparkSession, vecs: DataFrame, k_values, m: float, max_iter: int, tol: float,
            seed: int = 42) -> DataFrame:
    """per K: silhouette and Davies-Bouldin over all rows, final loss;
    ``candidate_rank`` ranks K by silhouette instead of hard-coding one.  All
    fits share a pass a step; two more passes score all of them."""
    vecs = vecs.select("doc_id", "embedding")
    models = fcm.fit_many(spark, vecs, [(k, m) for k in k_values], max_iter, tol, seed, checkpoint=False)
    rows = [(k, v["silhouette"], v["davies_bouldin"], float(model.loss_history[-1]), model.n_iter)
            for k, model, v in zip(k_values, models, model_scores(spark, vecs, models))]
    df = spark.createDataFrame(rows, "k INT, silhouette DOUBLE, db_index DOUBLE, fcm_loss DOUBLE, n_iter INT")
    from pyspark.sql import Window
    return df.withColumn("candidate_rank", F.rank().over(Window.orderBy(F.col("silhouette").desc_nulls_last())))
