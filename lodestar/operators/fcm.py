"""Fuzzy c-means as one distributed aggregate per iteration.

State is the K x D centroid matrix only.  Memberships are a pure function
of the centroids (u = memb(V)), so they are never stored during the fit:
every iteration streams the (checkpointed) vectors once through an
Arrow-batched numpy step that emits partial sums (sum u^m, sum u^m x,
objective, max |delta u|) as K*D+K+1 long-form rows per task.  A grouped
sum (partial + final aggregation) merges them, and only the K x D result
comes back to the driver, which tests convergence and sends out the next
centroids with the next step.  Any number of fits share the steps' passes.
Shuffle per iteration: tasks * K * D rows, independent of N.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions.vectors import (DIST_FLOOR, argmax, entropy, l2_normalize,
                                        memberships_from_dists, sq_dist)
from lodestar.session import ship_package

# Fixed defaults of the clustering model.
DEFAULT_K = 15
DEFAULT_M = 2.0
DEFAULT_MAX_ITER = 150
DEFAULT_TOL = 1e-4
DEFAULT_SEED = 42
TWO_32 = 4294967296.0


# ----------------------------------------------------------------- E1 init

def init_membership(id_col, k: int, seed: int = DEFAULT_SEED):
    """Row-stochastic start ``u0[c] ∝ (int(md5('seed|id|c')[:8], 16) + 1) / 2^32``.
    Partition-independent and reproducible in SQL."""
    raw = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda c: (
        F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), id_col.cast("string"), c.cast("string"))), 1, 8),
               16, 10).cast("double") + 1.0) / TWO_32)
    s = F.aggregate(raw, F.lit(0.0).cast("double"), lambda a, x: a + x)
    return F.transform(raw, lambda x: x / s)


# ----------------------------------------------------------------- numpy kernels

def _sqdist(x: np.ndarray, v: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] - 2.0 * (x @ v.T) + (v * v).sum(1)[None, :]
    return np.maximum(d, DIST_FLOOR)


def _memb(d: np.ndarray, m: float) -> np.ndarray:
    """Memberships from squared distances, as a softmax of log distances (no overflow for m near 1)."""
    score = np.log(d)
    score /= 1.0 - m
    score -= score.max(axis=1, keepdims=True)
    weight = np.exp(score)
    return weight / weight.sum(axis=1, keepdims=True)


def matrix(column: pa.Array) -> np.ndarray:
    """A batch's vectors as rows of one matrix, from the flat buffer of the Arrow list."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(len(column), -1)


#: Vectors a task multiplies at a time (working arrays then stay in cache).
ROWS = 2048
_PART = "model int, c int, dim int, v double, top double"
#: Places beside the vector's dimensions (0 and up) in a partial sum's row.
DIM_WEIGHT, DIM_LOSS = -1, -2


def _weights(u: np.ndarray, m: float) -> np.ndarray:
    return u * u if m == 2.0 else u ** m


def _step_fn(models: list[tuple], first: bool):
    """Partial sums of one step of every model, each given as (number, K, m, centroids, centroids before).

    All centroids are one matrix, so a batch is multiplied once for all
    models; a task puts out its sums once, after its last batch.
    """
    def run(batches):
        start = [v is None for _, _, _, v, _ in models]
        now = None if all(start) else np.concatenate([v for _, _, _, v, _ in models])
        before = None if first or now is None else np.concatenate([v for _, _, _, _, v in models])
        sums = None
        for batch in batches:
            whole, u0_all = matrix(batch.column("embedding")), matrix(batch.column("u0")) if first else None
            if sums is None and len(whole):
                sums = [[np.zeros((k, whole.shape[1])), np.zeros(k), 0.0, 0.0] for _, k, _, _, _ in models]
            for lo in range(0, len(whole), ROWS):
                x = whole[lo:lo + ROWS]
                d_now = None if now is None else _sqdist(x, now)
                d_before = None if before is None else _sqdist(x, before)
                at = 0
                for (_, k, m, _, _), out in zip(models, sums):
                    if first:
                        u0 = u0_all[lo:lo + ROWS, :k]
                        u0 = u0 / u0.sum(axis=1, keepdims=True)
                    if d_now is None:
                        um = _weights(u0, m)
                    else:
                        d = d_now[:, at:at + k]
                        u = _memb(d, m)
                        um = _weights(u, m)
                        out[2] += float((um * d).sum())
                        out[3] = max(out[3], float(np.abs(u - (u0 if first else _memb(d_before[:, at:at + k], m))).max()))
                    out[0] += um.T @ x
                    out[1] += um.sum(0)
                    at += k
        for (number, k, _, _, _), (wx, w, loss, moved) in zip(models, sums or []):
            dims = wx.shape[1]
            v = np.concatenate([wx.ravel(), w, [loss]])
            yield pa.record_batch({
                "model": pa.array(np.full(len(v), number), pa.int32()),
                "c": pa.array(np.concatenate([np.repeat(np.arange(k), dims), np.arange(k), [0]]), pa.int32()),
                "dim": pa.array(np.concatenate([np.tile(np.arange(dims), k), np.full(k, DIM_WEIGHT), [DIM_LOSS]]), pa.int32()),
                "v": pa.array(v), "top": pa.array(np.append(np.zeros(len(v) - 1), moved))})
    return run


@dataclass
class FcmModel:
    """Fitted model: centroids (K x D) plus the fit record."""
    centroids: np.ndarray
    m: float
    n_iter: int = 0
    loss_history: list = field(default_factory=list)
    delta_history: list = field(default_factory=list)
    converged: bool = False
    max_iter: int = DEFAULT_MAX_ITER
    tol: float = DEFAULT_TOL
    seed: int = DEFAULT_SEED

    @property
    def k(self) -> int:
        return self.centroids.shape[0]

    def centroid_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(int(c), [float(x) for x in self.centroids[c]]) for c in range(self.k)]
        return spark.createDataFrame(rows, "cluster INT, centroid ARRAY<DOUBLE>")

    def history_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, float(l), float(d)) for i, (l, d) in enumerate(zip(self.loss_history, self.delta_history))]
        return spark.createDataFrame(rows, "iter INT, loss DOUBLE, delta DOUBLE")


def fit(spark: SparkSession, vectors: DataFrame, k: int = DEFAULT_K, m: float = DEFAULT_M,
        max_iter: int = DEFAULT_MAX_ITER, tol: float = DEFAULT_TOL, seed: int = DEFAULT_SEED,
        checkpoint: bool = True, init: str = "random") -> FcmModel:
    """Fit on ``vectors(doc_id LONG, embedding ARRAY)``; see ``fit_many``.

    ``init``: ``random`` memberships, or ``centroids`` drawn by k-means||."""
    if init not in ("random", "centroids"):
        raise ValueError(f"init must be random or centroids, not {init}")
    starts = None
    if init == "centroids":
        from lodestar.operators.seeding import start_centroids
        vectors = vectors.select("doc_id", "embedding").checkpoint(eager=True) if checkpoint else vectors
        starts, checkpoint = [start_centroids(spark, vectors, k, seed)], False
    return fit_many(spark, vectors, [(k, m)], max_iter, tol, seed, checkpoint, starts)[0]


def fit_many(spark: SparkSession, vectors: DataFrame, settings: list[tuple[int, float]], max_iter: int = DEFAULT_MAX_ITER,
             tol: float = DEFAULT_TOL, seed: int = DEFAULT_SEED, checkpoint: bool = True, starts: list[np.ndarray] | None = None) -> list[FcmModel]:
    """E6 for several (K, m) at once: a step of all of them is one pass over the vectors.

    The input is written once to the shared checkpoint folder (lineage cut,
    survives executor loss); each step is one job over it, whose partial sums
    are keyed by model.  A model that has stopped takes no part in later
    passes, so a sweep takes as many jobs as its longest fit has steps.  The
    kept centroids are those *before* the last membership update, ``n_iter``
    is the step at which ``max|U - U_old| < tol`` (or ``max_iter``).

    ``starts`` gives each model its first centroids; without it, the raw start of a cluster depends on the seed, the id and the cluster's
    number only, so every K takes a prefix of one array.
    """
    ship_package(spark)
    x = vectors.select("doc_id", "embedding")
    if checkpoint:
        x = x.checkpoint(eager=True)
    widest = max((k for k, _ in settings), default=1)
    started = x.select("embedding", init_membership(F.col("doc_id"), widest, seed).alias("u0"))

    def step(live: list[int], now: dict, before: dict, first: bool) -> dict:
        models = [(i, *settings[i], now.get(i), before.get(i)) for i in live]
        rows = (started if first else x.select("embedding")).mapInArrow(_step_fn(models, first), _PART)
        sums = rows.groupBy("model", "c", "dim").agg(F.sum("v").alias("v"), F.max("top").alias("top")).toArrow()  # K x (D + 1) + 1 rows a model
        number, c, dim, v, top = (sums.column(name).to_numpy() for name in ("model", "c", "dim", "v", "top"))
        out = {}
        for i in live:
            k, own = settings[i][0], number == i
            inside, weight, loss = own & (dim >= 0), own & (dim == DIM_WEIGHT), own & (dim == DIM_LOSS)
            wx, w = np.zeros((k, int(dim[inside].max(initial=-1)) + 1)), np.zeros(k)
            wx[c[inside], dim[inside]] = v[inside]
            w[c[weight]] = v[weight]
            out[i] = (wx / w[:, None], float(v[loss].sum()), float(top[loss].max(initial=0.0)))
        return out

    live = list(range(len(settings)))
    if starts is None:
        after = {i: r[0] for i, r in step(live, {}, {}, True).items()} if live else {}  # the first centroids, from the start alone
    else:
        after = dict(enumerate(starts))
    models = [FcmModel(centroids=after[i], m=settings[i][1], max_iter=max_iter, tol=tol, seed=seed) for i in live]
    before: dict = {}
    for t in range(1, max_iter + 1):
        if not live:
            break
        now = after
        found = step(live, now, before if before else now, t == 1 and starts is None)
        for i in live:
            _, loss, moved = found[i]
            moved = 1.0 if t == 1 and starts is not None else moved  # no memberships before the first
            models[i].loss_history.append(loss)
            models[i].delta_history.append(moved)
            models[i].centroids, models[i].n_iter, models[i].converged = now[i], t, moved < tol
        live = [i for i in live if not models[i].converged]
        before, after = now, {i: found[i][0] for i in live}
    return models


# ----------------------------------------------------------------- E7 predict

def _predict_fn(v: np.ndarray, m: float, keep: list[str]):
    def run(batches):
        for batch in batches:
            x = matrix(batch.column("embedding"))
            u = [_memb(_sqdist(x[lo:lo + ROWS], v), m) for lo in range(0, len(x), ROWS)]
            flat = pa.array(np.concatenate(u).ravel() if u else np.zeros(0))
            rows = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(v), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), rows], names=[*keep, "membership"])
    return run


def predict(spark: SparkSession, model: FcmModel | None, df: DataFrame, k: int = DEFAULT_K,
            keep: list[str] | None = None) -> DataFrame:
    """E7 (+E10): memberships of rows against fitted centroids; without a
    model every row gets the uniform 1/K vector."""
    keep = keep or [c for c in df.columns if c != "embedding"]
    if model is not None and model.n_iter == 0 and not len(model.centroids):
        raise ValueError("the model is not fitted")
    if model is None:
        from lodestar.functions.vectors import uniform_membership
        return df.select(*keep, uniform_membership(k).alias("membership"))
    ship_package(spark)
    schema = T.StructType([df.schema[c] for c in keep] +
                          [T.StructField("membership", T.ArrayType(T.DoubleType()))])
    cols = list(dict.fromkeys(keep + ["embedding"]))
    return df.select(*cols).mapInArrow(_predict_fn(model.centroids, model.m, keep), schema)


def predict_catalyst(model: FcmModel, emb_col="embedding"):
    """E3/E7 stated as a Column: the centroids are inlined as literals, so no
    join is needed (the model is K x D)."""
    lits = [F.array(*[F.lit(float(x)) for x in row]) for row in model.centroids]
    dists = F.array(*[sq_dist(emb_col, c) for c in lits])
    return memberships_from_dists(dists, model.m)


def annotate(df: DataFrame, memb_col: str = "membership") -> DataFrame:
    """Hard label and membership entropy."""
    return df.withColumn("label", argmax(memb_col)).withColumn("entropy", entropy(memb_col))


# ----------------------------------------------------------------- fixed centroids

def centroids_from_labels(vecs: DataFrame, label_col: str) -> DataFrame:
    """``init='centroids'``: the mean vector of each label value as a start
    (or fixed) centroid, ``(cluster, centroid)``, clusters numbered in label
    order.  Aggregated per (label, dim) with partial aggregation."""
    long = vecs.select(F.col(label_col).alias("lab"), F.posexplode("embedding").alias("dim", "x"))
    mean = long.groupBy("lab", "dim").agg(F.avg("x").alias("x"))
    arr = mean.groupBy("lab").agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "x"))),
                                              lambda s: s["x"]).alias("centroid"))
    w = Window.orderBy("lab")
    return arr.select((F.row_number().over(w) - 1).cast("int").alias("cluster"), "centroid")


MAX_CENTROIDS = 4_000  # rows of a centroid table that may be broadcast (4 MB at 128 dimensions)


def sq_dists_long(vecs: DataFrame, cents: DataFrame) -> DataFrame:
    """``(doc_id, cluster, d)`` squared distances floored at 1e-10.

    A centroid table within the bound is packed into one row, which is
    broadcast and unrolled per vector; beyond it vectors meet it in a join on
    hash blocks, so that no task holds the whole table."""
    from lodestar.session import bounded_broadcast
    bounded, ok = bounded_broadcast(cents, MAX_CENTROIDS)
    if ok:
        packed = bounded.agg(F.collect_list(F.struct("cluster", F.col("centroid").alias("c"))).alias("ks")).withColumn("one", F.lit(1))
        pairs = vecs.select("doc_id", "embedding", F.lit(1).alias("one")).join(F.broadcast(packed), "one").select(
            "doc_id", "embedding", F.explode("ks").alias("k"))
        return pairs.select("doc_id", F.col("k.cluster").alias("cluster"), sq_dist("embedding", "k.c").alias("d"))
    blocks = -(-cents.count() // MAX_CENTROIDS)
    split = cents.withColumn("b", F.pmod(F.xxhash64("cluster"), F.lit(blocks)))
    every = vecs.select("doc_id", "embedding", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).cast("long").alias("b"))
    return every.join(split, "b").select("doc_id", "cluster", sq_dist("embedding", "centroid").alias("d"))


def save_model(spark: SparkSession, model: FcmModel, path: str) -> None:
    """Centroids with the fit's parameters and record, one row per cluster."""
    (model.centroid_frame(spark).withColumn("m", F.lit(float(model.m))).withColumn("n_iter", F.lit(int(model.n_iter)))
     .withColumn("max_iter", F.lit(int(model.max_iter))).withColumn("tol", F.lit(float(model.tol))).withColumn("seed", F.lit(int(model.seed)))
     .withColumn("converged", F.lit(bool(model.converged)))
     .withColumn("loss", F.array(*[F.lit(float(x)) for x in model.loss_history]).cast("array<double>"))
     .withColumn("delta", F.array(*[F.lit(float(x)) for x in model.delta_history]).cast("array<double>"))
     .write.mode("overwrite").parquet(path))


def load_model(spark: SparkSession, path: str) -> FcmModel:
    rows = sorted(spark.read.parquet(path).collect(), key=lambda r: r["cluster"])  # K rows
    first = rows[0]
    return FcmModel(centroids=np.array([r["centroid"] for r in rows], dtype=np.float64), m=first["m"], n_iter=first["n_iter"],
                    loss_history=list(first["loss"]), delta_history=list(first["delta"]), converged=first["converged"],
                    max_iter=first["max_iter"], tol=first["tol"], seed=first["seed"])


def model_from_frame(cents: DataFrame, m: float) -> FcmModel:
    rows = sorted(cents.collect(), key=lambda r: r["cluster"])
    return FcmModel(centroids=np.array([r["centroid"] for r in rows], dtype=np.float64), m=m, n_iter=1)
