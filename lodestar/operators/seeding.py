"""E1, ``init='centroids'``: start centroids by k-means|| (oversampling rounds and a weighted reduction).

Each round draws about ``2 k`` rows, a row with a chance in proportion to its
squared distance from the candidates so far.  The chance is compared with a
hash of the seed, the round and the row's id, so the draw does not depend on
partitions.  A round is two passes: the sum of distances, then the drawn rows,
which alone reach the driver.  One more pass counts the rows nearest to each
candidate; the weighted candidates, some ``10 k``, are reduced to ``k`` there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.operators.fcm import ROWS, _sqdist, matrix
from lodestar.session import ship_package

ROUNDS = 5
#: Expected draws of a round, as a multiple of k; steps of the weighted reduction.
OVERSAMPLE = 2.0
REDUCE_STEPS = 25
TWO_32 = 4294967296.0


def _uniform(id_col, *tags):
    """A number in [0, 1) from md5 of the tags and the id."""
    named = F.concat_ws("|", *[F.lit(str(t)) for t in tags], id_col.cast("string"))
    return F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("double") / TWO_32


def _nearest(centres: np.ndarray, kind: str):
    """Per batch: the sum of squared distances, the rows with theirs, or the number of rows nearest to each centre."""
    def run(batches):
        total, counts = 0.0, np.zeros(len(centres))
        for b in batches:
            x = matrix(b.column("embedding"))
            for lo in range(0, len(x), ROWS):
                d = _sqdist(x[lo:lo + ROWS], centres)
                low = d.min(axis=1)
                if kind == "rows":
                    part = b.slice(lo, ROWS)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(low)], names=[*part.schema.names, "d"])
                elif kind == "sum":
                    total += float(low.sum())
                else:
                    counts += np.bincount(d.argmin(axis=1), minlength=len(centres))
        if kind == "sum":
            yield pa.record_batch({"at": pa.array([0], pa.int32()), "v": pa.array([total])})
        elif kind == "counts":
            yield pa.record_batch({"at": pa.array(np.arange(len(centres)), pa.int32()), "v": pa.array(counts)})
    return run


def reduce_weighted(x: np.ndarray, w: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` centres of weighted points: the next start is the point of the largest weighted distance, then weighted means."""
    chosen = [int(w.argmax())]
    while len(chosen) < min(k, len(x)):
        cost = w * _sqdist(x, x[chosen]).min(axis=1)
        cost[chosen] = -1.0
        chosen.append(int(cost.argmax()))
    rng = np.random.default_rng(seed)
    centres = x[chosen + rng.choice(len(x), k - len(chosen)).tolist()].copy()
    for _ in range(REDUCE_STEPS):
        own = _sqdist(x, centres).argmin(axis=1)
        mass = np.bincount(own, weights=w, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x * w[:, None])
        centres = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1e-300)[:, None], centres)
    return centres


def start_centroids(spark: SparkSession, vectors: DataFrame, k: int, seed: int = 42, rounds: int = ROUNDS) -> np.ndarray:
    """(k, D) start centroids for ``vectors(doc_id, embedding)``, a table that is cheap to read again.

    Fewer than ``k`` distinct rows: some centroids coincide.  No rows: (k, 0).
    """
    ship_package(spark)
    rows = vectors.select("doc_id", "embedding")
    first = rows.orderBy(_uniform(F.col("doc_id"), seed, "first"), "doc_id").limit(1).select("embedding").toArrow()
    if not first.num_rows:
        return np.zeros((k, 0))
    found = matrix(first.column(0).combine_chunks())
    schema = T.StructType([*rows.schema.fields, T.StructField("d", T.DoubleType())])
    for r in range(rounds):
        cost = rows.select("embedding").mapInArrow(_nearest(found, "sum"), "at int, v double").agg(F.sum("v")).first()[0] or 0.0
        if cost <= 1e-9 * max(1, len(found)):
            break
        chance = F.lit(OVERSAMPLE * k / float(f"{cost:.9g}")) * F.col("d")  # rounded: sums differ in their last digits between partitionings
        drawn = (rows.mapInArrow(_nearest(found, "rows"), schema).where(_uniform(F.col("doc_id"), seed, r) < chance)
                 .orderBy("doc_id").select("embedding").toArrow())
        if drawn.num_rows:
            found = np.concatenate([found, matrix(drawn.column(0).combine_chunks())])
    counted = rows.select("embedding").mapInArrow(_nearest(found, "counts"), "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    weight = np.zeros(len(found))
    for row in counted:
        weight[row["at"]] = row["v"]
    return reduce_weighted(found, weight, k, seed)
