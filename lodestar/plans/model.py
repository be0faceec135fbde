"""The clustering model shared by the registered queries: fuzzy c-means on
the corpus' hashed vectors with fixed parameters and a fixed step count
(tol = 0), so the DuckDB oracle can unroll the same steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestar.operators import fcm
from lodestar.plans import common

# Fixed parameters of the registered model.
K = 4
M = 1.1
STEPS = 5
SEED = 42

_CACHE: dict = {}


def fitted(spark: SparkSession, sf_dir: str) -> fcm.FcmModel:
    """Fit once per (application, input folder); centroids are K x D."""
    key = (spark.sparkContext.applicationId, sf_dir, common.inputs(spark, sf_dir))
    if key not in _CACHE:
        vecs = common.corpus_vectors(spark, sf_dir).select("doc_id", "embedding")
        _CACHE[key] = fcm.fit(spark, vecs, k=K, m=M, max_iter=STEPS, tol=0.0, seed=SEED, checkpoint=False)
    return _CACHE[key]


def corpus_memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus rows with ``membership``, ``label`` (argmax) and ``entropy``."""
    def build():
        model = fitted(spark, sf_dir)
        v = common.corpus_vectors(spark, sf_dir)
        return fcm.annotate(fcm.predict(spark, model, v, keep=[c for c in v.columns])
                            .withColumnRenamed("label", "category_label"))
    return common.materialized(spark, ("memberships", sf_dir), build, partition_by="label")
