"""Sources and sinks: scans with explicit schemas, splits, the vector table
written and reloaded (parquet / JSON / partitioned by bucket), a missing
table reported as None, and a fitted model saved as a centroid table."""

import numpy as np
from pyspark.sql import functions as F

from lodestar.operators import fcm
from lodestar.plans import common
from lodestar.session import scratch_path
from lodestar.sources import tables as tb
from tests.conftest import SF_SMALL


def test_scan_splits_partition_the_corpus(spark):
    alls = tb.scan_corpus(spark, SF_SMALL)
    n = alls.count()
    tr = tb.scan_corpus(spark, SF_SMALL, "train").count()
    te = tb.scan_corpus(spark, SF_SMALL, "test").count()
    assert n == tr + te and te > 0
    assert set(alls.columns) >= {"doc_id", "text", "label", "category", "split"}


def test_vector_table_round_trip(spark):
    c = common.corpus_vectors(spark, SF_SMALL)
    vt = tb.vector_table(c.drop("embedding"), c.select("doc_id", "embedding"))
    path = scratch_path(spark, "vt")
    tb.write_table(vt.withColumn("bucket", F.col("label") % 3), path, partition_by="bucket")
    back = tb.load_table(spark, path)
    assert back.count() == vt.count()
    assert back.where(F.length("text") > 500).count() == 0           # stored text is the snippet
    a = {r["doc_id"]: r["embedding"] for r in vt.select("doc_id", "embedding").collect()}
    b = {r["doc_id"]: r["embedding"] for r in back.select("doc_id", "embedding").collect()}
    assert a == b
    # partition pruning on the bucket column
    plan = back.where("bucket = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan


def test_missing_table_is_none(spark):
    assert tb.load_table(spark, scratch_path(spark, "missing")) is None


def test_json_sink_and_model_table(spark):
    x = np.random.default_rng(0).random((40, 5))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "doc_id LONG, embedding ARRAY<DOUBLE>")
    model = fcm.fit(spark, df, k=3, m=2.0, max_iter=10, tol=1e-4, seed=1)
    path = scratch_path(spark, "model")
    fcm.save_model(spark, model, path)
    reloaded = fcm.load_model(spark, path)
    assert np.array_equal(reloaded.centroids, model.centroids)
    assert (reloaded.m, reloaded.n_iter, reloaded.converged, reloaded.loss_history) == (model.m, model.n_iter, model.converged, model.loss_history)
    jpath = scratch_path(spark, "hist")
    tb.write_json(model.history_frame(spark), jpath)
    assert spark.read.json(jpath).count() == len(model.loss_history)


def test_filters_reach_the_vector_scan(spark):
    """Searches by cluster read only the probed partitions; the metadata filter is pushed into the scan."""
    from lodestar.plans.catalog import QUERIES
    plan = lambda q: QUERIES[q](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [label" in plan("d3_cluster_topk") and "PushedFilters: [In(category" in plan("d2_filtered_topk")


def test_documents_without_a_category_stay(spark, tmp_path):
    rows = [(1, "a", "en", None, 1), (2, "b", "en", "s", 1)]
    spark.createDataFrame(rows, tb.DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["label"], r["category"]) for r in tb.scan_corpus(spark, str(tmp_path)).collect()}
    assert got == {1: (None, None), 2: (0, "s")}


def test_scores_of_coincident_rows(spark):
    from lodestar.operators import evaluate as ev
    same = spark.createDataFrame([(i, [1.0, 0.0], i % 2) for i in range(6)], "doc_id long, embedding array<double>, label int")
    v = ev.cluster_scores(spark, same)
    assert (v["silhouette"], v["davies_bouldin"], v["n"]) == (0.0, 0.0, 6)
    assert ev.sampled_silhouette(spark, same, 100).first()["silhouette"] == 0.0
    line = spark.createDataFrame([(i, [float(x)], k) for i, (x, k) in enumerate([(0, 0), (2, 0), (10, 1), (12, 1)])], "doc_id long, embedding array<double>, label int")
    v = ev.cluster_scores(spark, line)
    # own mean squared distance 4; other cluster: (100 + 144) / 2 and (64 + 100) / 2
    assert abs(v["silhouette"] - ((122 - 4) / 122 + (82 - 4) / 82) / 2) < 1e-12 and abs(v["davies_bouldin"] - 0.2) < 1e-12


def test_exact_quantile(spark):
    from lodestar.operators.evaluate import exact_quantile
    r = np.random.default_rng(4)
    for x in (r.random(5000), r.integers(0, 5, 3000).astype(float), np.ones(50), np.r_[r.random(3000) * 1e-9, 1e6]):
        df = spark.createDataFrame([(float(v),) for v in x], "v double")
        for q in (0.0, 0.3, 0.85, 1.0):
            assert abs(exact_quantile(df, "v", q, keep=40) - np.quantile(x, q)) <= 1e-12 * max(1, abs(x).max())
    assert exact_quantile(df.limit(0), "v", 0.5) is None


def test_quantile_in_two_scans(spark):
    """The bracket of a sketch settles the ranks; a coarse sketch, or few values allowed, narrows and gives the same."""
    from lodestar.operators.evaluate import exact_quantile
    r = np.random.default_rng(7)
    x = np.concatenate([r.normal(size=20_000), np.full(3000, 0.5), [1e9, -1e9]])
    df = spark.createDataFrame([(float(v),) for v in x], "v double").repartition(4).cache()
    df.count()
    for q in (0.0, 0.5, 0.85, 0.999, 1.0):
        spark.sparkContext.setJobGroup(f"quantile-{q}", "two scans")
        got = exact_quantile(df, "v", q)
        spark.sparkContext.setJobGroup("", "")
        assert abs(got - np.quantile(x, q)) <= 1e-12 * max(1.0, abs(got))
        assert exact_quantile(df, "v", q, keep=50, sketch=16) == got
