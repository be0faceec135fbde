"""The sweeps: shared passes give what separate fits give; stopping, scores and figures by their defining properties."""

import numpy as np
import pytest

from lodestar.functions.vectors import argmax
from lodestar.operators import evaluate, fcm
from lodestar.plans import common, q_eval, registry


@pytest.fixture(scope="module")
def fixture(spark):
    r = np.random.default_rng(11)
    x = np.eye(8)[np.arange(48) % 8] + r.normal(size=(48, 8)) * 0.1
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "doc_id LONG, embedding ARRAY<DOUBLE>")
    return x, df.coalesce(2).cache()


def scores(x, label):
    """Silhouette on squared distances over all pairs, and Davies-Bouldin from its definition."""
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    ks = sorted(set(label))
    s = []
    for i, own in enumerate(label):
        same = [d[i, j] for j in range(len(x)) if label[j] == own and j != i]
        a = np.mean(same) if same else 0.0
        b = min(np.mean(d[i, label == k]) for k in ks if k != own)
        s.append((b - a) / max(a, b) if same else 0.0)
    mean = {k: x[label == k].mean(0) for k in ks}
    spread = {k: np.linalg.norm(x[label == k] - mean[k], axis=1).mean() for k in ks}
    worst = [max((spread[p] + spread[q]) / np.linalg.norm(mean[p] - mean[q]) for q in ks if q != p) for p in ks]
    return np.mean(s), np.mean(worst)


def jobs_of(spark, name, work):
    spark.sparkContext.setJobGroup(name, name)
    out = work()
    spark.sparkContext.setJobGroup("", "")
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_shared_passes_equal_separate_fits(spark, fixture):
    """Models of different K and m stop at different steps; each is what its own fit gives, in fewer jobs altogether."""
    _, df = fixture
    settings = [(2, 2.0), (8, 2.0), (9, 1.3), (5, 3.0)]
    together, shared = jobs_of(spark, "together", lambda: fcm.fit_many(spark, df, settings, max_iter=60, tol=1e-4, checkpoint=False))
    alone, separate = jobs_of(spark, "alone", lambda: [fcm.fit(spark, df, k, m, max_iter=60, tol=1e-4, checkpoint=False) for k, m in settings])
    assert len({model.n_iter for model in together}) > 1
    for a, b in zip(together, alone):
        assert (a.n_iter, a.converged, a.m) == (b.n_iter, b.converged, b.m)
        assert np.allclose(a.centroids, b.centroids, atol=1e-9) and np.allclose(a.loss_history, b.loss_history, rtol=1e-9)
    per_step = separate / sum(model.n_iter + 1 for model in alone)
    assert shared <= per_step * (max(model.n_iter for model in together) + 1) + 1


def test_each_model_stops_by_its_own_history(spark, fixture):
    _, df = fixture
    for model in fcm.fit_many(spark, df, [(3, 2.0), (8, 1.5), (8, 4.0)], max_iter=40, tol=1e-3, checkpoint=False):
        moved = model.delta_history
        assert len(moved) == model.n_iter and all(d >= 1e-3 for d in moved[:-1])
        assert model.converged == (moved[-1] < 1e-3) and (model.converged or model.n_iter == 40)
        assert all(b <= a * (1 + 1e-9) for a, b in zip(model.loss_history, model.loss_history[1:]))


def test_no_rows_and_no_models(spark, fixture):
    _, df = fixture
    assert fcm.fit_many(spark, df, [], checkpoint=False) == []
    with np.errstate(invalid="ignore"):
        empty = fcm.fit_many(spark, df.limit(0), [(2, 2.0)], max_iter=2, checkpoint=False)[0]
    assert empty.centroids.shape == (2, 0)


def test_scores_of_many_models_in_one_pass(spark, fixture):
    x, df = fixture
    models = fcm.fit_many(spark, df, [(2, 2.0), (8, 2.0), (10, 1.5)], max_iter=30, tol=1e-4, checkpoint=False)
    for model, v in zip(models, evaluate.model_scores(spark, df, models)):
        labelled = fcm.predict(spark, model, df, keep=["doc_id", "embedding"]).withColumn("label", argmax("membership"))
        label = np.array([r["label"] for r in labelled.select("doc_id", "label").orderBy("doc_id").collect()])
        assert v == pytest.approx(evaluate.cluster_scores(spark, labelled))
        assert (v["silhouette"], v["davies_bouldin"]) == pytest.approx(scores(x, label), abs=1e-7)


def test_k_sweep_as_shipped(spark, fixture, monkeypatch):
    x, df = fixture
    assert q_eval.SHIPPED_K_GRID == list(range(8, 22)) and q_eval.SHIPPED_TOL == fcm.DEFAULT_TOL and q_eval.SHIPPED_STEPS == 100
    monkeypatch.setattr(common, "corpus_vectors", lambda *_: df)
    got = {r["k"]: r for r in registry.QUERIES["f4_k_sweep_shipped"](spark, "").collect()}
    assert sorted(got) == list(range(8, 22))
    order = sorted(got.values(), key=lambda r: -r["silhouette"])
    assert [r["candidate_rank"] for r in order] == sorted(r["candidate_rank"] for r in order) and order[0]["candidate_rank"] == 1
    for k in (8, 15):
        model = fcm.fit(spark, df, k=k, m=2.0, max_iter=100, checkpoint=False)
        labelled = fcm.predict(spark, model, df, keep=["doc_id", "embedding"]).withColumn("label", argmax("membership"))
        v = evaluate.cluster_scores(spark, labelled)
        assert got[k]["n_iter"] == model.n_iter and got[k]["fcm_loss"] == pytest.approx(model.loss_history[-1], abs=2e-6)
        assert got[k]["silhouette"] == pytest.approx(v["silhouette"], abs=2e-6) and got[k]["db_index"] == pytest.approx(v["davies_bouldin"], abs=2e-6)


def test_fuzziness_sweep_as_shipped(spark, fixture, monkeypatch):
    x, df = fixture
    assert q_eval.SHIPPED_K == fcm.DEFAULT_K and q_eval.SHIPPED_M == fcm.DEFAULT_M
    monkeypatch.setattr(common, "corpus_vectors", lambda *_: df)
    got = {r["m"]: r for r in registry.QUERIES["f5_fuzziness_sweep_shipped"](spark, "").collect()}
    assert sorted(got) == q_eval.M_GRID
    for m in (1.2, 2.0, 4.0):
        model = fcm.fit(spark, df, k=15, m=m, max_iter=100, checkpoint=False)
        u = np.array([r["membership"] for r in fcm.predict(spark, model, df, keep=["doc_id"]).collect()])
        h = -(u * np.log(u + 1e-10)).sum(1).mean()
        assert got[m]["n_iter"] == model.n_iter
        assert got[m]["mean_entropy"] == pytest.approx(h, abs=2e-6) and got[m]["mean_max_membership"] == pytest.approx(u.max(1).mean(), abs=2e-6)
        assert got[m]["pct_ambiguous"] == pytest.approx(((u > 0.3).sum(1) >= 2).mean(), abs=2e-6)
        assert got[m]["entropy_over_ln_k"] == pytest.approx(h / np.log(15), abs=2e-6)
    assert got[1.2]["mean_entropy"] < got[4.0]["mean_entropy"]
