"""Fuzzy c-means: properties that any fit has, and small cases worked out by hand."""

import numpy as np
import pytest

from lodestar.functions.vectors import argmax, entropy, is_ambiguous, probes_top, top_memberships
from lodestar.operators import fcm


def _data(spark, n, d, seed):
    x = np.random.default_rng(seed).random((n, d))
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)],
                               "doc_id LONG, embedding ARRAY<DOUBLE>")
    return x, df


def _memberships(spark, model, df, n):
    got = {r["doc_id"]: r for r in fcm.annotate(fcm.predict(spark, model, df, keep=["doc_id"])).collect()}
    return np.array([got[i]["membership"] for i in range(n)]), [got[i]["label"] for i in range(n)]


@pytest.mark.parametrize("n,d,k,iters,seed", [(100, 10, 5, 50, 42), (50, 8, 4, 30, 0), (80, 6, 4, 30, 7)])
def test_fit_is_monotone_and_rows_are_stochastic(spark, n, d, k, iters, seed):
    x, df = _data(spark, n, d, seed)
    model = fcm.fit(spark, df, k=k, m=2.0, max_iter=iters, tol=1e-4, seed=42)
    assert 1 <= model.n_iter <= iters and model.converged == (model.delta_history[-1] < 1e-4)
    assert all(b <= a * (1 + 1e-12) for a, b in zip(model.loss_history, model.loss_history[1:]))
    mem, labels = _memberships(spark, model, df, n)
    assert np.allclose(mem.sum(1), 1.0, atol=1e-9) and (mem >= 0).all() and (mem <= 1).all()
    assert labels == list(np.argmax(mem, axis=1))


def test_converged_fit_is_a_stationary_point(spark):
    """Each centroid is the mean of all rows weighted by squared memberships, which in turn follow from distance ratios."""
    x, df = _data(spark, 60, 4, 5)
    model = fcm.fit(spark, df, k=3, m=2.0, max_iter=150, tol=1e-7, seed=42)
    assert model.converged
    mem, _ = _memberships(spark, model, df, 60)
    for c in range(3):
        assert np.allclose(np.average(x, axis=0, weights=mem[:, c] ** 2), model.centroids[c], atol=1e-5)
    near = [sum((x[7] - v) ** 2) for v in model.centroids]
    assert np.allclose(mem[7], [1 / sum(a / b for b in near) for a in near], atol=1e-9)


def test_memberships_by_hand(spark):
    """Centroids 0 and 4 on a line: squared distances 1 and 9 from the point 1."""
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [0.0])], "doc_id long, embedding array<double>")
    at = lambda m: _memberships(spark, fcm.FcmModel(np.array([[0.0], [4.0]]), m, n_iter=1), df, 3)[0]
    assert np.allclose(at(2.0)[:2], [[0.9, 0.1], [0.5, 0.5]])
    assert np.allclose(at(3.0)[0], [0.75, 0.25])
    sharp = at(1.01)  # powers of 100: no overflow
    assert np.isfinite(sharp).all() and sharp[0, 0] == 1.0 and sharp[2, 0] == 1.0


def test_predict_before_fit(spark):
    _, df = _data(spark, 3, 2, 1)
    with pytest.raises(ValueError, match="not fitted"):
        fcm.predict(spark, fcm.FcmModel(np.zeros((0, 2)), 2.0), df)


def test_predict_unseen_rows_sum_to_one(spark):
    _, train = _data(spark, 80, 10, 3)
    _, test = _data(spark, 10, 10, 4)
    model = fcm.fit(spark, train, k=5, m=2.0, max_iter=30, tol=1e-4, seed=3)
    p = np.array([r["membership"] for r in fcm.predict(spark, model, test, keep=["doc_id"]).collect()])
    assert p.shape == (10, 5) and np.allclose(p.sum(1), 1.0, atol=1e-5)
    c = np.array([r["u"] for r in test.select(fcm.predict_catalyst(model).alias("u")).collect()])
    assert np.allclose(np.sort(p, axis=0), np.sort(c, axis=0), atol=1e-9)


def test_membership_expressions(spark):
    u = [0.1, 0.4, 0.4, 0.05, 0.05]
    df = spark.createDataFrame([(u,)], "u ARRAY<DOUBLE>")
    r = df.select(argmax("u").alias("a"), entropy("u").alias("h"), is_ambiguous("u").alias("amb"),
                  probes_top("u", 3).alias("p"), top_memberships("u", 4).alias("t")).first()
    assert r["a"] == 1                               # lowest index on ties
    assert abs(r["h"] + sum(x * np.log(x + 1e-10) for x in u)) < 1e-12
    assert r["amb"] is True
    assert r["p"] == [2, 1, 0]                       # ties: higher index first
    assert r["t"] == {"cluster_2": 0.4, "cluster_1": 0.4, "cluster_0": 0.1, "cluster_4": 0.05}


def test_uniform_membership_without_model(spark):
    _, df = _data(spark, 5, 4, 1)
    p = fcm.predict(spark, None, df, k=15, keep=["doc_id"]).collect()
    assert all(np.allclose(r["membership"], [1 / 15] * 15) for r in p)
