"""k-means|| starts: one per group, the same for any partitioning, an objective no worse than from random memberships."""

import numpy as np
import pytest

from lodestar.operators import fcm
from lodestar.operators.seeding import reduce_weighted, start_centroids


def frame(spark, x, parts=3):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "doc_id long, embedding array<double>").repartition(parts)


@pytest.fixture(scope="module")
def groups():
    r = np.random.default_rng(2)
    centres = r.normal(size=(6, 8)) * 4
    return centres, centres[np.arange(300) % 6] + r.normal(size=(300, 8)) * 0.2


def test_one_start_in_each_group(spark, groups):
    centres, x = groups
    starts = start_centroids(spark, frame(spark, x), 6)
    near = ((starts[:, None] - centres[None]) ** 2).sum(-1)
    assert sorted(near.argmin(axis=1)) == list(range(6)) and near.min(axis=1).max() < 0.5


def test_partitions_have_no_say_but_the_seed_has(spark, groups):
    _, x = groups
    a, b = (start_centroids(spark, frame(spark, x, parts), 4, seed=7) for parts in (1, 7))
    assert np.allclose(a, b, atol=1e-9)
    assert not np.allclose(a, start_centroids(spark, frame(spark, x), 4, seed=8), atol=1e-9)


def test_objective_is_no_worse_than_from_random_memberships(spark, groups):
    _, x = groups
    df = frame(spark, x).cache()
    for k, m in ((6, 1.2), (4, 2.0)):
        plain, seeded = (fcm.fit(spark, df, k=k, m=m, max_iter=60, init=init, checkpoint=False) for init in ("random", "centroids"))
        assert seeded.loss_history[-1] <= plain.loss_history[-1] * (1 + 1e-6) and seeded.loss_history[0] <= plain.loss_history[0]
        assert seeded.n_iter <= plain.n_iter and seeded.delta_history[0] == 1.0


def test_few_distinct_rows_none_and_unknown_init(spark):
    same = frame(spark, np.ones((5, 3)))
    assert np.allclose(start_centroids(spark, same, 3), 1.0)
    assert start_centroids(spark, same.limit(0), 3).shape == (3, 0)
    with pytest.raises(ValueError, match="init"):
        fcm.fit(spark, same, k=2, init="other")


def test_weighted_reduction_by_hand():
    """Heavy points at 0 and 10, a light one at 4: it joins the nearer one, which moves by its share."""
    out = reduce_weighted(np.array([[0.0], [10.0], [4.0]]), np.array([9.0, 10.0, 1.0]), 2, 1)
    assert sorted(out[:, 0].tolist()) == [pytest.approx(0.4), 10.0]
