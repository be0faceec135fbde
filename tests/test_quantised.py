"""Quantised inverted lists: recall against exact search, whole index, hot lists cut into blocks, odd rows."""

import numpy as np
import pytest
from conftest import SF_CHECK
from pyspark.sql import functions as F

from lodestar.operators import quantised as qz
from lodestar.operators import search
from lodestar.plans.catalog import QUERIES


def frame(spark, x, key):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], f"{key} long, embedding array<double>").repartition(3)


@pytest.fixture(scope="module")
def rows(spark):
    """4,000 vectors: half of them copies around one centre (a hot list), the rest around 60 others."""
    r = np.random.default_rng(1)
    centres = r.normal(size=(60, 20))
    own = np.where(r.random(4000) < 0.5, 0, r.integers(1, 60, 4000))
    x = centres[own] + r.normal(size=(4000, 20)) * 0.3
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    q = np.concatenate([centres[:30], x[:20]]) + r.normal(size=(50, 20)) * 0.1
    df = frame(spark, x, "doc_id").cache()
    return x, q, df, qz.build(spark, df)


def exact(x, q, k=5):
    q = q / np.linalg.norm(q, axis=1, keepdims=True)
    return q @ x.T, np.argsort(-(q @ x.T), axis=1, kind="stable")[:, :k]


def test_index_holds_every_row_once(spark, rows):
    x, _, _, index = rows
    got = index.table().collect()
    assert sorted(r["doc_id"] for r in got) == list(range(4000)) and index.n_rows == 4000
    lists, codes = index.quantiser.encode(x)
    assert all(r["list"] == lists[r["doc_id"]] and bytes(r["codes"]) == codes[r["doc_id"]].tobytes() for r in got)


def test_recall_and_exact_scores(spark, rows):
    x, q, _, index = rows
    sims, want = exact(x, q)
    got = qz.search(spark, frame(spark, q, "query_id"), index, k=5, probes=8).collect()
    found = {}
    for r in got:
        assert r["similarity"] == pytest.approx(sims[r["query_id"], r["doc_id"]], abs=1e-9)
        found.setdefault(r["query_id"], {})[r["rank"]] = r["doc_id"]
    assert all(sorted(v) == [1, 2, 3, 4, 5] for v in found.values()) and len(found) == 50
    assert np.mean([len(set(found[i].values()) & set(want[i])) / 5 for i in range(50)]) > 0.95
    assert np.mean([r["n_seen"] / r["n_rows"] for r in got]) < 0.6


def test_blocks_of_a_hot_list_give_the_same(spark, rows):
    """Lists cut into blocks of 100 rows: the same rows, scores and counts of rows looked at."""
    _, q, _, index = rows
    asked = frame(spark, q, "query_id")
    a, b = (sorted(map(tuple, qz.search(spark, asked, index, k=7, probes=4, keep=50, block_rows=n).collect())) for n in (100, 1 << 16))
    assert [r[:3] for r in a] == [r[:3] for r in b] and [r[4:] for r in a] == [r[4:] for r in b]


def test_all_lists_and_all_kept_is_the_exact_search(spark, rows):
    x, q, df, index = rows
    asked = frame(spark, q[:12], "query_id")
    got = qz.search(spark, asked, index, k=5, probes=10**6, keep=4000).select("query_id", "rank", "doc_id").collect()
    want = search.topk(spark, asked, df, 5).select("query_id", "rank", "doc_id").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_few_rows_none_and_zero_vectors(spark):
    few = frame(spark, np.array([[1.0, 0, 0], [0, 1, 0], [0, 0, 0]]), "doc_id")
    index = qz.build(spark, few)
    got = qz.search(spark, frame(spark, np.array([[2.0, 0.1, 0], [0, 0, 0]]), "query_id"), index, k=2).collect()
    assert {(r["query_id"], r["rank"]): r["doc_id"] for r in got if r["query_id"] == 0} == {(0, 1): 0, (0, 2): 1}
    empty = qz.build(spark, few.limit(0))
    assert empty.n_rows == 0 and qz.search(spark, frame(spark, np.eye(3), "query_id"), empty).collect() == []


def test_registered_query_reaches_nine_tenths(spark):
    r = QUERIES["d4_quantised_recall"](spark, SF_CHECK).agg(F.avg("recall_at_5"), F.avg("share_seen"), F.count(F.lit(1))).first()
    assert r[0] >= 0.9 and r[1] < 0.6 and r[2] == 40
