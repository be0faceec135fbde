import numpy as np
import pytest

from lodestar.llm.forest import Forest, nearest


def frame(spark, rows, clash=False):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<float>").repartition(3)
    return df.selectExpr("*", "1 as shard", "2 as block", "3 as score", "4 as d") if clash else df


def brute(rows, every, k):
    """Nearest by exact inner product of float32 values in double precision; an id's best vector counts."""
    ok = [(i, np.array(v, dtype=np.float32).astype(np.float64)) for i, v in rows
          if i is not None and v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)]
    out = {}
    for i, q in ok:
        if i % every == 0:
            best = out.setdefault(i, {})
            for j, v in ok:
                if j != i and len(v) == len(q):
                    best[j] = max(best.get(j, -np.inf), float(v @ q))
    return {i: sorted(b.items(), key=lambda x: (-x[1], x[0]))[:k] for i, b in out.items()}


def check(df, want, recall=1.0):
    got = {}
    for r in df.collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for i, best in want.items():
        own = sorted(got.get(i, []))
        assert [r for r, _, _ in own] == list(range(1, len(best) + 1))
        assert [(-s, v) for _, v, s in own] == sorted((-s, v) for _, v, s in own)
        hits += len({v for _, v, _ in own} & {v for v, _ in best})
        total += len(best)
    assert set(got) <= set(want) and hits >= recall * total


def test_edges(spark):
    r = np.random.default_rng(1)
    rows = [(i, r.standard_normal(6).tolist()) for i in range(60)]
    rows += [(100, [1, 0, 0, 0, 0, 0]), (101, [1, 0, 0, 0, 0, 0]), (102, [1, 0, 0, 0, 0, 0]), (103, [1, 0, 0, 0, 0, 0]), (120, None), (140, []), (160, [0] * 6),
             (180, [1, None, 0, 0, 0, 0]), (200, [float("nan")] + [1] * 5), (220, [float("inf")] + [1] * 5), (None, [1] * 6), (240, [1, 2, 3]), (241, [3, 2, 1]),
             (40, rows[7][1]), (40, rows[7][1]), (33, rows[8][1]), (300, [9e3] * 6), (301, [-9e3] * 6)]
    check(nearest(frame(spark, rows, clash=True)), brute(rows, 20, 20))
    check(nearest(frame(spark, rows), shard_rows=16, block_queries=2), brute(rows, 20, 20))


def test_empty(spark):
    assert nearest(frame(spark, [(1, [1.0])]).limit(0)).collect() == []
    assert nearest(frame(spark, [(20, [1.0])])).collect() == []


@pytest.mark.parametrize("norms", [False, True])
def test_recall_over_several_shards(spark, norms):
    r = np.random.default_rng(2)
    x = r.standard_normal((6000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[100:900] = x[3]  # a hot vector
    if norms:
        x *= r.uniform(0.5, 2, (6000, 1))
    rows = list(zip(range(6000), x.tolist()))
    want = brute([(i, v) for i, v in rows], 200, 20)
    check(nearest(frame(spark, rows), every=200, shard_rows=1500, block_queries=16), want, recall=0.9)


def test_ascent_keeps_the_longest_prefixes():
    r = np.random.default_rng(3)
    x = r.standard_normal((2000, 16))
    forest = Forest(x, trees=8, bits=16)
    q = x[:50]
    codes = forest.codes(np.c_[q / np.linalg.norm(q, axis=1, keepdims=True), np.zeros(50)])
    rows = np.empty((2000, 8), dtype=np.uint32)
    for t in range(8):
        rows[forest.order[t], t] = forest.sorted[t]
    for i, near in enumerate(forest.candidates(q, 100)):
        depth = next(d for d in range(16, -1, -1) if sum(int((rows[:, t] >> (16 - d) == codes[i, t] >> (16 - d)).sum()) for t in range(8)) >= 100)
        want = np.zeros(2000, dtype=bool)
        for t in range(8):
            want |= rows[:, t] >> (16 - depth) == codes[i, t] >> (16 - depth)
        assert (np.flatnonzero(want) == near).all()
