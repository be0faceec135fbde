"""Bounds of dot products, and the block joins of search and cache that use them, against all products."""

import numpy as np
import pyarrow as pa
import pytest

from lodestar.operators import bounds, search, semcache

DIM, THETA = 24, 0.8


def clustered(n, seed, noise=0.3):
    r = np.random.default_rng(seed)
    centres = np.random.default_rng(1).normal(size=(6, DIM))
    x = centres[r.integers(6, size=n)] + noise * r.normal(size=(n, DIM))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("noise", [0.3, 5.0])
def test_bounds_hold_and_rule_out_leaves(noise):
    x, y = clustered(500, 2, noise), clustered(1200, 3, noise)
    y = y[bounds.leaf_order(y, 32)]
    small, other = bounds.single(x), bounds.single(y)
    on = bounds.axes(small)
    u, v = bounds.projected(small, on), bounds.projected(other, on)
    true = x @ y.T
    slack = bounds.wide_margin(DIM)
    assert (u @ v.T >= true - slack).all()
    reach = bounds.Leaves(v, 32).bound(u)
    most = np.maximum.reduceat(true, np.arange(0, len(y), 32), axis=1)
    assert (reach >= most - slack).all()
    if noise < 1:  # leaves of other clusters are not multiplied
        assert (reach >= THETA - slack).mean() < 0.5


def test_leaf_order_keeps_all_rows():
    x = clustered(1000, 4)
    x[5], x[6] = np.nan, 0
    assert sorted(bounds.leaf_order(x, 32)) == list(range(1000))


def blocks(rows, size, make):
    order = bounds.leaf_order(rows, 32)
    return [make(order[at:at + size]) for at in range(0, len(rows), size)]


def batch(columns):
    return pa.record_batch({k: pa.array([v], t) if t else pa.array([v]) for k, (v, t) in columns.items()})


def cache_batches(ids, x, last, eids, y, stored):
    raw = pa.binary()
    for left in blocks(x, 128, lambda i: {"ids": (ids[i].tobytes(), raw), "units": (x[i].tobytes(), raw), "lasts": (last[i].tobytes(), raw),
                                          "asks": (np.ones((len(i), 1), dtype=bool).tobytes(), raw), "probed": ([0], pa.list_(pa.int32()))}):
        for right in blocks(y, 128, lambda i: {"entry_bucket": (0, pa.int32()), "entry_ids": (eids[i].tobytes(), raw), "entry_units": (y[i].tobytes(), raw),
                                               "entry_stored": (np.full(len(i), stored).tobytes(), raw)}):
            yield batch({**left, **right})


def test_cache_kernels_equal_all_products():
    """Near copies, equal rows, zero and missing vectors: every kind of the join gives what all products give."""
    x = clustered(300, 5)
    x[10:40] = x[10]
    x[50], x[51] = 0, np.nan
    ids = np.random.default_rng(6).permutation(len(x)).astype(np.int64)
    last = ids + np.random.default_rng(7).integers(0, 80, len(ids)) * (ids % 3 == 0)
    s = np.nan_to_num(x @ x.T, nan=-1.0)
    near = s >= THETA
    for stored in (True, False):
        got = pa.Table.from_batches(list(semcache._pairs_of_blocks("before", THETA, 32)(cache_batches(ids, x, last, ids, x, stored)))).to_pydict()
        want = near & (ids[None, :] < ids[:, None])
        assert sorted(got["i"]) == sorted(ids[want.any(axis=1)]) and set(got["near"]) == {stored}
    args = (ids, x, last, ids, x, True)
    got = pa.Table.from_batches(list(semcache._pairs_of_blocks("pairs", THETA, 32)(cache_batches(*args)))).to_pydict()
    assert sorted(zip(got["i"], got["j"])) == sorted((ids[a], ids[b]) for a, b in zip(*np.nonzero(near)))
    key = np.round(s, 12)
    for kind in ("best", "runs"):
        got = pa.Table.from_batches(list(semcache._pairs_of_blocks(kind, THETA, 32)(cache_batches(*args)))).to_pydict()
        pairs = set(zip(got["i"], got["j"]))
        for a in range(len(ids)):
            def first(allowed):
                found = [(-key[a, b], ids[b]) for b in np.flatnonzero(near[a] & allowed)]
                return min(found)[1] if found else None
            if kind == "best":
                assert [j for i, j in pairs if i == ids[a]] == [j for j in [first(True)] if j is not None]
            else:  # the best entry before any request of the class is among the rows
                for at in (ids[a], last[a]):
                    best = first((ids < at) & (ids != ids[a]))
                    own = [(-key[a, np.flatnonzero(ids == j)[0]], j) for i, j in pairs if i == ids[a] and j < at and j != ids[a]]
                    assert (min(own)[1] if own else None) == best


@pytest.mark.parametrize("odd", [None, "copies", "long", "missing"])
@pytest.mark.parametrize("floors", [False, True])
def test_search_kernel_equals_all_products(odd, floors):
    """Equal rows, rows of any length and rows without values; with and without a sample of the corpus to start from."""
    q, x = clustered(200, 8), clustered(900, 9)
    if odd == "copies":
        x[:400] = x[0]
    if odd == "long":
        x = x * np.geomspace(1e-3, 1e4, len(x))[:, None]
    if odd == "missing":
        x[3], x[4], x[5] = np.nan, 0, np.inf
    ids = np.random.default_rng(10).permutation(len(x)).astype(np.int64)
    usable = np.isfinite(x).all(axis=1)
    floor = search._floors(q, None, (x[usable][::7], None), 5) if floors else np.full(len(q), -np.inf)
    raw = pa.binary()
    pairs = (batch({**left, **right})
             for left in blocks(q, 64, lambda i: {"ids": (i.astype(np.int64).tobytes(), raw), "units": (q[i].tobytes(), raw), "probes": (b"", raw), "floors": (floor[i].tobytes(), raw)})
             for right in blocks(x, 128, lambda i: {"row_ids": (ids[i].tobytes(), raw), "row_vectors": (x[i].tobytes(), raw), "row_buckets": (b"", raw)}))
    with np.errstate(all="ignore"):
        got = pa.Table.from_batches(list(search._pairs_of_blocks(5, False, 32)(pairs))).to_pydict()
        s = q @ x.T
    s[~np.isfinite(s)] = -np.inf
    key = np.round(s, search.TIE_DIGITS)
    found = {}
    for i, j, sim in sorted(zip(got["query_id"], got["doc_id"], got["similarity"]), key=lambda r: (r[0], -round(r[2], search.TIE_DIGITS), r[1])):
        found.setdefault(i, []).append(j)
    for i in range(len(q)):
        assert found[i] == [ids[j] for j in sorted(range(len(x)), key=lambda j: (-key[i, j], ids[j]))[:5]]
