"""Nearest neighbours by inner product with a hash-prefix forest.

The rows are dealt into shards of bounded size.  A shard's index has
``TREES`` trees; a tree is the sorted array of its rows' hash strings
(``BITS`` random hyperplane signs).  A query descends in every tree to its
longest matching prefix; then all trees ascend together, one bit at a time,
until the ranges of rows that share the prefix hold enough entries.  Their
union is scored exactly, in double precision, on the original vectors.

Inner products become angles by one more coordinate that fills every row up
to the largest norm.  Rows are first put in bands whose norms differ by less
than a factor of two, each with its own trees, so that a few long vectors do
not make all others look alike.

Every block of queries meets every shard in a task of its own; shards and
blocks have bounded sizes, so a hot vector or region has no larger group than
any other.  A task returns the best ``k`` rows of a query, and a window with a
group limit merges them.

Recall: rows are hidden from a query only if no tree's range holds them.  For
vectors without any structure (the hardest case: the 20 nearest of 51,282
random 64-D vectors lie at cosines of 0.42 and above) the defaults look at
about 0.4 of the rows for a recall above 0.95; clustered vectors reach deeper
levels and need far fewer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a shard and queries of a block, about.
SHARD_ROWS = 8192
BLOCK_QUERIES = 4096
TREES = 128
BITS = 24
#: A query's ranges hold at least this many entries (repeats counted), as a share of the rows in the trees ...
ENTRIES = 0.5
#: ... and at least this many; fewer rows are all looked at.
LEAST_ENTRIES = 512
SEED = 11


def valid(v: Column) -> Column:
    """Vectors that take part: not null, some component not zero, all of them finite numbers."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


class Forest:
    """The trees over the rows of ``x`` (n, d)."""

    def __init__(self, x: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = SEED):
        n, d = x.shape
        self.n, self.trees, self.bits = n, trees, bits
        planes = np.random.Generator(np.random.PCG64(seed)).standard_normal((d + 1, trees * bits)).astype(np.float32)
        self.planes = planes
        norm2 = (x * x).sum(axis=1)
        fill = np.sqrt(np.maximum(0.0, norm2.max() - norm2)) if n else np.zeros(0)
        self.scale = float(np.sqrt(norm2.max())) if n else 1.0
        codes = self.codes(np.c_[x, fill] / self.scale)
        self.order = np.argsort(codes, axis=0, kind="stable").T.copy()  # (trees, n)
        self.sorted = np.take_along_axis(codes, self.order.T, axis=0).T.copy()

    def codes(self, y: np.ndarray) -> np.ndarray:
        """Hash strings as integers, (rows, trees)."""
        power = (1 << np.arange(self.bits - 1, -1, -1)).astype(np.uint32)
        out = np.empty((len(y), self.trees), dtype=np.uint32)
        y = y.astype(np.float32)
        for a in range(0, len(y), 1024):
            sign = (y[a:a + 1024] @ self.planes) > 0
            out[a:a + 1024] = (sign.reshape(-1, self.trees, self.bits) * power).sum(axis=2, dtype=np.uint32)
        return out

    def candidates(self, q: np.ndarray, entries: int):
        """For every row of ``q``: sorted numbers of the rows met when the trees have ascended far enough."""
        norm = np.sqrt((q * q).sum(axis=1, keepdims=True))
        codes = self.codes(np.c_[q / norm, np.zeros(len(q))])
        lo = np.zeros((len(q), self.trees), dtype=np.int64)
        hi = np.full((len(q), self.trees), self.n, dtype=np.int64)
        done = np.zeros(len(q), dtype=bool)
        # all trees of a query are taken to the same depth: the deepest whose ranges hold enough entries
        for depth in range(1, self.bits + 1):
            shift = np.uint32(self.bits - depth)
            head = codes >> shift << shift
            tail = head | np.uint32((1 << int(shift)) - 1)
            open_ = np.flatnonzero(~done)
            new_lo, new_hi = np.empty((len(open_), self.trees), np.int64), np.empty((len(open_), self.trees), np.int64)
            for t in range(self.trees):
                new_lo[:, t] = np.searchsorted(self.sorted[t], head[open_, t], side="left")
                new_hi[:, t] = np.searchsorted(self.sorted[t], tail[open_, t], side="right")
            enough = (new_hi - new_lo).sum(axis=1) >= entries
            lo[open_[enough]], hi[open_[enough]] = new_lo[enough], new_hi[enough]
            done[open_[~enough]] = True
            if done.all():
                break
        hit, flat = np.zeros(self.n, dtype=bool), self.order.ravel()
        base = np.arange(self.trees) * self.n
        for i in range(len(q)):
            length = hi[i] - lo[i]
            at = np.arange(length.sum()) + np.repeat(base + lo[i] - (np.cumsum(length) - length), length)
            hit[:] = False
            hit[flat[at]] = True
            yield np.flatnonzero(hit)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _banded(x: np.ndarray, q: np.ndarray, entries: float, trees: int, bits: int):
    """Candidates of every query from the trees of all norm bands."""
    band = np.frexp(np.sqrt((x * x).sum(axis=1)))[1]
    parts = []
    for e in np.unique(band):
        own = np.flatnonzero(band == e)
        least = max(LEAST_ENTRIES, int(entries * len(own)))
        parts.append((own, Forest(x[own], trees, bits).candidates(q, least) if len(own) > least else None))
    for _ in range(len(q)):
        yield np.concatenate([own if near is None else own[next(near)] for own, near in parts])


def _search(k: int, entries: float, trees: int, bits: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if rows.num_rows and queries.num_rows:
            ids, x = rows.column("vec_id").to_numpy(), _matrix(rows.column("embedding"))
            order = np.argsort(ids, kind="stable")
            ids, x = ids[order], x[order]
            several = len(np.unique(ids)) < len(ids)
            qids, q = queries.column("vec_id").to_numpy(), _matrix(queries.column("embedding"))
            found: dict[int, list] = {}
            for i, near in enumerate(_banded(x, q, entries, trees, bits)):
                near = near[ids[near] != qids[i]]
                score = x[near] @ q[i]
                own = ids[near]
                if several:  # an id with several vectors: its best
                    best = np.lexsort((-score, own))
                    first = best[np.r_[True, own[best][1:] != own[best][:-1]]] if len(best) else best
                    own, score = own[first], score[first]
                if len(own) > k:
                    least = np.partition(score, len(score) - k)[len(score) - k]
                    keep = score >= least
                    own, score = own[keep], score[keep]
                found.setdefault(int(qids[i]), []).append((own, score))
            for qid, lists in found.items():
                own, score = np.concatenate([a for a, _ in lists]), np.concatenate([b for _, b in lists])
                at = np.lexsort((own, -score))
                if len(lists) > 1:  # so is a query's
                    _, once = np.unique(own[at], return_index=True)
                    at = at[np.sort(once)]
                at = at[:k]
                out_q.append(np.full(len(at), qid))
                out_v.append(own[at])
                out_s.append(score[at])
        cat = lambda a, t: pa.array(np.concatenate(a) if a else [], t)
        return pa.table({"query_id": cat(out_q, pa.int64()), "vec_id": cat(out_v, pa.int64()), "score": cat(out_s, pa.float64())})
    return run


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES,
            trees: int = TREES, bits: int = BITS, entries: float = ENTRIES) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows found for every row whose id is divisible by ``every``.

    Nearest first, ties to the smaller id; all other rows if there are fewer.
    Null ids and vectors that are null, empty, zero or hold a null or
    non-finite component take no part.  Vectors are compared with those of
    the same length.  An id with several vectors asks with, and is found by,
    its best one; fully equal rows so count once.  Only ``vec_id`` and
    ``embedding`` are read.
    """
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("embedding"))
            .filter(F.col("vec_id").isNotNull() & valid(F.col("embedding"))).withColumn("d", F.size("embedding")))
    is_query = F.col("vec_id") % every == 0
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-n_queries // block_queries))
    each = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    data = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")).withColumn("block", each(blocks))
    asked = (rows.filter(is_query).withColumn("block", F.pmod(F.xxhash64(F.lit(SEED), "vec_id"), F.lit(blocks)).cast("int"))
             .withColumn("shard", each(shards)))
    found = (data.groupBy("shard", "block", "d").cogroup(asked.groupBy("shard", "block", "d"))
             .applyInArrow(_search(k, entries, trees, bits), "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
