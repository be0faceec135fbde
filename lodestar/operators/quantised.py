"""Approximate top-k over quantised inverted lists.

*Fit.*  Coarse centres (the lists) and one codebook per group of dimensions
are k-means centres of a sample of at most ``SAMPLE`` rows, drawn by seeded
hash order; only the sample reaches the driver.  *Index.*  Every row goes to
the list of its nearest centre with one byte per group: the number of the
nearest codeword of its residual there.  The index is a written table of ids,
lists and codes; vectors stay where they are.  *Search.*  A query meets the
codes of its ``probes`` nearest lists in tasks of one block of a list each, so
a list that holds a third of all rows has more tasks, not a larger one; inner
products come from a table of 256 sums per group.  The ``keep`` best rows by
code are joined to their vectors and ranked exactly.

A row looked at costs one byte per group instead of a vector; what moves is
ids and codes, and vectors of ``keep`` rows per query.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.functions.vectors import dot
from lodestar.operators.evaluate import sample
from lodestar.operators.fcm import ROWS, matrix
from lodestar.operators.search import TIE_DIGITS
from lodestar.session import bounded_broadcast, scratch_path, ship_package

#: Rows that centres and codebooks are fitted on, and steps of each k-means.
SAMPLE = 20_000
STEPS = 12
#: Lists for n rows: the next power of two from LISTS_PER_ROOT * sqrt(n) on, within the bounds (the sample gives no more centres).
LISTS_PER_ROOT, MIN_LISTS, MAX_LISTS = 1.3, 8, 2048
CODEWORDS = 256
GROUP_DIMS = 8
#: Codes of a block; a list is cut into blocks of about this many rows.
BLOCK_ROWS = 65_536
PROBES, KEEP = 24, 200
#: Rows (two ids each) of the queries' best by code that may be broadcast.
MAX_BEST_BROADCAST = 500_000


@dataclass
class Quantiser:
    """``centres``: (lists, D) unit vectors; ``words``: (groups, CODEWORDS, dims of a group)."""
    centres: np.ndarray
    words: np.ndarray

    @property
    def dims(self) -> int:
        return self.words.shape[2]

    def nearest_lists(self, x: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` lists of the largest inner product per row, nearest first (ties: lower number)."""
        return np.argsort(-(x @ self.centres.T), axis=1, kind="stable")[:, :n]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """List and codes of every row."""
        own = self.nearest_lists(x, 1)[:, 0] if len(x) else np.zeros(0, np.int64)
        rest = self._padded(x - self.centres[own])
        codes = [_closest(part, words) for part, words in zip(np.split(rest, len(self.words), axis=1), self.words)]
        return own, np.stack(codes, axis=1).astype(np.uint8)

    def tables(self, q: np.ndarray) -> np.ndarray:
        """(queries, groups, CODEWORDS) inner products of each query with all codewords."""
        parts = np.split(self._padded(q), len(self.words), axis=1)
        return np.stack([part @ words.T for part, words in zip(parts, self.words)], axis=1)

    def _padded(self, x: np.ndarray) -> np.ndarray:
        return np.pad(x, ((0, 0), (0, len(self.words) * self.dims - x.shape[1])))


def _closest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(1)[None, :] - 2.0 * (x @ centres.T)).argmin(axis=1)


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return np.where(n > 1e-10, x / np.where(n > 1e-10, n, 1.0), x)


def _means(x: np.ndarray, k: int, rng: np.random.Generator, unit: bool) -> np.ndarray:
    """``k`` k-means centres of the sample (unit length if asked); a centre that loses all rows takes a random one."""
    centres = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(STEPS):
        own = (x @ centres.T).argmax(axis=1) if unit else _closest(x, centres)
        n = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], x[rng.choice(len(x), k)])
        if unit:
            centres = _unit(centres)
    return centres


def fit(vectors: DataFrame, n_rows: int, seed: int = 42) -> Quantiser:
    """Centres and codebooks from a bounded sample of ``vectors(doc_id, embedding)``."""
    rows = sample(vectors.select("doc_id", "embedding"), SAMPLE, seed).select("embedding").toArrow().column(0).combine_chunks()
    x = _unit(matrix(rows)) if len(rows) else np.zeros((1, 1))
    rng = np.random.default_rng(seed)
    lists = 2 ** int(np.ceil(np.log2(max(1.0, LISTS_PER_ROOT * np.sqrt(max(n_rows, 1))))))
    centres = _means(x, int(min(max(lists, MIN_LISTS), MAX_LISTS, len(x))), rng, True)
    rest = x - centres[(x @ centres.T).argmax(axis=1)]
    groups = -(-x.shape[1] // GROUP_DIMS)
    rest = np.pad(rest, ((0, 0), (0, groups * GROUP_DIMS - x.shape[1])))
    words = [_means(part, CODEWORDS, rng, False) for part in np.split(rest, groups, axis=1)]
    return Quantiser(centres, np.stack(words))


def _encode(quantiser: Quantiser):
    def run(batches):
        for b in batches:
            x = _unit(matrix(b.column("embedding"))) if b.num_rows else None
            for lo in range(0, b.num_rows, ROWS):
                own, codes = quantiser.encode(x[lo:lo + ROWS])
                yield pa.record_batch({"doc_id": b.column("doc_id").slice(lo, ROWS), "list": pa.array(own, pa.int32()),
                                       "codes": pa.array([c.tobytes() for c in codes], pa.binary())})
    return run


class Index:
    """A written table of ``(doc_id, codes)`` partitioned by ``list`` over all rows of ``vectors``; ``sizes``: rows per list."""

    def __init__(self, quantiser: Quantiser, path: str, vectors: DataFrame):
        self.quantiser, self.path, self.vectors = quantiser, path, vectors
        counts = self.table().groupBy("list").count().collect()  # one row a list
        self.sizes = {r["list"]: r["count"] for r in counts}

    @property
    def n_rows(self) -> int:
        return sum(self.sizes.values())

    def table(self) -> DataFrame:
        return self.vectors.sparkSession.read.schema("doc_id long, codes binary, list int").parquet(self.path)


def build(spark: SparkSession, vectors: DataFrame, seed: int = 42) -> Index:
    """Fit on a sample, encode every row of ``vectors(doc_id, embedding)``, write the lists."""
    ship_package(spark)
    n_rows = vectors.count()
    quantiser = fit(vectors, n_rows, seed)
    coded = vectors.select("doc_id", "embedding").mapInArrow(_encode(quantiser), "doc_id long, list int, codes binary")
    parts = 1 + 4 * n_rows // (BLOCK_ROWS * len(quantiser.centres))  # writers of a list, so that a large one has several
    path = scratch_path(spark, "lists")
    coded.repartition("list", F.pmod(F.xxhash64("doc_id"), F.lit(parts))).write.partitionBy("list").parquet(path)
    return Index(quantiser, path, vectors)


def _scan(quantiser: Quantiser, keep: int):
    """Each query's ``keep`` best rows of one block by code, and how many rows it looked at."""
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        empty = {"query_id": pa.array([], pa.int64()), "doc_id": pa.array([], pa.int64()), "near": pa.array([], pa.float64()), "seen": pa.array([], pa.int64())}
        if not queries.num_rows or not rows.num_rows:
            return pa.table(empty)
        ids = rows.column("doc_id").to_numpy()
        by = np.argsort(ids, kind="stable")
        groups = len(quantiser.words)
        codes = np.frombuffer(b"".join(rows.column("codes").to_pylist()), dtype=np.uint8).reshape(-1, groups)[by]
        ids, centre = ids[by], quantiser.centres[rows.column("list")[0].as_py()]
        q = _unit(matrix(queries.column("vector").combine_chunks()))
        out = []
        for qid, base, table in zip(queries.column("query_id").to_numpy(), q @ centre, quantiser.tables(q)):
            near = base + table[np.arange(groups)[:, None], codes.T].sum(axis=0)
            top = np.argpartition(-near, keep - 1)[:keep] if len(near) > keep else np.arange(len(near))
            out.append((np.full(len(top), qid), ids[top], near[top], np.append(len(ids), np.zeros(len(top) - 1, np.int64))))
        return pa.table({name: pa.array(np.concatenate(v)) for name, v in zip(empty, zip(*out))})
    return run


def search(spark: SparkSession, queries: DataFrame, index: Index, k: int = 5, probes: int = PROBES, keep: int = KEEP,
           block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(query_id, rank, doc_id, similarity, n_seen, n_rows)``: the ``k`` nearest found, exactly scored and ranked.

    ``queries(query_id, embedding)``; a query may be near in its
    ``probes`` nearest lists only.  ``n_seen``: rows whose codes it looked at.
    """
    ship_package(spark)
    if not index.sizes:
        return spark.createDataFrame([], "query_id long, rank int, doc_id long, similarity double, n_seen long, n_rows long")
    quantiser = index.quantiser
    probes = min(probes, len(quantiser.centres))

    def probe(batches):
        for b in batches:
            if b.num_rows:
                lists = quantiser.nearest_lists(_unit(matrix(b.column("embedding"))), probes)
                at = pa.array(np.repeat(np.arange(b.num_rows), probes))
                yield pa.record_batch({"query_id": b.column("query_id").take(at), "vector": b.column("embedding").take(at),
                                       "list": pa.array(lists.ravel(), pa.int32())})

    asked = queries.select(F.col("query_id").cast("long").alias("query_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    routed = asked.mapInArrow(probe, "query_id long, vector array<double>, list int")
    blocks = {at: -(-n // block_rows) for at, n in index.sizes.items()}
    size = spark.createDataFrame(list(blocks.items()), "list int, blocks int")
    wanted = [r["list"] for r in routed.select("list").distinct().collect()]  # lists only: partitions beyond them are not read
    rows = (index.table().where(F.col("list").isin(wanted)).join(F.broadcast(size), "list")
            .select("list", F.pmod(F.xxhash64("doc_id"), "blocks").cast("int").alias("block"), "doc_id", "codes"))
    of = size.select(F.col("list").alias("of"), F.sequence(F.lit(0), F.col("blocks") - 1).alias("every"))
    routed = (routed.join(F.broadcast(of), F.col("list") == F.col("of"))
              .select("query_id", "vector", F.col("list").alias("asked"), F.explode("every").alias("part")))
    found = _written(routed.groupBy("asked", "part").cogroup(rows.groupBy("list", "block"))
                     .applyInArrow(_scan(quantiser, keep), "query_id long, doc_id long, near double, seen long"), "list-candidates")
    by_code = Window.partitionBy("query_id").orderBy(F.desc("near"), "doc_id")
    seen = found.groupBy("query_id").agg(F.sum("seen").alias("n_seen"))
    best = _written(found.withColumn("r", F.row_number().over(by_code)).where(F.col("r") <= keep).select("query_id", "doc_id"), "list-best")
    named = asked.withColumnRenamed("embedding", "q")
    exact = (index.vectors.select("doc_id", "embedding").join(bounded_broadcast(best, MAX_BEST_BROADCAST)[0], "doc_id").join(named, "query_id")
             .select("query_id", "doc_id", (dot("embedding", "q") / F.sqrt(F.greatest(dot("q", "q"), F.lit(1e-20)))).alias("similarity")))
    ranked = Window.partitionBy("query_id").orderBy(F.round("similarity", TIE_DIGITS).desc(), "doc_id")
    return (exact.withColumn("rank", F.row_number().over(ranked).cast("int")).where(F.col("rank") <= k).join(seen, "query_id")
            .select("query_id", "rank", "doc_id", "similarity", "n_seen", F.lit(index.n_rows).alias("n_rows")))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
