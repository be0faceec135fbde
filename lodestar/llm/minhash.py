"""MinHash near-duplicate links by tensored banding.

A document is the set of its distinct ``k``-word shingles.  Two small hash
collections of ``M`` groups (``R`` minhashes each) are computed; a table
``(i, j)`` has as its key group ``i`` of the first and group ``j`` of the
second collection, so ``2 * M * R`` minhashes give ``M * M`` tables of
``2 * R`` hashes.  At a similarity of 0.8 a pair shares a table with
probability ``(1 - (1 - 0.8 ** R) ** M) ** 2`` = 0.9999 for R = 3, M = 14.

How the tables are joined without pairing up a group:

1. Documents with equal sets are one class; its smallest id stands for it.
2. Only classes that share a group of the first collection with another one
   go on; their full sets are written once to the shared folder.
3. *Star*: in each table bucket every class is compared with the bucket's
   smallest one only, on full sets.  Confirmed links are joined to components.
4. *Rest*: buckets that still hold several components are compared exactly:
   members are dealt into blocks, a task gets one pair of blocks and confirms
   links on full sets; only links that join two parts of the task's block are
   returned, which keeps every component whole.

Minhash agreement is a filter before full sets are intersected: fewer than
``MIN_AGREE`` of the 84 minhashes agree with probability below 1e-5 at a
similarity of 0.8.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.components import connected_components
from lodestar.llm.shared import written
from lodestar.llm.wordhash import mix64, slices, split_words, window_hashes

M, R = 14, 3
N_HASH = 2 * M * R
MIN_AGREE = 50
#: Members of a block in the exact comparison of a bucket.
BLOCK = 256
#: Classes whose (digest, number) rows may be broadcast, about 50 bytes each; beyond it the join shuffles.
MAX_BROADCAST_CLASSES = 500_000
#: Rows of an exact comparison's task, several buckets together.
TASK_ROWS = 2048

_rng = np.random.Generator(np.random.PCG64(84))
_MUL = _rng.integers(1, 2**63, N_HASH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**64, N_HASH, dtype=np.uint64, endpoint=False)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text (fewer than ``k`` words: the whole sequence as one)."""
    out = []
    for at, n in slices(texts):
        words = split_words(texts.slice(at, n))
        h = words.hashes(lower=True)
        for i in range(n):
            own = h[words.first[i]:words.first[i + 1]]
            out.append(np.unique(window_hashes(own, min(k, len(own)), salt=k)) if len(own) else own)
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """``N_HASH`` minhashes per set (all ones for an empty set)."""
    sig = np.full((len(sets), N_HASH), _NONE)
    some = [i for i, s in enumerate(sets) if len(s)]
    run = 0
    while run < len(some):  # runs of sets of bounded total length; a longer set goes through in pieces
        to, total = run, 0
        while to < len(some) and (to == run or total + len(sets[some[to]]) <= 65536):
            total += len(sets[some[to]])
            to += 1
        if to == run + 1:
            s = sets[some[run]]
            for at in range(0, len(s), 65536):
                part = s[at:at + 65536]
                for f in range(N_HASH):
                    z = part * _MUL[f] + _ADD[f]
                    z ^= z >> np.uint64(31)
                    sig[some[run], f] = min(sig[some[run], f], z.min())
        else:
            x = np.concatenate([sets[i] for i in some[run:to]])
            first = np.cumsum([0] + [len(sets[i]) for i in some[run:to - 1]])
            for f in range(N_HASH):
                z = x * _MUL[f] + _ADD[f]
                z ^= z >> np.uint64(31)
                sig[some[run:to], f] = np.minimum.reduceat(z, first)
        run = to
    return sig


def group_keys(sig: np.ndarray) -> np.ndarray:
    """The ``2 * M`` group hashes of each signature; the group's number is part of the hash."""
    g = sig.reshape(len(sig), 2 * M, R)
    key = np.broadcast_to(np.arange(2 * M, dtype=np.uint64), (len(sig), 2 * M))
    for r in range(R):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + g[:, :, r])
    return key.view(np.int64)


def _list(values: np.ndarray) -> pa.Array:
    n, m = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * m + 1, m, dtype=np.int32)), pa.array(values.ravel()))


def _binary(rows) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _digests(sets: list[np.ndarray]) -> pa.Array:
    return pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary())


def _describe(k: int):
    def run(batches):
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            for at in range(0, len(texts), 1024):
                sets = shingle_sets(texts.slice(at, 1024), k)
                sig = signatures(sets)
                keys = group_keys(sig)
                yield pa.record_batch({
                    "doc_id": ids.slice(at, 1024),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "digest": _digests(sets),
                    "a": _list(keys[:, :M].copy()), "b": _list(keys[:, M:].copy()),
                    "sig": _binary((sig & np.uint64(0xFFFF)).astype(np.uint16)),
                })
    return run


def _full_sets(k: int):
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                sets = shingle_sets(part.column(1), k)
                yield pa.record_batch({"digest": _digests(sets), "shingles": _binary(sets)})
    return run


def _ints(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype=np.uint64)


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    lo, hi = sorted((len(x), len(y)))
    if lo * 100 < percent * hi:
        return False
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    same = int((both[1:] == both[:-1]).sum())
    return 100 * same >= percent * (len(x) + len(y) - same)


def _confirm(percent: int):
    def run(batches):
        for b in batches:
            xs, ys = b.column(2), b.column(3)
            ok = [_linked(_ints(xs[i].as_py()), _ints(ys[i].as_py()), percent) for i in range(b.num_rows)]
            yield pa.record_batch({"u": b.column(0), "v": b.column(1)}).filter(pa.array(ok, pa.bool_()))
    return run


def _compare(table: pa.Table, percent: int) -> tuple[list[int], list[int]]:
    """Links between the two blocks of one bucket (or within its one block), as a forest over their components."""
    n = table.num_rows
    within = table.column("p")[0].as_py() == table.column("q")[0].as_py()
    slot = table.column("slot")[0].as_py()
    c, block, size = (table.column(x).to_numpy() for x in ("c", "block", "n_shingles"))
    comp = table.column("component").to_numpy().tolist()
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), dtype=np.uint16).reshape(n, N_HASH)
    a, b = (table.column(x).combine_chunks().flatten().to_numpy().reshape(n, M) for x in ("a", "b"))
    blobs = table.column("shingles")
    parent = {x: x for x in comp}

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    us, vs = [], []
    for i in range(n):
        others = np.arange(i + 1, n) if within else np.flatnonzero(block > block[i])
        lo, hi = np.minimum(size[others], size[i]), np.maximum(size[others], size[i])
        others = others[lo * 100 >= percent * hi]
        others = others[(sig[others] == sig[i]).sum(axis=1) >= MIN_AGREE]
        # a pair that shares a table is compared in the first bucket of the first collection that it shares
        others = others[((a[others] == a[i]).argmax(axis=1) == slot) & (b[others] == b[i]).any(axis=1)]
        for j in others.tolist():
            if root(comp[i]) != root(comp[j]) and _linked(_ints(blobs[i].as_py()), _ints(blobs[j].as_py()), percent):
                parent[root(comp[j])] = root(comp[i])
                us.append(int(c[i]))
                vs.append(int(c[j]))
    return us, vs


def _compare_buckets(percent: int):
    def run(table):
        table = table.sort_by([("key", "ascending"), ("p", "ascending"), ("q", "ascending"), ("c", "ascending")])
        key, p, q = (table.column(x).to_numpy() for x in ("key", "p", "q"))
        new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])])
        us, vs = [], []
        for lo, hi in zip(new, np.r_[new[1:], len(key)]):
            u, v = _compare(table.slice(lo, hi - lo), percent)
            us += u
            vs += v
        return pa.table({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})
    return run


def _merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (c, component) with the components that ``links`` (u, v) connect brought together."""
    ends = (links.join(labels.select(F.col("c").alias("u"), F.col("component").alias("cu")), "u")
            .join(labels.select(F.col("c").alias("v"), F.col("component").alias("cv")), "v"))
    new = connected_components(ends, "cu", "cv").toDF("component", "least")
    return labels.join(new, "component", "left").select("c", F.coalesce("least", "component").alias("component"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``docs``.

    Links documents with ``100 * |A & B| >= percent * |A | B|`` on their
    shingle sets; ``component_id`` is the smallest reachable id.  Null or
    empty texts: no shingles, linked with nothing.  Null ids: linked with
    nothing, ``component_id`` null, kept.  Rows that repeat an id are one
    document with several texts: they share a component.  Only ``doc_id`` and
    ``text`` are read, so other columns may have any name.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    described = written(plain.mapInArrow(_describe(k), "doc_id long, n_shingles long, digest binary, a array<long>, b array<long>, sig binary"),
                         "minhash")
    some = described.filter("doc_id is not null and n_shingles > 0")
    first = some.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"))
    classes = written(first.join(some.select("digest", "doc_id", "n_shingles", "a", "b", "sig").dropDuplicates(["digest", "doc_id"]),
                                  ["digest", "doc_id"]).drop("n")
                       .withColumn("c", F.monotonically_increasing_id()), "minhash-classes")

    groups = classes.select("c", F.explode("a").alias("key")).unionByName(classes.select("c", F.explode("b").alias("key")))
    shared = groups.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    hits = groups.join(shared, "key").groupBy("c").agg(F.collect_list("key").alias("keys"))
    members = written(classes.join(hits, "c").withColumn("sa", F.array_intersect("a", "keys"))
                       .withColumn("sb", F.array_intersect("b", "keys")).drop("keys")
                       .filter((F.size("sa") > 0) & (F.size("sb") > 0)), "minhash-members")
    small = members.count() <= MAX_BROADCAST_CLASSES
    wanted = F.broadcast if small else (lambda x: x)
    sets = written(plain.join(wanted(members.select("doc_id").distinct()), "doc_id", "left_semi")
                    .mapInArrow(_full_sets(k), "digest binary, shingles binary")
                    .join(wanted(members.select("digest", "c")), "digest").select("c", "shingles").dropDuplicates(["c"]), "minhash-sets")

    tables = (members.select("c", "n_shingles", F.explode("sa").alias("ka"), "sb")
              .select("c", "n_shingles", "ka", F.explode("sb").alias("kb"))
              .select("c", "n_shingles", F.xxhash64("ka", "kb").alias("key")))
    heads = (tables.groupBy("key").agg(F.min(F.struct("c", "n_shingles")).alias("head"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").select("key", F.col("head.c").alias("h"), F.col("head.n_shingles").alias("hn")))
    stars = (tables.join(heads, "key").filter("c <> h")
             .filter(F.least("n_shingles", "hn") * 100 >= percent * F.greatest("n_shingles", "hn")).select("c", "h").distinct())
    confirmed = (stars.join(sets.withColumnRenamed("shingles", "x"), "c")
                 .join(sets.select(F.col("c").alias("h"), F.col("shingles").alias("y")), "h")
                 .select("h", "c", "x", "y").mapInArrow(_confirm(percent), "u long, v long"))
    # several texts under one id: their classes belong together
    twice = (some.join(classes.select("digest", "c"), "digest").groupBy("doc_id")
             .agg(F.min("c").alias("u"), F.collect_set("c").alias("cs")).filter(F.size("cs") > 1).select("u", F.explode("cs").alias("v")))
    links = written(confirmed.unionByName(twice), "minhash-links")
    everyone = classes.select("c", F.col("c").alias("component"))
    labels = written(_merge(everyone, links), "minhash-labels")

    units = (members.join(labels, "c").select("c", "component", "a", F.explode("sa").alias("key"))
             .select("c", "component", "key", (F.array_position("a", F.col("key")) - 1).cast("int").alias("slot")))
    open_units = written(units.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("n"))
                          .filter("lo < hi").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"), "n"), "minhash-open")
    rows = open_units.agg(F.sum(F.col("n") * F.col("blocks"))).first()[0] or 0
    if rows:
        tasks = (units.join(open_units.drop("n"), "key")
                 .withColumn("block", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                 .withColumn("p", F.least("block", "other")).withColumn("q", F.greatest("block", "other"))
                 .withColumn("task", F.pmod(F.xxhash64("key", "p", "q"), F.lit(rows // TASK_ROWS + 1)))
                 .select("task", "key", "p", "q", "block", "slot", "c", "component")
                 .join(members.select("c", "n_shingles", "sig", "a", "b"), "c").join(sets, "c"))
        rest = written(tasks.groupBy("task").applyInArrow(_compare_buckets(percent), "u long, v long"), "minhash-rest")
        labels = written(_merge(labels, rest), "minhash-labels")

    least = classes.select("c", "doc_id").join(labels, "c").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_class = classes.select("c", "digest").join(labels, "c").join(least, "component").select("digest", "component_id")
    own = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return (described.select("doc_id", "n_shingles", "digest").join(by_class, "digest", "left")
            .select("doc_id", "n_shingles", own.alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
