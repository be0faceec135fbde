"""Vector algebra (normalise, cosine = dot), the hashed encoder (numpy
helper == native-expression statement) and exact top-k (== brute force,
invariant to partitioning)."""

import numpy as np
from pyspark.sql import functions as F

from lodestar.functions.vectors import dot, l2_norm, l2_normalize
from lodestar.operators import search
from lodestar.operators.encode import hashed_counts, hashed_counts_catalyst, hashed_vector


def unit(seed, dim=384):
    """A non-negative unit vector."""
    v = np.random.default_rng(seed).random(dim)
    return v / np.sqrt(v @ v)


def test_unit_norm_after_normalise(spark):
    df = spark.createDataFrame([([3.0, 4.0, 0.0],), ([0.0, 0.0, 0.0],)], "v ARRAY<DOUBLE>")
    r = df.select(l2_normalize("v").alias("u")).collect()
    assert abs(np.linalg.norm(r[0]["u"]) - 1.0) < 1e-6
    assert np.allclose(r[0]["u"], [0.6, 0.8, 0.0])
    assert r[1]["u"] == [0.0, 0.0, 0.0]          # near-zero vectors unchanged


def test_cosine_equals_dot_and_self_similarity(spark):
    a, b = unit(1), unit(2)
    df = spark.createDataFrame([([float(x) for x in a], [float(x) for x in b])], "a ARRAY<DOUBLE>, b ARRAY<DOUBLE>")
    r = df.select(dot("a", "b").alias("ab"), dot("a", "a").alias("aa")).first()
    cos = float(np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)))
    assert abs(r["ab"] - cos) < 1e-5
    assert abs(r["aa"] - 1.0) < 1e-5


def test_hashed_encoder_numpy_equals_catalyst(spark):
    from tests.conftest import SF_SMALL
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", F.substring("text", 1, 600).alias("t"))
    r = d.select("doc_id", hashed_counts(F.col("t")).alias("a"), hashed_counts_catalyst(F.col("t")).alias("b")).collect()
    assert len(r) > 0
    for row in r:
        assert row["a"] == row["b"]
    u = d.select(l2_norm(hashed_vector(F.col("t"))).alias("n")).collect()
    assert all(abs(x["n"] - 1.0) < 1e-9 or x["n"] == 0.0 for x in u)


def _brute(q, c, k):
    out = {}
    for qi, qv in q.items():
        qv = qv / np.linalg.norm(qv)
        sims = sorted(((float(np.dot(qv, cv)), di) for di, cv in c.items()), key=lambda t: (-round(t[0], 12), t[1]))
        out[qi] = [d for _, d in sims[:k]]
    return out


def test_topk_equals_brute_force_and_partition_invariant(spark):
    rng = np.random.default_rng(7)
    corpus = {i: rng.normal(size=16) for i in range(300)}
    corpus[301] = corpus[5].copy()                 # exact tie with a lower id
    queries = {i: rng.normal(size=16) for i in range(12)}
    queries[99] = corpus[5].copy()
    cdf = spark.createDataFrame([(i, [float(x) for x in v / np.linalg.norm(v)]) for i, v in corpus.items()],
                                "doc_id LONG, embedding ARRAY<DOUBLE>")
    qdf = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in queries.items()],
                                "query_id LONG, embedding ARRAY<DOUBLE>")
    want = _brute(queries, {i: v / np.linalg.norm(v) for i, v in corpus.items()}, 5)
    for parts in (1, 13):
        got = search.topk(spark, qdf, cdf.repartition(parts), 5).collect()
        res = {}
        for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
            res.setdefault(r["query_id"], []).append(r["doc_id"])
        assert res == want
    # chunked query side gives the same answer
    got = search.topk(spark, qdf, cdf, 5, max_query_rows=4).collect()
    res = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        res.setdefault(r["query_id"], []).append(r["doc_id"])
    assert res == want


def test_copies_give_at_most_k_rows_a_batch(spark):
    """10,000 equal rows: each query keeps the k smallest ids, from the stream and from the block join."""
    v = [float(x) for x in unit(3, 8)]
    corpus = spark.range(10_000).select(F.col("id").alias("doc_id"), F.array(*[F.lit(x) for x in v]).alias("embedding")).repartition(5)
    queries = spark.createDataFrame([(i, v) for i in range(3)], "query_id long, embedding array<double>")
    for bound in (20_000, 2):
        got = search.topk(spark, queries, corpus, 5, max_query_rows=bound).collect()
        assert sorted((r["query_id"], r["rank"], r["doc_id"]) for r in got) == [(q, k + 1, k) for q in range(3) for k in range(5)]


def test_block_join_equals_stream(spark):
    r = np.random.default_rng(8)
    rows = [(i, [float(x) for x in r.normal(size=6)], int(r.integers(4))) for i in range(400)]
    corpus = spark.createDataFrame(rows, "doc_id long, embedding array<double>, bucket int")
    queries = spark.createDataFrame([(i, [float(x) for x in r.normal(size=6)], [int(r.integers(4))]) for i in range(30)],
                                    "query_id long, embedding array<double>, probes array<int>")
    for probe in (None, "probes"):
        a, b = (sorted(map(str, search.topk(spark, queries, corpus, 7, probe_col=probe, max_query_rows=n).collect())) for n in (100, 10))
        assert a == b and len(a) == 210


def test_blocks_of_queries_and_rows_meet_without_a_shuffle(spark, monkeypatch):
    """Pairs of blocks are read from written tables; a task keeps k rows a query over all its blocks; copies and ties too."""
    monkeypatch.setattr(search, "BLOCK_ROWS", 16)
    r = np.random.default_rng(9)
    vectors = [[float(x) for x in v] for v in r.normal(size=(60, 4))]
    rows = [(i, vectors[i % 60] if i % 3 else vectors[0], i % 2) for i in range(900)]
    corpus = spark.createDataFrame(rows, "doc_id long, embedding array<double>, bucket int").repartition(4)
    queries = spark.createDataFrame([(i, vectors[i], [i % 3]) for i in range(50)], "query_id long, embedding array<double>, probes array<int>")
    for probe in (None, "probes"):
        scoped = probe is not None
        named = queries.select("query_id", F.col("embedding").alias("vector"), *(["probes"] if scoped else []))
        joined = search._block_join(named, corpus.select("doc_id", "embedding", *(["bucket"] if scoped else [])), 5, scoped)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" in plan and "Exchange" not in plan
        pairs = joined.count()
        got = search.topk(spark, queries, corpus, 5, probe_col=probe, max_query_rows=10).collect()
        want = search.topk(spark, queries, corpus, 5, probe_col=probe).collect()
        key = lambda x: (x["query_id"], x["rank"], x["doc_id"], round(x["similarity"], 10))
        assert sorted(map(key, got)) == sorted(map(key, want)) and len(got) == (170 if scoped else 250)
        left = search._packed(named, 16, True)
        assert pairs <= 50 * 5 * search._packed(corpus.select("doc_id", "embedding"), 16, False).rdd.getNumPartitions() and left.count() >= 4


def test_answer_without_category(spark):
    hits = spark.createDataFrame([(1, 1, 5, 0.5, "text", None)], "query_id long, rank int, doc_id long, similarity double, text string, category string")
    queries = spark.createDataFrame([(1,), (2,)], "query_id long")
    got = dict(search.answer_text(queries, hits).collect())
    assert got == {1: "[Category:  | Similarity: 0.500]\n\ntext", 2: search.NO_RESULT_TEXT}


def test_encoder_holds_a_slice_of_a_batch_at_a_time(monkeypatch):
    """A large batch is hashed in slices of bounded bytes, which give the rows of the whole batch; long, empty and null texts too."""
    import pyarrow as pa

    from lodestar.operators import encode
    texts = ["a b c", None, "", "x" * 700_000, *[f"w{i % 50} \u00e9t\u00e9 " * 500 for i in range(1000)]]
    want, seen, whole = encode._hash_batch(texts, 16, True), [], encode._hash_batch
    monkeypatch.setattr(encode, "ship_package", lambda *a: None)
    monkeypatch.setattr(encode.F, "arrow_udf", lambda kind: lambda f: f)
    monkeypatch.setattr(encode, "_hash_batch", lambda part, *a: seen.append(sum(len(t or "") for t in part)) or whole(part, *a))
    out = encode._encoder_udf(16, True)(pa.array(texts, pa.string()))
    assert max(seen) <= 1 << 20 and np.array_equal(out.flatten().to_numpy().reshape(len(texts), 16), want)
