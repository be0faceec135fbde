"""Registered queries for clustering (E) and model-based search
plus plain search (D1, D2, D5, D6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions import vectors as vx
from lodestar.operators import fcm, quantised, search
from lodestar.plans import common, model
from lodestar.plans import sqlfrag as S
from lodestar.plans.registry import query
from lodestar.session import scratch_path
from lodestar.sources import tables as tb

K, M, ST, SEED = model.K, model.M, model.STEPS, model.SEED
BASE = "WITH " + S.CORPUS + ",\n" + S.hashed_long("corpus", "doc_id", "text") + ",\n" + S.fcm_ctes(ST, K, M, SEED)
BENCH_HV = S.hashed_long("benchmark", "item_id", "text", name="bq")
BENCH_U = S.membership_of("benchmark", "bq", f"v{ST}", M, key="item_id")


def _long(df, key, col, name, digits):
    return df.select(key, F.posexplode(col).alias("cluster", name)).select(
        key, F.col("cluster").cast("int").alias("cluster"), F.round(name, digits).alias(name))


# ---------------------------------------------------------------- E: clustering

@query("e1_init_membership", BASE + "\nSELECT doc_id, k AS cluster, round(u, 9) AS u FROM u0")
def e1_init_membership(spark, sf):
    c = common.corpus(spark, sf)
    return _long(c.select("doc_id", fcm.init_membership(F.col("doc_id"), K, SEED).alias("u0")), "doc_id", "u0", "u", 9)


@query("e2_centroids", BASE + f"\nSELECT k AS cluster, dim, round(v, 6) AS v FROM v{ST} WHERE round(v, 6) <> 0")
def e2_centroids(spark, sf):
    m = model.fitted(spark, sf)
    c = m.centroid_frame(spark)
    return (c.select("cluster", F.posexplode("centroid").alias("dim", "v"))
            .select("cluster", F.col("dim").cast("int").alias("dim"), F.round("v", 6).alias("v")).where("v != 0"))


@query("e3_memberships", BASE + f"\nSELECT doc_id, k AS cluster, round(u, 6) AS u FROM u{ST}")
def e3_memberships(spark, sf):
    return _long(model.corpus_memberships(spark, sf), "doc_id", "membership", "u", 6)


@query("e4_objective", BASE + "\nSELECT iter, round(loss, 6) AS loss FROM hist")
def e4_objective(spark, sf):
    h = model.fitted(spark, sf).history_frame(spark)
    return h.select("iter", F.round("loss", 6).alias("loss"))


@query("e5_convergence", BASE + "\nSELECT iter, round(delta, 8) AS delta, delta < 1e-4 AS below_tol FROM hist")
def e5_convergence(spark, sf):
    h = model.fitted(spark, sf).history_frame(spark)
    return h.select("iter", F.round("delta", 8).alias("delta"), (F.col("delta") < fcm.DEFAULT_TOL).alias("below_tol"))


@query("e6_fit_summary", BASE + f""",
lab AS (SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY doc_id ORDER BY u DESC, k) AS r FROM u{ST}) WHERE r = 1),
ent AS (SELECT doc_id, -sum(u * ln(u + 1e-10)) AS h FROM u{ST} GROUP BY doc_id)
SELECT {K} AS k, CAST({M} AS DOUBLE) AS m, {ST} AS n_iter, (SELECT round(loss, 6) FROM hist WHERE iter = {ST - 1}) AS final_loss,
       (SELECT round(avg(h), 6) FROM ent) AS mean_entropy, (SELECT CAST(count(DISTINCT k) AS BIGINT) FROM lab) AS n_labels""")
def e6_fit_summary(spark, sf):
    m = model.fitted(spark, sf)
    u = model.corpus_memberships(spark, sf)
    agg = u.agg(F.round(F.avg("entropy"), 6).alias("mean_entropy"),
                F.countDistinct("label").cast("long").alias("n_labels"))
    return agg.select(F.lit(K).alias("k"), F.lit(M).alias("m"), F.lit(m.n_iter).alias("n_iter"),
                      F.lit(round(m.loss_history[-1], 6)).alias("final_loss"), "mean_entropy", "n_labels")


@query("e7_predict", BASE + ",\n" + BENCH_HV + "\nSELECT item_id AS query_id, k AS cluster, round(u, 6) AS u FROM " + BENCH_U)
def e7_predict(spark, sf):
    m = model.fitted(spark, sf)
    q = common.benchmark_queries(spark, sf).select("query_id", "embedding")
    return _long(fcm.predict(spark, m, q, keep=["query_id"]), "query_id", "membership", "u", 6)


@query("e8_hard_label", BASE + f"""
SELECT doc_id, CAST(k AS INTEGER) AS label FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY doc_id ORDER BY u DESC, k) AS r FROM u{ST}) WHERE r = 1""")
def e8_hard_label(spark, sf):
    return model.corpus_memberships(spark, sf).select("doc_id", "label")


@query("e9_entropy", BASE + f"\nSELECT doc_id, round(-sum(u * ln(u + 1e-10)), 6) AS entropy FROM u{ST} GROUP BY doc_id")
def e9_entropy(spark, sf):
    return model.corpus_memberships(spark, sf).select("doc_id", F.round("entropy", 6).alias("entropy"))


@query("e10_uniform_membership", f"""
SELECT item_id AS query_id, CAST(g.k AS INTEGER) AS cluster, round(1.0 / {fcm.DEFAULT_K}, 9) AS u
FROM benchmark CROSS JOIN range(0, {fcm.DEFAULT_K}) g(k)""")
def e10_uniform_membership(spark, sf):
    q = common.benchmark_queries(spark, sf).select("query_id", "embedding")
    return _long(fcm.predict(spark, None, q, k=fcm.DEFAULT_K, keep=["query_id"]), "query_id", "membership", "u", 9)


@query("e11_top4_map", BASE + f"""
SELECT doc_id, 'cluster_' || CAST(k AS VARCHAR) AS key, round(u, 4) AS value
FROM (SELECT doc_id, k, u, row_number() OVER (PARTITION BY doc_id ORDER BY u DESC, k DESC) AS r FROM u{ST}) WHERE r <= 4""")
def e11_top4_map(spark, sf):
    u = model.corpus_memberships(spark, sf)
    return u.select("doc_id", F.explode(vx.top_memberships("membership", 4)).alias("key", "value"))


@query("e12_ambiguous", BASE + f"""
SELECT doc_id, count(*) FILTER (WHERE u > 0.3) >= 2 AS ambiguous FROM u{ST} GROUP BY doc_id""")
def e12_ambiguous(spark, sf):
    u = model.corpus_memberships(spark, sf)
    return u.select("doc_id", vx.is_ambiguous("membership").alias("ambiguous"))


# ---------------------------------------------------------------- D: search

SIMS_BQ = """sims AS (SELECT q.item_id AS query_id, h.doc_id, sum(q.x * h.x) AS sim FROM bq q JOIN hv h USING (dim) GROUP BY q.item_id, h.doc_id),
allpairs AS (SELECT b.item_id AS query_id, c.doc_id, coalesce(s.sim, 0.0) AS sim FROM benchmark b CROSS JOIN corpus c
             LEFT JOIN sims s ON s.query_id = b.item_id AND s.doc_id = c.doc_id)"""
TOPK = """SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, round(sim, 4) AS similarity FROM (
  SELECT query_id, doc_id, sim, row_number() OVER (PARTITION BY query_id ORDER BY round(sim, 12) DESC, doc_id) AS rank FROM @SRC)
WHERE rank <= @K"""
SEARCH_BASE = "WITH " + S.CORPUS + ",\n" + S.hashed_long("corpus", "doc_id", "text") + ",\n" + BENCH_HV + ",\n" + SIMS_BQ


def _hits(spark, sf, k=5, corpus_filter=None):
    c = common.corpus_vectors(spark, sf)
    if corpus_filter is not None:
        c = corpus_filter(spark, sf, c)
    return search.topk(spark, common.benchmark_queries(spark, sf), c, k), c


@query("d1_topk", SEARCH_BASE + "\n" + TOPK.replace("@SRC", "allpairs").replace("@K", "5"))
def d1_topk(spark, sf):
    h, _ = _hits(spark, sf)
    return h.select("query_id", "rank", "doc_id", F.round("similarity", 4).alias("similarity"))


#: The filter of D2: some of the categories, as stored with the vectors.
D2_CATEGORIES = ("src0", "src1", "src2", "src3", "src4")


def _some_categories(spark, sf, c):
    return c.where(F.col("category").isin(*D2_CATEGORIES))


@query("d2_filtered_topk", SEARCH_BASE + f",\nen AS (SELECT a.* FROM allpairs a JOIN corpus c USING (doc_id) WHERE c.category IN {D2_CATEGORIES})\n"
       + TOPK.replace("@SRC", "en").replace("@K", "5"))
def d2_filtered_topk(spark, sf):
    """The metadata filter reaches the scan of the vector table."""
    h, _ = _hits(spark, sf, corpus_filter=_some_categories)
    return h.select("query_id", "rank", "doc_id", F.round("similarity", 4).alias("similarity"))


_HM = SEARCH_BASE + ",\ntk AS (" + TOPK.replace("@SRC", "allpairs").replace("@K", "5") + "),\n" + \
    "hm AS (SELECT tk.*, substring(c.text, 1, 500) AS text, c.category FROM tk JOIN corpus c USING (doc_id))"


@query("d5_answer_text", _HM + """
SELECT b.item_id AS query_id, CASE WHEN hm.query_id IS NULL THEN 'No relevant documents found.'
  ELSE '[Category: ' || hm.category || ' | Similarity: ' || printf('%.3f', hm.similarity) || ']' || chr(10) || chr(10) || hm.text END AS result
FROM benchmark b LEFT JOIN hm ON hm.query_id = b.item_id AND hm.rank = 1""")
def d5_answer_text(spark, sf):
    h, c = _hits(spark, sf)
    hm = search.with_metadata(h, c)
    return search.answer_text(common.benchmark_queries(spark, sf), hm)


@query("d6_top3_list", _HM + """
SELECT query_id, string_agg(CAST(doc_id AS VARCHAR) || ':' || category || ':' || printf('%.4f', similarity), ';' ORDER BY rank) AS top3
FROM hm WHERE rank <= 3 GROUP BY query_id""")
def d6_top3_list(spark, sf):
    h, c = _hits(spark, sf)
    t = search.top_list(search.with_metadata(h, c), 3)
    return t.select("query_id", F.array_join(F.transform("top_results", lambda s: F.concat_ws(
        ":", s["doc_id"].cast("string"), s["category"], F.format_number(s["similarity"], 4))), ";").alias("top3"))


SCOPED_BASE = BASE + ",\n" + BENCH_HV + ",\n" + SIMS_BQ + f""",
qu AS {BENCH_U},
probes AS (SELECT item_id AS query_id, k FROM (SELECT item_id, k, row_number() OVER (PARTITION BY item_id ORDER BY u DESC, k DESC) AS r FROM qu) WHERE r <= @NP),
dl AS (SELECT doc_id, k AS bucket FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY doc_id ORDER BY u DESC, k) AS r FROM u{ST}) WHERE r = 1),
scoped AS (SELECT a.* FROM allpairs a JOIN dl USING (doc_id) JOIN probes p ON p.query_id = a.query_id AND p.k = dl.bucket)"""


def _scoped_hits(spark, sf, nprobe, k=5):
    m = model.fitted(spark, sf)
    corpus = model.corpus_memberships(spark, sf).select("doc_id", "embedding", F.col("label").alias("bucket"))
    q = fcm.predict(spark, m, common.benchmark_queries(spark, sf).select("query_id", "embedding"),
                    keep=["query_id", "embedding"])
    q = search.scoped_queries(q, "membership", nprobe)
    return search.topk(spark, q, corpus, k, probe_col="probes")


@query("d3_cluster_topk", SCOPED_BASE.replace("@NP", "3") + "\n" + TOPK.replace("@SRC", "scoped").replace("@K", "5"))
def d3_cluster_topk(spark, sf):
    return _scoped_hits(spark, sf, 3).select("query_id", "rank", "doc_id", F.round("similarity", 4).alias("similarity"))


@query("d4_ivf_recall", SCOPED_BASE.replace("@NP", "1") + ",\nex AS (" + TOPK.replace("@SRC", "allpairs").replace("@K", "5") +
       "),\nap AS (" + TOPK.replace("@SRC", "scoped").replace("@K", "5") + """)
SELECT b.item_id AS query_id, round(count(ap.doc_id) / 5.0, 4) AS recall_at_5
FROM benchmark b LEFT JOIN ex ON ex.query_id = b.item_id LEFT JOIN ap ON ap.query_id = ex.query_id AND ap.doc_id = ex.doc_id
GROUP BY b.item_id""")
def d4_ivf_recall(spark, sf):
    exact = _hits(spark, sf)[0].select("query_id", "doc_id")
    approx = _scoped_hits(spark, sf, 1).select("query_id", "doc_id", F.lit(1).alias("found"))
    q = tb.read_table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"))
    j = q.join(exact, "query_id", "left").join(approx, ["query_id", "doc_id"], "left")
    return j.groupBy("query_id").agg(F.round(F.count("found") / 5.0, 4).alias("recall_at_5"))


@query("d4_quantised_recall")
def d4_quantised_recall(spark, sf):
    """Recall of the five nearest over quantised lists against the exact ones, and the share of rows whose codes a query looked at.

    No SQL: the lists are k-means centres of a seeded sample."""
    exact = _hits(spark, sf)[0].select("query_id", "doc_id")
    index = quantised.build(spark, common.corpus_vectors(spark, sf).select("doc_id", "embedding"))
    found = quantised.search(spark, common.benchmark_queries(spark, sf), index)
    j = exact.join(found.select("query_id", "doc_id", F.lit(1).alias("found")), ["query_id", "doc_id"], "left")
    recall = j.groupBy("query_id").agg(F.round(F.count("found") / F.count(F.lit(1)), 4).alias("recall_at_5"))
    seen = found.groupBy("query_id").agg(F.round(F.max(F.col("n_seen") / F.col("n_rows")), 4).alias("share_seen"))
    return recall.join(seen, "query_id", "left")


@query("d4_quantised_topk")
def d4_quantised_topk(spark, sf):
    """The five nearest that the quantised lists give, exactly scored."""
    index = quantised.build(spark, common.corpus_vectors(spark, sf).select("doc_id", "embedding"))
    return (quantised.search(spark, common.benchmark_queries(spark, sf), index)
            .select("query_id", "rank", "doc_id", F.round("similarity", 4).alias("similarity")))


@query("e1_seeded_start")
def e1_seeded_start(spark, sf):
    """Fits from random memberships and from k-means|| centroids: first and last objective and steps (no SQL: seeded draws)."""
    vecs = common.corpus_vectors(spark, sf).select("doc_id", "embedding")
    rows = []
    for init in ("random", "centroids"):
        fitted = fcm.fit(spark, vecs, k=K, m=M, max_iter=50, checkpoint=False, init=init)
        rows.append((init, fitted.loss_history[0], fitted.loss_history[-1], fitted.n_iter, fitted.converged))
    return (spark.createDataFrame(rows, "init string, first_loss double, last_loss double, n_iter int, converged boolean")
            .select("init", F.round("first_loss", 6).alias("first_loss"), F.round("last_loss", 6).alias("last_loss"), "n_iter", "converged"))


E6_SHIPPED_SQL = ("WITH RECURSIVE " + S.CORPUS + ",\n" + S.hashed_long("corpus", "doc_id", "text").replace("hv AS (", "hv AS MATERIALIZED (") + ",\n"
                  + S.fcm_until(fcm.DEFAULT_K, fcm.DEFAULT_M, fcm.DEFAULT_TOL, fcm.DEFAULT_MAX_ITER, fcm.DEFAULT_SEED) + f"""
SELECT CAST(iter - 1 AS INTEGER) AS iter, round(any_value(loss), 6) AS loss, round(any_value(delta), 6) AS delta,
  (SELECT min(delta) < {fcm.DEFAULT_TOL} FROM fit WHERE iter > 0) AS converged FROM fit WHERE iter > 0 GROUP BY iter""")


@query("e6_fit_shipped", E6_SHIPPED_SQL)
def e6_fit_shipped(spark, sf):
    """The fit with its own defaults: K = 15, m = 2, stop at max|dU| < 1e-4, at most 150 steps; one row per step."""
    vecs = common.corpus_vectors(spark, sf).select("doc_id", "embedding")
    m = fcm.fit(spark, vecs, checkpoint=False)
    return m.history_frame(spark).select("iter", F.round("loss", 6).alias("loss"), F.round("delta", 6).alias("delta"),
                                         F.lit(m.converged).alias("converged"))


@query("a7_model_round_trip", BASE + f"""
SELECT doc_id, CAST(k AS INTEGER) AS label, {float(M)}::DOUBLE AS m, 0.0::DOUBLE AS tol, {ST}::INTEGER AS max_iter, {SEED}::INTEGER AS seed, {ST}::INTEGER AS n_iter, {K}::INTEGER AS n_clusters
FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY doc_id ORDER BY u DESC, k) AS r FROM u{ST}) WHERE r = 1""")
def a7_model_round_trip(spark, sf):
    """Labels predicted by a model that was saved with its parameters and loaded again."""
    path = scratch_path(spark, "a7")
    fcm.save_model(spark, model.fitted(spark, sf), path)
    loaded = fcm.load_model(spark, path)
    vecs = common.corpus_vectors(spark, sf).select("doc_id", "embedding")
    about = {"m": loaded.m, "tol": loaded.tol, "max_iter": loaded.max_iter, "seed": loaded.seed, "n_iter": loaded.n_iter, "n_clusters": loaded.k}
    return (fcm.annotate(fcm.predict(spark, loaded, vecs, keep=["doc_id"]))
            .select("doc_id", F.col("label").cast("int").alias("label"), *[F.lit(v).alias(c) for c, v in about.items()]))
