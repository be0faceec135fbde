"""Registered queries for threshold evaluation (I), cluster evaluation (F)
and cluster profiles (G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import evaluate as ev
from lodestar.operators import fcm, profiles, threshold
from lodestar.plans import common, model
from lodestar.plans import sqlfrag as S
from lodestar.plans.q_model import BASE, ST
from lodestar.plans.registry import ORACLES, query
from lodestar.session import scratch_path
from lodestar.sources import tables as tb

K, M = model.K, model.M


# ---------------------------------------------------------------- I: thresholds

def eval_pairs(spark, sf):
    """Evaluation pairs derived from the corpus: each document paired with
    the next doc_id, by content id; expected = same language."""
    lang = tb.read_table(spark, sf, "documents").select("doc_id", "lang")
    c = common.corpus(spark, sf).select("doc_id", "content_id").join(lang, "doc_id")
    b = c.select((F.col("doc_id") - 1).alias("doc_a"), F.col("content_id").alias("kb"), F.col("lang").alias("lb"))
    return (c.select(F.col("doc_id").alias("doc_a"), F.col("content_id").alias("ka"), F.col("lang").alias("la")).join(b, "doc_a")
            .select("doc_a", "ka", "kb", (F.col("la") == F.col("lb")).alias("expected")))


def query_vectors(spark, sf):
    """One vector per distinct text, of the row with the smallest id, as a table of its own: joins on it have a plain
    exchange (or a broadcast) on both sides, so that a text which many pairs name can be split."""
    def build():
        c = common.corpus_vectors(spark, sf)
        first = c.groupBy("content_id").agg(F.min("doc_id").alias("doc_id"))
        return c.select("doc_id", F.col("content_id").alias("key"), "embedding").join(first.select("doc_id"), "doc_id", "left_semi").select("key", "embedding")
    return common.materialized(spark, ("content_vectors", sf), build)


PAIRS_SQL = "WITH " + S.CORPUS + """,
ep0 AS (SELECT a.doc_id AS doc_a, a.text AS qa, b.text AS qb, da.lang = db.lang AS expected FROM corpus a
  JOIN corpus b ON b.doc_id = a.doc_id + 1 JOIN documents da ON da.doc_id = a.doc_id JOIN documents db ON db.doc_id = b.doc_id),
dq AS MATERIALIZED (SELECT q, row_number() OVER (ORDER BY q) AS qid FROM (SELECT DISTINCT q FROM (SELECT qa AS q FROM ep0 UNION ALL SELECT qb FROM ep0))),
ep AS MATERIALIZED (SELECT ep0.doc_a, ep0.expected, a.qid AS ia, b.qid AS ib FROM ep0 JOIN dq a ON a.q = ep0.qa JOIN dq b ON b.q = ep0.qb),
""" + S.hashed_long("dq", "qid", "q", name="qv") + """,
pv AS MATERIALIZED (SELECT ep.doc_a, ep.ia, ep.ib FROM ep),
ps AS (SELECT pv.doc_a, sum(a.x * b.x) AS s FROM pv JOIN qv a ON a.qid = pv.ia JOIN qv b ON b.qid = pv.ib AND b.dim = a.dim GROUP BY pv.doc_a),
sims AS (SELECT ep.doc_a, ep.expected, coalesce(ps.s, 0.0) AS sim FROM ep LEFT JOIN ps USING (doc_a)),
th AS (SELECT unnest([0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90, 0.95])::DOUBLE AS theta),
conf AS (SELECT theta, CAST(count(*) FILTER (WHERE sim >= theta AND expected) AS BIGINT) AS tp,
  CAST(count(*) FILTER (WHERE sim >= theta AND NOT expected) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE sim < theta AND expected) AS BIGINT) AS fn,
  CAST(count(*) FILTER (WHERE sim < theta AND NOT expected) AS BIGINT) AS tn FROM sims CROSS JOIN th GROUP BY theta),
met AS (SELECT theta, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 1.0 END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r,
  CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0.0 END AS fpr FROM conf),
res AS (SELECT theta, round(r, 3) AS hit_rate, round(p, 3) AS precision,
  round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 3) AS f1, round(fpr, 3) AS false_positive_rate FROM met)"""


@query("i1_distinct_queries", PAIRS_SQL + "\nSELECT substring(sha256(q), 1, 16) AS qkey FROM dq")
def i1_distinct_queries(spark, sf):
    return threshold.distinct_queries(eval_pairs(spark, sf)).select(F.col("key").alias("qkey"))


def _sims(spark, sf):
    return threshold.pair_similarity(eval_pairs(spark, sf), query_vectors(spark, sf))


@query("i2_pair_similarity", PAIRS_SQL + "\nSELECT doc_a, round(sim, 6) AS sim, expected FROM sims")
def i2_pair_similarity(spark, sf):
    return _sims(spark, sf).select("doc_a", F.round("sim", 6).alias("sim"), "expected")


@query("i3_confusion", PAIRS_SQL + "\nSELECT theta, tp, fp, fn, tn FROM conf")
def i3_confusion(spark, sf):
    return threshold.confusion(_sims(spark, sf))


@query("i4_metrics", PAIRS_SQL + "\nSELECT * FROM res")
def i4_metrics(spark, sf):
    return threshold.metrics(threshold.confusion(_sims(spark, sf)))


@query("i5_threshold_sweep", PAIRS_SQL + "\nSELECT * FROM res")
def i5_threshold_sweep(spark, sf):
    return threshold.sweep(eval_pairs(spark, sf), query_vectors(spark, sf))


# ---------------------------------------------------------------- F: evaluation

LAB = f"""lab AS (SELECT doc_id, k AS label FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY doc_id ORDER BY u DESC, k) AS r FROM u{ST}) WHERE r = 1)"""


def _labelled(spark, sf):
    return model.corpus_memberships(spark, sf)


@query("f1_sample", "WITH " + S.CORPUS + "\nSELECT doc_id FROM corpus ORDER BY md5('42|' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 60")
def f1_sample(spark, sf):
    return ev.sample(common.corpus(spark, sf), ev.HEATMAP_SAMPLE, 42).select("doc_id")


SIL_SQL = BASE + ",\n" + LAB + """,
smp AS (SELECT doc_id FROM corpus ORDER BY md5('42|' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 2000),
sl AS (SELECT lab.* FROM lab JOIN smp USING (doc_id)),
dots AS (SELECT a.doc_id AS i, b.doc_id AS j, sum(a.x * b.x) AS xy FROM hv a JOIN hv b USING (dim)
  WHERE a.doc_id IN (SELECT doc_id FROM smp) AND b.doc_id IN (SELECT doc_id FROM smp) GROUP BY a.doc_id, b.doc_id),
dist AS (SELECT a.doc_id AS i, b.doc_id AS j, b.label AS lj, sqrt(greatest(coalesce(xa.xx, 0) + coalesce(xb.xx, 0) - 2 * coalesce(d.xy, 0), 0)) AS d
  FROM sl a JOIN sl b ON a.doc_id <> b.doc_id LEFT JOIN xx xa ON xa.doc_id = a.doc_id LEFT JOIN xx xb ON xb.doc_id = b.doc_id
  LEFT JOIN dots d ON d.i = a.doc_id AND d.j = b.doc_id),
cnt AS (SELECT label, count(*) AS n FROM sl GROUP BY label),
md AS (SELECT d.i, d.lj, sum(d.d) AS s FROM dist d GROUP BY d.i, d.lj),
per AS (SELECT s.doc_id, s.label, c.n AS n_own,
  coalesce((SELECT m.s FROM md m WHERE m.i = s.doc_id AND m.lj = s.label), 0) / greatest(c.n - 1, 1) AS a,
  (SELECT min(m.s / c2.n) FROM md m JOIN cnt c2 ON c2.label = m.lj WHERE m.i = s.doc_id AND m.lj <> s.label) AS b
  FROM sl s JOIN cnt c USING (label)),
sil AS (SELECT avg(CASE WHEN n_own > 1 THEN (b - a) / greatest(a, b) ELSE 0 END) AS silhouette, count(*) AS n FROM per)"""


@query("f2_silhouette_sampled", SIL_SQL + "\nSELECT round(silhouette, 6) AS silhouette, CAST(n AS BIGINT) AS n FROM sil")
def f2_silhouette_sampled(spark, sf):
    """The Euclidean silhouette of a sample of 2,000; the sample is the operator."""
    lab = _labelled(spark, sf).select("doc_id", "embedding", "label")
    s = ev.sampled_silhouette(spark, lab, ev.SILHOUETTE_SAMPLE, 42)
    return s.select(F.round("silhouette", 6).alias("silhouette"), "n")


def _full_sil(g=""):
    """Silhouette over all rows with mean squared distances, from counts, means and mean squared norms ({g}nl, {g}cm, {g}lab)."""
    return f"""{g}psi AS (SELECT l.label, sum(coalesce(xx.xx, 0)) / any_value(nl.n) AS p FROM {g}lab l LEFT JOIN xx USING (doc_id) JOIN {g}nl nl USING (label) GROUP BY l.label),
{g}xca AS (SELECT h.doc_id, cm.label, sum(h.x * cm.c) AS xc FROM hv h JOIN {g}cm cm ON cm.dim = h.dim GROUP BY h.doc_id, cm.label),
{g}sqd AS (SELECT l.doc_id, l.label AS own, p.label AS other, greatest(coalesce(xx.xx, 0) - 2 * coalesce(a.xc, 0) + p.p, 0) AS d
  FROM {g}lab l CROSS JOIN {g}psi p LEFT JOIN xx ON xx.doc_id = l.doc_id LEFT JOIN {g}xca a ON a.doc_id = l.doc_id AND a.label = p.label),
{g}per AS (SELECT d.doc_id, any_value(nl.n) AS n, max(CASE WHEN d.other = d.own THEN d.d * nl.n / greatest(nl.n - 1, 1) END) AS a,
  min(CASE WHEN d.other <> d.own THEN d.d END) AS b FROM {g}sqd d JOIN {g}nl nl ON nl.label = d.own GROUP BY d.doc_id),
{g}sil AS (SELECT CASE WHEN (SELECT count(*) FROM {g}nl) >= 2 THEN avg(CASE WHEN n > 1 AND greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END) END AS sil,
  count(*) AS n FROM {g}per)"""


MEANS = """nl AS (SELECT label, count(*) AS n FROM lab GROUP BY label),
cm AS (SELECT l.label, h.dim, sum(h.x) / any_value(nl.n) AS c FROM hv h JOIN lab l USING (doc_id) JOIN nl USING (label) GROUP BY l.label, h.dim)"""


@query("f2_silhouette", BASE + ",\n" + LAB + ",\n" + MEANS + ",\n" + _full_sil() + "\nSELECT round(sil, 6) AS silhouette, CAST(n AS BIGINT) AS n FROM sil")
def f2_silhouette(spark, sf):
    """All rows, squared Euclidean distances."""
    s = ev.silhouette(spark, _labelled(spark, sf))
    return s.select(F.round("silhouette", 6).alias("silhouette"), "n")


DB_SQL = BASE + ",\n" + LAB + """,
nl AS (SELECT label, count(*) AS n FROM lab GROUP BY label),
cm AS (SELECT l.label, h.dim, sum(h.x) / any_value(nl.n) AS c FROM hv h JOIN lab l USING (doc_id) JOIN nl USING (label) GROUP BY l.label, h.dim),
cc AS (SELECT label, sum(c * c) AS cc FROM cm GROUP BY label),
xc AS (SELECT h.doc_id, sum(h.x * cm.c) AS xc FROM hv h JOIN lab l USING (doc_id) JOIN cm ON cm.label = l.label AND cm.dim = h.dim GROUP BY h.doc_id),
sp AS (SELECT l.label, avg(sqrt(greatest(coalesce(xx.xx, 0) - 2 * coalesce(xc.xc, 0) + cc.cc, 0))) AS s
  FROM lab l LEFT JOIN xx USING (doc_id) LEFT JOIN xc USING (doc_id) JOIN cc USING (label) GROUP BY l.label),
cd AS (SELECT a.label AS la, b.label AS lb, sum(a.c * b.c) AS ab FROM cm a JOIN cm b ON a.dim = b.dim AND a.label <> b.label GROUP BY a.label, b.label),
mm AS (SELECT a.label AS la, b.label AS lb, sqrt(greatest(a.cc + b.cc - 2 * coalesce(cd.ab, 0), 0)) AS m
  FROM cc a JOIN cc b ON a.label <> b.label LEFT JOIN cd ON cd.la = a.label AND cd.lb = b.label),
r AS (SELECT mm.la, max((sa.s + sb.s) / mm.m) AS r FROM mm JOIN sp sa ON sa.label = mm.la JOIN sp sb ON sb.label = mm.lb GROUP BY mm.la)
SELECT round(avg(r), 6) AS db_index, CAST(count(*) AS BIGINT) AS n_labels FROM r"""


@query("f3_davies_bouldin", DB_SQL)
def f3_davies_bouldin(spark, sf):
    lab = _labelled(spark, sf).select("doc_id", "embedding", "label")
    return ev.davies_bouldin(spark, lab).select(F.round("db_index", 6).alias("db_index"), "n_labels")


K_GRID = list(range(2, 9))


def _f4_sql():
    parts = ["WITH " + S.CORPUS, S.hashed_long("corpus", "doc_id", "text"),
             "xx AS MATERIALIZED (SELECT doc_id, sum(x * x) AS xx FROM hv GROUP BY doc_id)"]
    sel = []
    for k in K_GRID:
        g = f"k{k}_"
        parts.append(S.fcm_ctes(model.STEPS, k, M, model.SEED, tag=g))
        parts.append(f"""{g}lab AS MATERIALIZED (SELECT doc_id, k AS label FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY doc_id ORDER BY u DESC, k) AS r FROM {g}u{model.STEPS}) WHERE r = 1),
{g}nl AS (SELECT label, count(*) AS n FROM {g}lab GROUP BY label),
{g}cm AS (SELECT l.label, h.dim, sum(h.x) / any_value(nl.n) AS c FROM hv h JOIN {g}lab l USING (doc_id) JOIN {g}nl nl USING (label) GROUP BY l.label, h.dim),
{g}cc AS (SELECT label, sum(c * c) AS cc FROM {g}cm GROUP BY label),
{g}xc AS (SELECT h.doc_id, sum(h.x * cm.c) AS xc FROM hv h JOIN {g}lab l USING (doc_id) JOIN {g}cm cm ON cm.label = l.label AND cm.dim = h.dim GROUP BY h.doc_id),
{g}sp AS (SELECT l.label, avg(sqrt(greatest(coalesce(xx.xx, 0) - 2 * coalesce(xc.xc, 0) + cc.cc, 0))) AS s
  FROM {g}lab l LEFT JOIN xx USING (doc_id) LEFT JOIN {g}xc xc USING (doc_id) JOIN {g}cc cc USING (label) GROUP BY l.label),
{g}cd AS (SELECT a.label AS la, b.label AS lb, sum(a.c * b.c) AS ab FROM {g}cm a JOIN {g}cm b ON a.dim = b.dim AND a.label <> b.label GROUP BY a.label, b.label),
{g}mm AS (SELECT a.label AS la, b.label AS lb, sqrt(greatest(a.cc + b.cc - 2 * coalesce(cd.ab, 0), 0)) AS m
  FROM {g}cc a JOIN {g}cc b ON a.label <> b.label LEFT JOIN {g}cd cd ON cd.la = a.label AND cd.lb = b.label),
{g}r AS (SELECT mm.la, max((sa.s + sb.s) / mm.m) AS r FROM {g}mm mm JOIN {g}sp sa ON sa.label = mm.la JOIN {g}sp sb ON sb.label = mm.lb GROUP BY mm.la),
{_full_sil(g)}""")
        sel.append(f"SELECT {k} AS k, (SELECT sil FROM {g}sil) AS silhouette, (SELECT avg(r) FROM {g}r) AS db_index, "
                   f"(SELECT loss FROM {g}hist WHERE iter = {model.STEPS - 1}) AS fcm_loss, {model.STEPS} AS n_iter")
    return (",\n".join(parts) + ",\nsw AS (" + " UNION ALL ".join(sel) + ")\n"
            "SELECT CAST(k AS INTEGER) AS k, round(silhouette, 6) AS silhouette, round(db_index, 6) AS db_index, "
            "round(fcm_loss, 6) AS fcm_loss, CAST(n_iter AS INTEGER) AS n_iter, "
            "CAST(rank() OVER (ORDER BY silhouette DESC NULLS LAST) AS INTEGER) AS candidate_rank FROM sw")


@query("f4_k_sweep", _f4_sql())
def f4_k_sweep(spark, sf):
    vecs = common.corpus_vectors(spark, sf).select("doc_id", "embedding")
    r = ev.k_sweep(spark, vecs, K_GRID, m=M, max_iter=model.STEPS, tol=0.0)
    return r.select("k", F.round("silhouette", 6).alias("silhouette"), F.round("db_index", 6).alias("db_index"),
                    F.round("fcm_loss", 6).alias("fcm_loss"), "n_iter", F.col("candidate_rank").cast("int").alias("candidate_rank"))


M_GRID = [1.2, 1.5, 2.0, 2.5, 3.0, 4.0]   # fixed: the reference's fuzziness grid


def _f5_sql():
    ctes = [S.fcm_ctes(model.STEPS, K, m, model.SEED, tag=f"f{i}_") for i, m in enumerate(M_GRID)]
    sel = []
    for i, m in enumerate(M_GRID):
        u = f"f{i}_u{model.STEPS}"
        sel.append(f"""SELECT CAST({m} AS DOUBLE) AS m, round(avg(h), 6) AS mean_entropy, round(avg(mx), 6) AS mean_max_membership,
  round(avg(amb), 6) AS pct_ambiguous, round(avg(h) / ln({float(K)}), 6) AS entropy_over_ln_k, {model.STEPS} AS n_iter
  FROM (SELECT doc_id, -sum(u * ln(u + 1e-10)) AS h, max(u) AS mx, CASE WHEN count(*) FILTER (WHERE u > 0.3) >= 2 THEN 1.0 ELSE 0.0 END AS amb
        FROM {u} GROUP BY doc_id)""")
    return ("WITH " + S.CORPUS + ",\n" + S.hashed_long("corpus", "doc_id", "text") + ",\n" + ",\n".join(ctes)
            + "\n" + "\nUNION ALL\n".join(sel))


@query("f5_fuzziness_sweep", _f5_sql())
def f5_fuzziness_sweep(spark, sf):
    vecs = common.corpus_vectors(spark, sf).select("doc_id", "embedding")
    r = ev.fuzziness_sweep(spark, vecs, M_GRID, k=K, max_iter=model.STEPS, tol=0.0)
    return r.select("m", *[F.round(c, 6).alias(c) for c in ("mean_entropy", "mean_max_membership", "pct_ambiguous",
                                                             "entropy_over_ln_k")], "n_iter")


#: The sweeps as shipped: m = 2, K = 15, stop at max|dU| < 1e-4; a sweep's fit has at most 100 steps (a single fit 150).
SHIPPED_K_GRID = list(range(8, 22))
SHIPPED_K, SHIPPED_M, SHIPPED_TOL, SHIPPED_STEPS = 15, 2.0, 1e-4, 100


@query("f4_k_sweep_shipped")
def f4_k_sweep_shipped(spark, sf):
    """K 8..21, every fit run until it stops (no SQL: the number of steps is not fixed)."""
    vecs = common.corpus_vectors(spark, sf).select("doc_id", "embedding")
    r = ev.k_sweep(spark, vecs, SHIPPED_K_GRID, m=SHIPPED_M, max_iter=SHIPPED_STEPS, tol=SHIPPED_TOL)
    return r.select("k", F.round("silhouette", 6).alias("silhouette"), F.round("db_index", 6).alias("db_index"),
                    F.round("fcm_loss", 6).alias("fcm_loss"), "n_iter", F.col("candidate_rank").cast("int").alias("candidate_rank"))


def _f5_shipped_sql():
    fits = [S.fcm_until(SHIPPED_K, m, SHIPPED_TOL, SHIPPED_STEPS, model.SEED, tag=f"s{i}_") for i, m in enumerate(M_GRID)]
    sel = [f"""SELECT CAST({m} AS DOUBLE) AS m, round(avg(h), 6) AS mean_entropy, round(avg(mx), 6) AS mean_max_membership, round(avg(amb), 6) AS pct_ambiguous,
  round(avg(h) / ln({float(SHIPPED_K)}), 6) AS entropy_over_ln_k, CAST(any_value(n) AS INTEGER) AS n_iter
  FROM (SELECT doc_id, max(iter) AS n, -sum(u * ln(u + 1e-10)) AS h, max(u) AS mx, CASE WHEN count(*) FILTER (WHERE u > 0.3) >= 2 THEN 1.0 ELSE 0.0 END AS amb
        FROM s{i}_fit WHERE iter = (SELECT max(iter) FROM s{i}_fit) GROUP BY doc_id)""" for i, m in enumerate(M_GRID)]
    hv = S.hashed_long("corpus", "doc_id", "text").replace("hv AS (", "hv AS MATERIALIZED (")
    return "WITH RECURSIVE " + S.CORPUS + ",\n" + hv + ",\n" + ",\n".join(fits) + "\n" + "\nUNION ALL\n".join(sel)


@query("f5_fuzziness_sweep_shipped", _f5_shipped_sql())
def f5_fuzziness_sweep_shipped(spark, sf):
    """All fuzziness values at K = 15, every fit run until it stops."""
    vecs = common.corpus_vectors(spark, sf).select("doc_id", "embedding")
    r = ev.fuzziness_sweep(spark, vecs, M_GRID, k=SHIPPED_K, max_iter=SHIPPED_STEPS, tol=SHIPPED_TOL)
    return r.select("m", *[F.round(c, 6).alias(c) for c in ("mean_entropy", "mean_max_membership", "pct_ambiguous",
                                                             "entropy_over_ln_k")], "n_iter")


# ---------------------------------------------------------------- G: profiles

G_BASE = BASE + ",\n" + LAB + f""",
ent AS (SELECT doc_id, -sum(u * ln(u + 1e-10)) AS h FROM u{ST} GROUP BY doc_id),
mem AS (SELECT c.doc_id, c.text, c.category, l.label, e.h AS entropy FROM corpus c JOIN lab l USING (doc_id) JOIN ent e USING (doc_id)),
ccount AS (SELECT label AS cluster, category, CAST(count(*) AS BIGINT) AS cnt FROM mem GROUP BY label, category),
topc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY cnt DESC, category) AS rank FROM ccount) WHERE rank <= 5),
vv AS (SELECT k, sum(v * v) AS vv FROM v{ST} GROUP BY k),
xvl AS (SELECT h.doc_id, sum(h.x * v.v) AS xv FROM hv h JOIN lab l USING (doc_id) JOIN v{ST} v ON v.k = l.label AND v.dim = h.dim GROUP BY h.doc_id),
dcen AS (SELECT l.doc_id, l.label, sqrt(greatest(coalesce(xx.xx, 0) - 2 * coalesce(xvl.xv, 0) + vv.vv, 0)) AS dist
  FROM lab l LEFT JOIN xx USING (doc_id) LEFT JOIN xvl USING (doc_id) JOIN vv ON vv.k = l.label),
reps AS (SELECT * FROM (SELECT label AS cluster, doc_id, dist, row_number() OVER (PARTITION BY label ORDER BY round(dist, 12), doc_id) AS rank FROM dcen) WHERE rank <= 5),
bnd AS (SELECT * FROM (SELECT label AS cluster, doc_id, entropy, row_number() OVER (PARTITION BY label ORDER BY round(entropy, 12) DESC, doc_id) AS rank FROM mem) WHERE rank <= 3)"""


def _mem(spark, sf):
    return model.corpus_memberships(spark, sf)


@query("g1_sizes", G_BASE + "\nSELECT label AS cluster, CAST(count(*) AS BIGINT) AS size FROM lab GROUP BY label")
def g1_sizes(spark, sf):
    return profiles.sizes(_mem(spark, sf))


@query("g2_top_categories", G_BASE + "\nSELECT cluster, CAST(rank AS INTEGER) AS rank, category, cnt FROM topc")
def g2_top_categories(spark, sf):
    return profiles.top_categories(_mem(spark, sf)).select("cluster", F.col("rank").cast("int").alias("rank"),
                                                           "category", "cnt")


def _reps(spark, sf):
    return profiles.representatives(_mem(spark, sf), model.fitted(spark, sf).centroids)


KEY = "substring(sha256({}), 1, 16)"
BND_TEXT = f"""bt AS (SELECT b.cluster, b.rank, b.doc_id, b.entropy, substring(m.text, 1, 250) AS text, t.tops FROM bnd b JOIN mem m USING (doc_id)
  JOIN (SELECT doc_id, string_agg('cluster_' || CAST(k AS VARCHAR), ',' ORDER BY r) AS tops FROM (
    SELECT doc_id, k, row_number() OVER (PARTITION BY doc_id ORDER BY u DESC, k DESC) AS r FROM u{ST}) WHERE r <= 4 GROUP BY doc_id) t USING (doc_id))"""


def _key(c):
    return F.substring(F.sha2(c, 256), 1, 16)


def _clusters(distribution):
    return F.array_join(F.map_keys(distribution), ",")


@query("g3_representatives", G_BASE + f"""
SELECT r.cluster, CAST(r.rank AS INTEGER) AS rank, r.doc_id, round(r.dist, 6) AS dist, {KEY.format("substring(m.text, 1, 300)")} AS text_key
FROM reps r JOIN mem m USING (doc_id)""")
def g3_representatives(spark, sf):
    return _reps(spark, sf).select("cluster", F.col("rank").cast("int").alias("rank"), "doc_id",
                                   F.round("dist", 6).alias("dist"), _key("text").alias("text_key"))


@query("g4_boundary_documents", G_BASE + ",\n" + BND_TEXT + f"""
SELECT cluster, CAST(rank AS INTEGER) AS rank, doc_id, round(entropy, 4) AS entropy, {KEY.format("text")} AS text_key, tops FROM bt""")
def g4_boundary_documents(spark, sf):
    b = profiles.boundary_documents(_mem(spark, sf))
    return b.select("cluster", F.col("rank").cast("int").alias("rank"), "doc_id", "entropy", _key("text").alias("text_key"),
                    _clusters("membership_distribution").alias("tops"))


@query("g5_profiles", G_BASE + ",\n" + BND_TEXT + f"""
SELECT s.cluster, s.size, tc.cats, {KEY.format("r.texts")} AS reps, {KEY.format("b.texts")} AS bnd
FROM (SELECT label AS cluster, CAST(count(*) AS BIGINT) AS size FROM lab GROUP BY label) s
LEFT JOIN (SELECT cluster, string_agg(category || ':' || CAST(cnt AS VARCHAR), ';' ORDER BY rank) AS cats FROM topc GROUP BY cluster) tc USING (cluster)
LEFT JOIN (SELECT r.cluster, string_agg(substring(m.text, 1, 300), chr(10) ORDER BY r.rank) AS texts FROM reps r JOIN mem m USING (doc_id) GROUP BY r.cluster) r USING (cluster)
LEFT JOIN (SELECT cluster, string_agg(text || '|' || tops, chr(10) ORDER BY rank) AS texts FROM bt GROUP BY cluster) b USING (cluster)""")
def g5_profiles(spark, sf):
    """The profile rows, with their lists as strings."""
    return _flat_profiles(profiles.profiles(_mem(spark, sf), model.fitted(spark, sf).centroids))


def _flat_profiles(p):
    cats = F.array_join(F.transform("top_categories", lambda s: F.concat_ws(":", s["category"], s["cnt"].cast("string"))), ";")
    bnd = F.array_join(F.transform("boundary_documents", lambda s: F.concat_ws("|", s["text"], _clusters(s["membership_distribution"]))), "\n")
    return p.select("cluster", "size", cats.alias("cats"), _key(F.array_join("representative_texts", "\n")).alias("reps"), _key(bnd).alias("bnd"))


G6_SQL = G_BASE + f""",
sz AS (SELECT label AS cluster, count(*) AS size FROM lab GROUP BY label),
c3 AS (SELECT cluster, string_agg(regexp_extract(category, '[^.]*$') || '(' || CAST(cnt AS VARCHAR) || ')', ', ' ORDER BY rank) AS cats
  FROM topc WHERE rank <= 3 GROUP BY cluster),
b1 AS (SELECT b.cluster, b.doc_id, substring(m.text, 1, 250) AS snip FROM bnd b JOIN mem m USING (doc_id) WHERE b.rank = 1),
t2 AS (SELECT b1.cluster, string_agg('cluster_' || CAST(u.k AS VARCHAR) || '=' || printf('%.2f', round(u.u, 4)), ' / ' ORDER BY u.r) AS top2
  FROM b1 JOIN (SELECT doc_id, k, u, row_number() OVER (PARTITION BY doc_id ORDER BY u DESC, k DESC) AS r FROM u{ST}) u
  ON u.doc_id = b1.doc_id AND u.r <= 2 GROUP BY b1.cluster)
SELECT sz.cluster, printf('Cluster %2d | %4d docs | %s', sz.cluster, sz.size, coalesce(c3.cats, '')) ||
  CASE WHEN b1.doc_id IS NULL THEN '' ELSE chr(10) || '  Boundary example: ' || t2.top2 || chr(10) || '  Text: '
  || {S.strip('substring(b1.snip, 1, 120)')} || ' …' END AS summary
FROM sz LEFT JOIN c3 USING (cluster) LEFT JOIN b1 USING (cluster) LEFT JOIN t2 USING (cluster)"""


@query("g6_summary", G6_SQL)
def g6_summary(spark, sf):
    return profiles.summary(profiles.profiles(_mem(spark, sf), model.fitted(spark, sf).centroids))


@query("g7_top_terms", G_BASE + f""",
tk AS (SELECT label AS cluster, unnest(list_filter(regexp_split_to_array(lower(text), '[ \\t\\n\\r\\f]+'), lambda w: w <> '')) AS term FROM mem),
tf AS (SELECT cluster, term, CAST(count(*) AS BIGINT) AS tf FROM tk GROUP BY cluster, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
sc AS (SELECT tf.cluster, tf.term, tf.tf, round(tf.tf * ln({float(K)} / df.df), 9) AS score FROM tf JOIN df USING (term))
SELECT cluster, CAST(rank AS INTEGER) AS rank, term, tf, score FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY score DESC, term) AS rank FROM sc) WHERE rank <= 10""")
def g7_top_terms(spark, sf):
    return profiles.top_terms(_mem(spark, sf), 10, k=K).select(
        "cluster", F.col("rank").cast("int").alias("rank"), "term", "tf", "score")


@query("g8_boundary_flag", G_BASE + "\nSELECT doc_id, entropy > (SELECT quantile_cont(entropy, 0.85) FROM mem) AS boundary FROM mem")
def g8_boundary_flag(spark, sf):
    """The threshold and the flags cover all rows."""
    return profiles.boundary_flags(_mem(spark, sf)).select("doc_id", "boundary")


@query("g9_heatmap", BASE + f""",
smp AS (SELECT doc_id FROM corpus ORDER BY md5('0|' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 60)
SELECT doc_id, """ + ", ".join(f"round(max(u) FILTER (WHERE k = {i}), 4) AS C{i}" for i in range(K)) +
       f" FROM u{ST} JOIN smp USING (doc_id) GROUP BY doc_id")
def g9_heatmap(spark, sf):
    s = ev.sample(_mem(spark, sf), ev.HEATMAP_SAMPLE, 0)
    return profiles.heatmap(s, K)


#: Fixed values of the projection, as the operator's defaults state them: dimensions and power steps.
G10_DIM, G10_STEPS = 128, 24


def _g10_sql():
    unit = "w / sqrt(sum(w * w) OVER ())"
    parts = [G_BASE, f"dims AS (SELECT unnest(range({G10_DIM}))::INTEGER AS dim)", "nn AS (SELECT count(*)::DOUBLE AS n FROM corpus)",
             "mu AS MATERIALIZED (SELECT d.dim, coalesce(sum(h.x), 0) / any_value(nn.n) AS mu FROM dims d CROSS JOIN nn LEFT JOIN hv h ON h.dim = d.dim GROUP BY d.dim)",
             "pp AS MATERIALIZED (SELECT a.dim AS d1, b.dim AS d2, sum(a.x * b.x) AS s FROM hv a JOIN hv b USING (doc_id) GROUP BY a.dim, b.dim)",
             "cov AS MATERIALIZED (SELECT a.dim AS d1, b.dim AS d2, coalesce(pp.s, 0) / nn.n - a.mu * b.mu AS c FROM mu a CROSS JOIN mu b CROSS JOIN nn "
             "LEFT JOIN pp ON pp.d1 = a.dim AND pp.d2 = b.dim)"]
    for name, start, other in (("p", f"1.0 + dim / {G10_DIM}.0", None), ("q", f"1.0 - 2 * (dim % 2) + dim / {G10_DIM}.0", f"p{G10_STEPS}")):
        parts.append(f"{name}0 AS MATERIALIZED (SELECT dim, {unit} AS w FROM (SELECT dim, {start} AS w FROM dims))")
        for t in range(1, G10_STEPS + 1):
            step = f"SELECT c.d1 AS dim, sum(c.c * v.w) AS w FROM cov c JOIN {name}{t - 1} v ON v.dim = c.d2 GROUP BY c.d1"
            if other:
                step = f"SELECT s.dim, s.w - o.w * sum(s.w * o.w) OVER () AS w FROM ({step}) s JOIN {other} o USING (dim)"
            parts.append(f"{name}{t} AS MATERIALIZED (SELECT dim, {unit} AS w FROM ({step}))")
    place = lambda v: f"(SELECT h.doc_id, sum(h.x * v.w) AS s FROM hv h JOIN {v} v USING (dim) GROUP BY h.doc_id)"
    off = lambda v: f"(SELECT sum(mu.mu * v.w) FROM mu JOIN {v} v USING (dim))"
    p, q = f"p{G10_STEPS}", f"q{G10_STEPS}"
    return ",\n".join(parts) + f"""
SELECT m.doc_id, CAST(m.label AS INTEGER) AS label, round(coalesce(a.s, 0) - {off(p)}, 6) AS x, round(coalesce(b.s, 0) - {off(q)}, 6) AS y,
  m.entropy > (SELECT quantile_cont(entropy, 0.85) FROM mem) AS boundary
FROM mem m LEFT JOIN {place(p)} a USING (doc_id) LEFT JOIN {place(q)} b USING (doc_id)"""


@query("g10_projection_2d", _g10_sql())
def g10_projection_2d(spark, sf):
    """Every row's place on the two leading axes, and its boundary flag."""
    mem = _mem(spark, sf)
    flags = profiles.boundary_flags(mem).select("doc_id", "boundary")
    return (profiles.projection_2d(spark, mem, steps=G10_STEPS).join(flags, "doc_id")
            .select("doc_id", "label", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "boundary"))


# ---------------------------------------------------------------- A8: analysis tables

def _through_json(spark, name, df):
    """An analysis table written as JSON and read back with its own, possibly nested, schema."""
    path = scratch_path(spark, name)
    tb.write_json(df, path)
    return spark.read.schema(df.schema).json(path)


@query("a8_k_sweep_table", _f4_sql())
def a8_k_sweep_table(spark, sf):
    return _through_json(spark, "a8-k", f4_k_sweep(spark, sf))


@query("a8_fuzziness_table", _f5_sql())
def a8_fuzziness_table(spark, sf):
    return _through_json(spark, "a8-m", f5_fuzziness_sweep(spark, sf))


@query("a8_profiles_table", ORACLES["g5_profiles"])
def a8_profiles_table(spark, sf):
    """Nested profiles: arrays of structs and a map, through JSON."""
    return _flat_profiles(_through_json(spark, "a8-profiles", profiles.profiles(_mem(spark, sf), model.fitted(spark, sf).centroids)))


@query("a8_threshold_table", ORACLES["i5_threshold_sweep"])
def a8_threshold_table(spark, sf):
    return _through_json(spark, "a8-theta", i5_threshold_sweep(spark, sf))
