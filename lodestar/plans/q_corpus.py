"""Registered queries for sources (A), text (B), vectors (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions import text as tx
from lodestar.functions.vectors import dot, l2_norm, l2_normalize
from lodestar.operators import corpus as cp
from lodestar.operators.encode import encode_incremental, encode_queries
from lodestar.plans import common
from lodestar.plans import sqlfrag as S
from lodestar.plans.registry import query
from lodestar.session import bounded_broadcast, scratch_path, spread
from lodestar.sources import tables as tb
from lodestar.sources.versions import VersionedTable

R6 = 6
MAX_CENTROIDS = 10_000  # category centroids that may be broadcast


# ---------------------------------------------------------------- A: sources

@query("a1_scan_corpus", "WITH " + S.CATS + """
SELECT d.doc_id, c.label, CASE WHEN ('0x' || substring(md5('split|' || CAST(d.doc_id AS VARCHAR)), 1, 8))::BIGINT % 5 = 0
       THEN 'test' ELSE 'train' END AS split, length(d.text) AS text_chars
FROM documents d LEFT JOIN cats c ON d.source = c.category""")
def a1_scan_corpus(spark, sf):
    return tb.scan_corpus(spark, sf).select("doc_id", "label", "split", F.length("text").alias("text_chars"))


@query("a1_scan_test_split", "WITH " + S.CATS + """
SELECT d.doc_id, c.label FROM documents d LEFT JOIN cats c ON d.source = c.category
WHERE ('0x' || substring(md5('split|' || CAST(d.doc_id AS VARCHAR)), 1, 8))::BIGINT % 5 = 0""")
def a1_scan_test_split(spark, sf):
    return tb.scan_corpus(spark, sf, subset="test").select("doc_id", "label")


@query("a2_decode_labels", "WITH " + S.CATS + """
SELECT e.vec_id, e.label, c.category FROM embeddings e LEFT JOIN cats c ON c.label = e.label""")
def a2_decode_labels(spark, sf):
    """The integer labels of the embeddings, named by the documents' categories."""
    cats = tb.categories(tb.read_table(spark, sf, "documents"))
    return tb.decode_labels(tb.read_table(spark, sf, "embeddings").select("vec_id", "label"), cats).select("vec_id", "label", "category")


#: Clean corpus with its float vectors, reloaded from written tables.
RELOAD_SQL = "WITH " + S.CORPUS + ",\n" + S.hashed_long("corpus", "doc_id", "text") + """,
nz AS (SELECT doc_id, count(*) AS nnz, round(sum(CAST(x AS FLOAT)), 4) AS xsum FROM hv GROUP BY doc_id)
"""


def _reloaded(spark, sf, name, df, partition_by=None):
    path = scratch_path(spark, name)
    tb.write_table(df, path, partition_by)
    return tb.load_table(spark, path)


@query("a3_persist_corpus", "WITH " + S.CORPUS + "\nSELECT doc_id, content_id, label, category, length(text) AS text_chars FROM corpus")
def a3_persist_corpus(spark, sf):
    c = _reloaded(spark, sf, "a3", common.corpus(spark, sf))
    return c.select("doc_id", "content_id", "label", "category", F.length("text").alias("text_chars"))


@query("a4_float_vectors", RELOAD_SQL + "SELECT doc_id, CAST(nnz AS BIGINT) AS nnz, xsum FROM nz")
def a4_float_vectors(spark, sf):
    """Vectors written and reloaded as ARRAY<FLOAT>."""
    v = common.corpus_vectors(spark, sf).select("doc_id", F.col("embedding").cast("array<float>").alias("embedding"))
    v = _reloaded(spark, sf, "a4", v)
    return v.select("doc_id", F.size(F.filter("embedding", lambda x: x != 0)).cast("long").alias("nnz"),
                    F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x), 4).alias("xsum"))


@query("a6_load_or_missing", "WITH " + S.CORPUS + """
SELECT 'corpus' AS name, true AS found, CAST(count(*) AS BIGINT) AS n FROM corpus UNION ALL SELECT 'missing', false, 0""")
def a6_load_or_missing(spark, sf):
    """A written table with its length, and one that was never written."""
    root = scratch_path(spark, "a6")
    table, missing = VersionedTable(spark, root), VersionedTable(spark, root + "-missing")
    table.publish(common.corpus(spark, sf).select("doc_id"))
    return spark.createDataFrame([("corpus", table.read() is not None, len(table)), ("missing", missing.read() is not None, len(missing))],
                                 "name string, found boolean, n long")


@query("a8_analysis_tables", "WITH " + S.CORPUS + "\nSELECT category, CAST(count(*) AS BIGINT) AS n_docs FROM corpus GROUP BY category")
def a8_analysis_tables(spark, sf):
    """An analysis table through its JSON sink."""
    path = scratch_path(spark, "a8")
    tb.write_json(common.corpus(spark, sf).groupBy("category").agg(F.count(F.lit(1)).alias("n_docs")), path)
    return spark.read.schema("category string, n_docs long").json(path)


@query("a5_vector_table", "WITH " + S.CORPUS + ",\n" + S.hashed_long("corpus", "doc_id", "text") + """
SELECT c.doc_id, c.content_id, length(substring(c.text, 1, 500)) AS snippet_chars, c.category, c.label,
       CAST(count(h.dim) AS BIGINT) AS nnz, round(sqrt(sum(h.x * h.x)), 6) AS norm
FROM corpus c JOIN hv h USING (doc_id) GROUP BY ALL""")
def a5_vector_table(spark, sf):
    """The vector table built, replaced as a whole and reloaded: a first version of half the rows, then one of all."""
    table = VersionedTable(spark, scratch_path(spark, "a5"))
    rows = tb.vector_rows(common.corpus_vectors(spark, sf))
    table.publish(rows.where("doc_id % 2 = 0"), "half")
    vt = table.current(common.inputs(spark, sf), lambda: rows)
    return vt.select("doc_id", "content_id", F.length("text").alias("snippet_chars"), "category", "label",
                     F.size(F.filter("embedding", lambda x: x != 0)).cast("long").alias("nnz"),
                     F.round(l2_norm("embedding"), R6).alias("norm"))


# ---------------------------------------------------------------- B: text

def _posts(spark, sf):
    return common.posts(spark, sf)


@query("b1_strip_header", "WITH " + S.POSTS + f"\nSELECT conv_id, turn, {S.strip_header('raw')} AS out FROM posts")
def b1_strip_header(spark, sf):
    return _posts(spark, sf).select("conv_id", "turn", tx.strip_header("raw").alias("out"))


@query("b2_strip_footer", "WITH " + S.POSTS + f"\nSELECT conv_id, turn, {S.strip_footer('raw')} AS out FROM posts")
def b2_strip_footer(spark, sf):
    return _posts(spark, sf).select("conv_id", "turn", tx.strip_footer("raw").alias("out"))


@query("b3_strip_quotes", "WITH " + S.POSTS + f"\nSELECT conv_id, turn, {S.strip_quotes('raw')} AS out FROM posts")
def b3_strip_quotes(spark, sf):
    return _posts(spark, sf).select("conv_id", "turn", tx.strip_quotes("raw").alias("out"))


@query("b3_newsgroup_loader", "WITH " + S.POSTS + ",\nh AS (SELECT conv_id, turn, " + S.strip_header("raw") +
       " AS t FROM posts),\nf AS (SELECT conv_id, turn, " + S.strip_footer("t") + " AS t FROM h)\n"
       "SELECT conv_id, turn, " + S.strip_quotes("t") + " AS out FROM f")
def b3_newsgroup_loader(spark, sf):
    return _posts(spark, sf).select("conv_id", "turn", tx.strip_newsgroup("raw").alias("out"))


@query("b4_normalise_newlines", "WITH " + S.POSTS + f"\nSELECT conv_id, turn, {S.norm_newlines('raw')} AS out FROM posts")
def b4_normalise_newlines(spark, sf):
    return _posts(spark, sf).select("conv_id", "turn", tx.normalise_newlines("raw").alias("out"))


@query("b5_drop_quoted_lines", "WITH " + S.POSTS +
       f"\nSELECT conv_id, turn, {S.drop_quoted(S.norm_newlines('raw'))} AS out FROM posts")
def b5_drop_quoted_lines(spark, sf):
    t = tx.normalise_newlines("raw")
    out = F.array_join(F.filter(tx.lines_of(t), lambda l: ~tx.strip_ws(l).startswith(">")), "\n")
    return _posts(spark, sf).select("conv_id", "turn", out.alias("out"))


@query("b6_drop_attribution_lines", "WITH " + S.POSTS +
       f"\nSELECT conv_id, turn, {S.drop_attribution(S.norm_newlines('raw'))} AS out FROM posts")
def b6_drop_attribution_lines(spark, sf):
    t = tx.normalise_newlines("raw")
    out = F.array_join(F.filter(tx.lines_of(t), lambda l: ~tx.strip_ws(l).rlike(tx.ATTRIBUTION_LINE)), "\n")
    return _posts(spark, sf).select("conv_id", "turn", out.alias("out"))


@query("b7_collapse_blank_lines", "WITH " + S.POSTS +
       f"\nSELECT conv_id, turn, {S.collapse(S.norm_newlines('raw'))} AS out FROM posts")
def b7_collapse_blank_lines(spark, sf):
    return _posts(spark, sf).select("conv_id", "turn", tx.collapse_blank_lines(tx.normalise_newlines("raw")).alias("out"))


@query("b8_drop_url_lines", "WITH " + S.POSTS +
       f"\nSELECT conv_id, turn, {S.drop_urls(S.collapse(S.norm_newlines('raw')))} AS out FROM posts")
def b8_drop_url_lines(spark, sf):
    t = tx.collapse_blank_lines(tx.normalise_newlines("raw"))
    return _posts(spark, sf).select("conv_id", "turn", tx.drop_url_lines(t).alias("out"))


@query("b9_strip_truncate", f"SELECT doc_id, {S.strip_truncate('text')} AS out FROM documents")
def b9_strip_truncate(spark, sf):
    d = tb.read_table(spark, sf, "documents")
    return d.select("doc_id", tx.strip_and_truncate("text").alias("out"))


@query("b10_clean_text", "WITH " + S.clean_ctes("documents", "doc_id") + "\nSELECT doc_id, clean FROM s5")
def b10_clean_text(spark, sf):
    d = tb.read_table(spark, sf, "documents")
    return d.select("doc_id", tx.clean_text("text").alias("clean"))


@query("b10_clean_posts", "WITH " + S.POSTS + ",\n" + S.clean_ctes("posts", "conv_id, turn", text="raw") +
       "\nSELECT conv_id, turn, clean FROM s5")
def b10_clean_posts(spark, sf):
    return _posts(spark, sf).select("conv_id", "turn", tx.clean_text("raw").alias("clean"))


_TOK_SQL = ("WITH " + S.clean_ctes("documents", "doc_id") + "\nSELECT doc_id, CAST(@N AS INTEGER) AS n_tokens, "
            "CAST(@A AS INTEGER) AS n_alpha, round(CASE WHEN @N > 0 THEN @A / @N END, 6) AS alpha_ratio, "
            "@V AS valid FROM s5").replace("@N", S.token_count("clean")).replace(
                "@A", S.alpha_count("clean")).replace("@V", S.is_valid("clean"))


def _tok(spark, sf):
    d = tb.read_table(spark, sf, "documents")
    return cp.cleaned(d, ["doc_id"]).select(
        "doc_id", tx.token_count("clean").cast("int").alias("n_tokens"),
        tx.alpha_token_count("clean").cast("int").alias("n_alpha"),
        F.round(tx.alpha_ratio("clean"), 6).alias("alpha_ratio"), tx.is_valid("clean").alias("valid"))


@query("b11_token_count", _TOK_SQL.replace("SELECT doc_id, CAST(", "SELECT * FROM (SELECT doc_id, CAST(") + ") q")
def b11_token_count(spark, sf):
    return _tok(spark, sf)


@query("b12_alpha_ratio", "SELECT doc_id, alpha_ratio FROM (" + _TOK_SQL + ") q")
def b12_alpha_ratio(spark, sf):
    return _tok(spark, sf).select("doc_id", "alpha_ratio")


@query("b13_is_valid", "SELECT doc_id FROM (" + _TOK_SQL + ") q WHERE valid")
def b13_is_valid(spark, sf):
    d = tb.read_table(spark, sf, "documents")
    return cp.cleaned(d, ["doc_id"]).where(tx.is_valid("clean")).select("doc_id")


@query("b14_content_id", "WITH " + S.clean_ctes("documents", "doc_id") +
       f"\nSELECT doc_id, {S.content_id('clean')} AS content_id FROM s5")
def b14_content_id(spark, sf):
    d = tb.read_table(spark, sf, "documents")
    return cp.cleaned(d, ["doc_id"]).select("doc_id", tx.content_id("clean").alias("content_id"))


@query("b15_retention", "WITH " + S.clean_ctes("documents", "doc_id, source") + f"""
SELECT source AS category, CAST(sum(CASE WHEN {S.is_valid('clean')} THEN 1 ELSE 0 END) AS BIGINT) AS kept,
       CAST(sum(CASE WHEN {S.is_valid('clean')} THEN 0 ELSE 1 END) AS BIGINT) AS discarded,
       round(sum(CASE WHEN {S.is_valid('clean')} THEN 0 ELSE 1 END) * 100.0 / count(*), 1) AS pct_discarded
FROM s5 GROUP BY source""")
def b15_retention(spark, sf):
    d = tb.read_table(spark, sf, "documents").select("doc_id", F.col("source").alias("category"), "text")
    return cp.retention_report(d, by="category")


@query("b15_retention_total", "WITH " + S.clean_ctes("documents", "doc_id") + f"""
SELECT CAST(sum(CASE WHEN {S.is_valid('clean')} THEN 1 ELSE 0 END) AS BIGINT) AS kept,
       CAST(sum(CASE WHEN {S.is_valid('clean')} THEN 0 ELSE 1 END) AS BIGINT) AS discarded,
       round(sum(CASE WHEN {S.is_valid('clean')} THEN 0 ELSE 1 END) * 100.0 / count(*), 1) AS pct_discarded
FROM s5""")
def b15_retention_total(spark, sf):
    d = tb.read_table(spark, sf, "documents").select("doc_id", "text")
    return cp.retention_report(d)


@query("b15_observed_retention", "WITH " + S.CORPUS + """
SELECT CAST((SELECT count(*) FROM corpus) AS BIGINT) AS kept, CAST(count(*) - (SELECT count(*) FROM corpus) AS BIGINT) AS discarded FROM documents""")
def b15_observed_retention(spark, sf):
    """Totals of whole texts, observed while the corpus is written."""
    cats = tb.categories(tb.read_table(spark, sf, "documents"))
    raw = spread(tb.scan_corpus(spark, sf, cats=cats))
    r = cp.write_corpus(VersionedTable(spark, scratch_path(spark, "b15")), raw, cats)
    return spark.createDataFrame([(r["kept"], r["discarded"])], "kept long, discarded long")


@query("b16_duplicate_groups", "WITH " + S.CORPUS + """
SELECT content_id, CAST(count(*) AS BIGINT) AS n_copies, min(doc_id) AS keep_doc_id FROM corpus GROUP BY content_id""")
def b16_duplicate_groups(spark, sf):
    return cp.duplicate_groups(common.corpus(spark, sf))


@query("b16_dedup", "WITH " + S.CORPUS + """
SELECT content_id, doc_id, label FROM corpus WHERE doc_id IN (SELECT min(doc_id) FROM corpus GROUP BY content_id)""")
def b16_dedup(spark, sf):
    return cp.dedup(common.corpus(spark, sf)).select("content_id", "doc_id", "label")


@query("b17_prepare_corpus", "WITH " + S.CORPUS_CUT + """
SELECT doc_id, content_id, label, category, length(text) AS text_chars FROM corpus""")
def b17_prepare_corpus(spark, sf):
    return common.prepared(spark, sf, tx.MAX_CHARS).select("doc_id", "content_id", "label", "category",
                                                           F.length("text").alias("text_chars"))


@query("b18_snippets", "WITH " + S.CORPUS + """
SELECT doc_id, length(substring(text, 1, 500)) AS n500, length(substring(text, 1, 300)) AS n300,
       length(substring(text, 1, 250)) AS n250, substring(text, 1, 120) AS s120 FROM corpus""")
def b18_snippets(spark, sf):
    c = common.corpus(spark, sf)
    return c.select("doc_id", F.length(tx.snippet("text", 500)).alias("n500"),
                    F.length(tx.snippet("text", 300)).alias("n300"),
                    F.length(tx.snippet("text", 250)).alias("n250"), tx.snippet("text", 120).alias("s120"))


# ---------------------------------------------------------------- C: vectors

@query("c1_hashed_vectors", "WITH " + S.CORPUS + ",\n" + S.hashed_long("corpus", "doc_id", "text") + """
SELECT doc_id, dim, round(x, 9) AS x FROM hv""")
def c1_hashed_vectors(spark, sf):
    v = common.corpus_vectors(spark, sf)
    return (v.select("doc_id", F.posexplode("embedding").alias("dim", "x"))
            .where("x != 0").select("doc_id", F.col("dim").cast("int").alias("dim"), F.round("x", 9).alias("x")))


@query("c2_l2_normalize", """
WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
n AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM e GROUP BY vec_id),
u AS (SELECT e.vec_id, e.i, CASE WHEN n.n > 1e-10 THEN e.x / n.n ELSE e.x END AS y FROM e JOIN n USING (vec_id))
SELECT vec_id, round(any_value(n.n), 6) AS norm_in, round(sqrt(sum(y * y)), 6) AS norm_out,
       round(max(CASE WHEN i = 1 THEN y END), 6) AS first
FROM u JOIN n USING (vec_id) GROUP BY vec_id""")
def c2_l2_normalize(spark, sf):
    e = tb.read_table(spark, sf, "embeddings")
    u = e.select("vec_id", l2_norm("embedding").alias("norm_in"), l2_normalize("embedding").alias("u"))
    return u.select("vec_id", F.round("norm_in", R6).alias("norm_in"), F.round(l2_norm("u"), R6).alias("norm_out"),
                    F.round(F.get("u", 0), R6).alias("first"))


def _category_centroids(vecs):
    """Unit mean vector per category: ``(category, centroid)``.  Partial
    aggregation per (category, dim) keeps a hot category from piling into
    one task; the result has (#categories x D) rows."""
    long = vecs.select("category", F.posexplode("embedding").alias("dim", "x"))
    mean = long.groupBy("category", "dim").agg(F.avg("x").alias("x"))
    arr = mean.groupBy("category").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("dim", "x"))), lambda s: s["x"]).alias("c"))
    return arr.select("category", l2_normalize("c").alias("centroid"))


@query("c3_cosine_to_category", "WITH " + S.CORPUS + ",\n" + S.hashed_long("corpus", "doc_id", "text") + """,
dv AS (SELECT h.doc_id, c.category, h.dim, h.x FROM hv h JOIN corpus c USING (doc_id)),
ncat AS (SELECT category, count(*) AS n FROM corpus GROUP BY category),
cm AS (SELECT dv.category, dim, sum(x) / any_value(ncat.n) AS m FROM dv JOIN ncat USING (category) GROUP BY dv.category, dim),
cn AS (SELECT category, sqrt(sum(m * m)) AS n FROM cm GROUP BY category),
cu AS (SELECT cm.category, dim, CASE WHEN cn.n > 1e-10 THEN m / cn.n ELSE m END AS u FROM cm JOIN cn USING (category))
SELECT c.doc_id, c.category, round(coalesce(sum(dv.x * cu.u), 0), 6) AS cosine
FROM corpus c LEFT JOIN dv USING (doc_id) LEFT JOIN cu ON cu.category = c.category AND cu.dim = dv.dim
GROUP BY c.doc_id, c.category""")
def c3_cosine_to_category(spark, sf):
    v = common.corpus_vectors(spark, sf).select("doc_id", "category", "embedding")
    j = v.join(bounded_broadcast(_category_centroids(v), MAX_CENTROIDS)[0], "category")
    return j.select("doc_id", "category", F.round(dot("embedding", "centroid"), R6).alias("cosine"))


@query("c4_incremental_encode", "WITH " + S.CORPUS + """,
todo AS (SELECT * FROM corpus WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
""" + S.hashed_long("todo", "doc_id", "text") + """
SELECT t.doc_id, CAST(count(h.dim) AS BIGINT) AS nnz FROM todo t LEFT JOIN hv h USING (doc_id) GROUP BY t.doc_id""")
def c4_incremental_encode(spark, sf):
    c = common.corpus(spark, sf)
    done = tb.read_table(spark, sf, "labels")
    e = encode_incremental(c, done)
    return e.select("doc_id", F.size(F.filter("embedding", lambda x: x != 0)).cast("long").alias("nnz"))


_LANG_CENT = """langs AS (SELECT lang, CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS cluster FROM (SELECT DISTINCT lang FROM documents)),
dl AS (SELECT h.doc_id, l.cluster, h.dim, h.x FROM hv h JOIN documents d USING (doc_id) JOIN langs l ON l.lang = d.lang),
nl AS (SELECT l.cluster, count(*) AS n FROM corpus c JOIN documents d USING (doc_id) JOIN langs l ON l.lang = d.lang GROUP BY l.cluster),
cent AS (SELECT dl.cluster, dim, sum(x) / any_value(nl.n) AS v FROM dl JOIN nl USING (cluster) GROUP BY dl.cluster, dim)"""


@query("c5_sq_dist", "WITH " + S.CORPUS + ",\n" + S.hashed_long("corpus", "doc_id", "text") + ",\n" + _LANG_CENT + """,
cnorm AS (SELECT cluster, sum(v * v) AS vv FROM cent GROUP BY cluster),
dots AS (SELECT h.doc_id, c.cluster, sum(h.x * c.v) AS xv FROM hv h JOIN cent c USING (dim) GROUP BY h.doc_id, c.cluster),
xx AS (SELECT doc_id, sum(x * x) AS xx FROM hv GROUP BY doc_id)
SELECT xx.doc_id, k.cluster, round(greatest(xx.xx - 2 * coalesce(d.xv, 0) + k.vv, 1e-10), 6) AS d
FROM xx CROSS JOIN cnorm k LEFT JOIN dots d ON d.doc_id = xx.doc_id AND d.cluster = k.cluster""")
def c5_sq_dist(spark, sf):
    from lodestar.operators.fcm import centroids_from_labels, sq_dists_long
    v = common.corpus_with_lang(spark, sf)
    cents = centroids_from_labels(v, "lang")
    return sq_dists_long(v.select("doc_id", "embedding"), cents).select(
        "doc_id", "cluster", F.round("d", R6).alias("d"))


@query("c6_embed_queries", "WITH q AS (SELECT DISTINCT text FROM benchmark),\n" + S.hashed_long("q", "text", "text") + """
SELECT substring(sha256(q.text), 1, 16) AS qkey, CAST(count(h.dim) AS BIGINT) AS nnz, round(coalesce(sum(h.x), 0), 9) AS xsum
FROM q LEFT JOIN hv h USING (text) GROUP BY q.text""")
def c6_embed_queries(spark, sf):
    b = tb.read_table(spark, sf, "benchmark").select(F.col("text").alias("query"))
    e = encode_queries(b, "query")
    return e.select(tx.content_id("query").alias("qkey"),
                    F.size(F.filter("embedding", lambda x: x != 0)).cast("long").alias("nnz"),
                    F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x), 9).alias("xsum"))
