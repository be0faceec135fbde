"""The registered queries of the ten operators and of the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Distinct shingle sets, links on whole sets, and components by label propagation.
OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
k AS (SELECT sh FROM s GROUP BY sh HAVING count(*) > 1),
c AS (SELECT doc_id, sh FROM s SEMI JOIN k USING (sh)),
i AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS same FROM c a JOIN c b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT u, v FROM i JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * same >= 80 * (x.n + y.n - same)),
r AS (SELECT doc_id, doc_id AS to_id FROM documents UNION SELECT r.doc_id, e.v FROM r JOIN e ON e.u = r.to_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id, m.c = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(to_id) AS c FROM r GROUP BY 1) m USING (doc_id)
"""


@query("op4_minhash_dedup", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on 4-word shingles."""
    from lodestar.llm.minhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), k=4)


#: Every window's words as one string; the smallest id of each keeps it.
OP10_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(ws) - 48)) AS i, ws FROM w WHERE len(ws) >= 50),
k AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS k FROM s),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS first FROM k) WHERE first < doc_id),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM d),
p AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
t AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM p ANTI JOIN c USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(t.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN t USING (doc_id)
"""


@query("op10_substring_dedup", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words that a document with a smaller id holds are cut from all documents."""
    from lodestar.llm.substring import drop_repeats
    return drop_repeats(table(spark, sf_dir, "documents"), width=50)


#: Base counts, tested cutoffs and verdicts.  Fixed values: the risk 0.02 and error 0.05 are shared by 6 rules and all strata.
OP6_SQL = r"""
WITH w AS (SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM documents),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i,
  unnest(list_transform(range(1, len(ws) - 1), lambda i: concat(ws[i], ' ', ws[i + 1], ' ', ws[i + 2]))) AS g FROM w WHERE len(ws) >= 3)),
v AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g WHERE c > 1) GROUP BY doc_id),
f AS (SELECT w.doc_id, lang, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(v.n, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper
  FROM w LEFT JOIN v USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
grid AS (SELECT rule, unnest(range(1, len(cuts) + 1)) AS i, unnest(cuts) AS cut FROM (VALUES
  ('symbols_per_word', [2.0, 1.5, 1.0, 0.75, 0.5, 0.35, 0.25, 0.15, 0.1]::DOUBLE[]), ('upper_share', [0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1]),
  ('dup_line_share', [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3]), ('repeat_share', [0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1]),
  ('word_length', [12.0, 10.0, 9.0, 8.5, 8.0, 7.5, 7.0, 6.5]), ('word_shortness', [-2.0, -2.5, -3.0, -3.25, -3.5, -3.75, -4.0])) x(rule, cuts)),
m AS (SELECT doc_id, lang, unnest(['symbols_per_word', 'upper_share', 'dup_line_share', 'repeat_share', 'word_length', 'word_shortness']) AS rule,
  unnest([n_symbols / n_words, n_upper / word_chars, n_dup_lines / n_lines, n_repeat_words / n_words, word_chars / n_words, -word_chars / n_words]) AS x
  FROM b WHERE NOT base_failed),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1),
cell AS (SELECT m.lang, grid.rule, grid.i, any_value(grid.cut) AS cut, count(*) AS n, count(*) FILTER (WHERE m.x > grid.cut) AS k
  FROM m SEMI JOIN good USING (doc_id) JOIN grid USING (rule) GROUP BY m.lang, grid.rule, grid.i),
test AS (SELECT *, CASE WHEN k >= n * 0.02 / 6 THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
  + j * ln(0.02 / 6) + (n - j) * ln(1 - 0.02 / 6)))) END * 6 * (SELECT count(*) FROM (SELECT DISTINCT lang FROM cell)) <= 0.05 AS ok FROM cell),
cuts AS (SELECT lang, rule, min(cut) AS cut FROM (SELECT *, coalesce(min(CASE WHEN NOT ok THEN i END) OVER (PARTITION BY lang, rule), 1000) AS stop FROM test)
  WHERE i < stop GROUP BY lang, rule),
bad AS (SELECT DISTINCT m.doc_id FROM m JOIN cuts ON cuts.rule = m.rule AND cuts.lang IS NOT DISTINCT FROM m.lang AND m.x > cuts.cut)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.doc_id IS NULL AS kept
FROM b LEFT JOIN bad ON bad.doc_id = b.doc_id
"""


@query("op6_quality_rules", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdicts for all documents, with cutoffs from the labelled ones."""
    from lodestar.llm.quality import judge
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op2_mix_sources")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document a mix of 150 % of all words takes."""
    from lodestar.llm.mixing import mix
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def tokenizer():
    """The byte-level BPE of 50,257 ids; its files come with the ``public_tokenizers`` package of every worker."""
    import public_tokenizers

    from lodestar.llm.packing import byte_bpe
    return byte_bpe(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op9_pack_sequences")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of 2048 tokens."""
    from lodestar.llm.packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer(), capacity=2048)


@query("op1_main_text")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from lodestar.llm.maintext import extract_pages
    return extract_pages(table(spark, sf_dir, "pages"))


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    from lodestar.llm.langid import identify
    return identify(table(spark, sf_dir, "documents"))


@query("op8_url_filter")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    from lodestar.llm.urlfilter import judge_urls
    return judge_urls(table(spark, sf_dir, "pages"))


@query("op7_nearest_vectors")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every 20th one, against all."""
    from lodestar.llm.forest import nearest
    return nearest(table(spark, sf_dir, "embeddings"))


@query("op5_license_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The license notices and texts that each document holds."""
    from lodestar.llm.licenses import scan_documents
    return scan_documents(table(spark, sf_dir, "documents"))


#: Damage by crc32 (its table from the rule), faults, and the least (cost, letters) per state, row after row.  Fixed values: the four states' insertions.
OP13_SQL = r"""WITH RECURSIVE t AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
  lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
r AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS key FROM conversations),
w AS (SELECT r.*, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: xor(t.t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 20 AS draw FROM r, t),
d AS (SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
  CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE draw WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM w),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
  lag(role[1]) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) || role[1] AS pair,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM d),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
  WHEN regexp_matches(text, '[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM o),
ins(state, after, cost, letters, pieces) AS (VALUES (0, 0, 0, '', []::VARCHAR[]), (0, 2, 5, 'I', ['user:']), (0, 3, 10, 'II', ['user:', 'assistant:']),
  (1, 1, 0, '', []), (1, 2, 5, 'I', ['user:']), (1, 3, 10, 'II', ['user:', 'assistant:']), (2, 2, 0, '', []), (2, 3, 5, 'I', ['assistant:']),
  (3, 3, 0, '', []), (3, 2, 5, 'I', ['user:'])),
c AS (SELECT DISTINCT conv_id FROM conversations),
p AS (SELECT conv_id, 0::BIGINT AS i, 0 AS state, {'cost': 0::BIGINT, 'audit': '', 'kept': []::VARCHAR[]} AS best FROM c
  UNION ALL
  SELECT conv_id, i, state, min(best) AS best FROM (
    SELECT p.conv_id, f.i, CASE op WHEN 'D' THEN after WHEN 'K' THEN CASE role[1] WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END ELSE CASE after WHEN 2 THEN 3 ELSE 2 END END AS state,
      {'cost': p.best.cost + ins.cost + CASE op WHEN 'D' THEN 2 WHEN 'K' THEN 0 ELSE 1 END + CASE WHEN op <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END,
       'audit': p.best.audit || ins.letters || op,
       'kept': p.best.kept || ins.pieces || CASE op WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text] ELSE [CASE after WHEN 2 THEN 'assistant:' ELSE 'user:' END || text] END} AS best
    FROM p JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1 JOIN ins ON ins.state = p.state CROSS JOIN (VALUES ('D'), ('K'), ('R')) x(op)
    WHERE op = 'D' OR fault NOT IN ('blank', 'duplicate') AND (op = 'R' OR role[1] = 's' AND after = 0 OR role[1] = 'u' AND after IN (0, 1, 3) OR role[1] = 'a' AND after = 2))
  GROUP BY conv_id, i, state),
e AS (SELECT p.conv_id, min({'cost': p.best.cost + ins.cost, 'audit': p.best.audit || ins.letters, 'kept': p.best.kept || ins.pieces}) AS best
  FROM p JOIN ins ON ins.state = p.state JOIN (SELECT c.conv_id, count(f.i) AS n FROM c LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id) z
  ON z.conv_id IS NOT DISTINCT FROM p.conv_id AND z.n = p.i WHERE after IN (0, 3) GROUP BY p.conv_id),
s AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
  count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
  count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(e.best.cost AS BIGINT) AS cost,
  e.best.audit AS audit, sha256(array_to_string(e.best.kept, chr(10))) AS repaired_sha256
FROM e LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM e.conv_id
"""


@query("op13_repair_conversations", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage, faults and cheapest repair of every conversation."""
    from lodestar.llm.repair import repair_conversations
    return repair_conversations(table(spark, sf_dir, "conversations"))


#: Counts of every kept term in every group, zeros included; sums of differences over all pairs of sources.
OP12_SQL = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
k AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(ws)) AS term FROM d) GROUP BY lang, term HAVING count(*) >= 30),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(ws) AS term FROM d) SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
f AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN k ON k.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT f.lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY f.lang, source) + 5 * v) AS p FROM f JOIN v ON v.lang = f.lang),
q AS (SELECT t.lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY t.lang) + 5 * v) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term) t JOIN v ON v.lang = t.lang),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT p.lang, p.source, 'term', p.term, p.p - q.q FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE n > 0 AND p.p > q.q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r) WHERE part = 'pair' OR rank <= 50
"""


@query("op12_source_divergence", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language lie apart, and the terms that mark each source."""
    from lodestar.llm.divergence import divergence
    return divergence(table(spark, sf_dir, "documents"))


@query("op11_document_fingerprints")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    from lodestar.llm.fingerprint import fingerprint_documents
    return fingerprint_documents(table(spark, sf_dir, "documents"))
