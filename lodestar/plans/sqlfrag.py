"""DuckDB SQL fragments used to state each registered query independently
for the oracle check (``oracle_sql``).  They restate the same rules as the
Column expressions in ``lodestar.functions`` in plain SQL."""

from __future__ import annotations

# Fixed values, stated here once more so that a wrong one in the engine shows.
SPACE_POINTS = [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
WS = "[" + "".join(f"\\x{{{c:x}}}" for c in SPACE_POINTS) + "]"
NON_WS = "[^" + WS[1:]
MAX_CHARS = 1500
NEWSGROUP_QUOTE = "(writes in|writes:|wrote:|says:|said:|^In article|^Quoted from|^\\||^>)"
NL = "chr(10)"
WSC = "(" + "||".join(f"chr({c})" for c in SPACE_POINTS) + ")"
ATTR_RE2 = r"(?i)\A.{0,60} writes?:\z"
URL_RE2 = r"(?m)^" + WS + r"*https?://" + NON_WS + r"+" + WS + r"*$"


def strip(x: str) -> str:
    return f"trim({x}, {WSC})"


def norm_newlines(x: str) -> str:
    return f"regexp_replace({x}, '\\r\\n?', {NL}, 'g')"


def drop_quoted(x: str) -> str:
    return (f"array_to_string(list_filter(string_split({x}, {NL}), lambda l: NOT starts_with({strip('l')}, '>')), {NL})")


def drop_attribution(x: str) -> str:
    return (f"array_to_string(list_filter(string_split({x}, {NL}), "
            f"lambda l: NOT regexp_matches({strip('l')}, '{ATTR_RE2}')), {NL})")


def drop_quoted_and_attribution(x: str) -> str:
    return (f"array_to_string(list_filter(string_split({x}, {NL}), lambda l: NOT (starts_with({strip('l')}, '>') "
            f"OR regexp_matches({strip('l')}, '{ATTR_RE2}'))), {NL})")


def collapse(x: str) -> str:
    return f"regexp_replace({x}, '\\n{{3,}}', {NL}||{NL}, 'g')"


def drop_urls(x: str) -> str:
    return f"regexp_replace({x}, '{URL_RE2}', '', 'g')"


def strip_truncate(x: str, n: int | None = MAX_CHARS) -> str:
    return strip(x) if n is None else f"substring({strip(x)}, 1, {n})"


def clean_ctes(src: str, keys: str, text: str = "text", out: str = "clean", n: int | None = MAX_CHARS) -> str:
    """CTE chain ``s1..s5`` over ``src``; the last one exposes ``keys, out``."""
    return (f"s1 AS (SELECT {keys}, {norm_newlines(text)} AS t FROM {src}),\n"
            f"s2 AS (SELECT {keys}, {drop_quoted_and_attribution('t')} AS t FROM s1),\n"
            f"s3 AS (SELECT {keys}, {collapse('t')} AS t FROM s2),\n"
            f"s4 AS (SELECT {keys}, {drop_urls('t')} AS t FROM s3),\n"
            f"s5 AS (SELECT {keys}, {strip_truncate('t', n)} AS {out} FROM s4)")


def tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> '')"


def token_count(x: str) -> str:
    return f"len({tokens(x)})"


def alpha_count(x: str) -> str:
    return f"len(list_filter({tokens(x)}, lambda w: regexp_matches(w, '[a-zA-Z]')))"


def is_valid(x: str) -> str:
    return f"({token_count(x)} >= 30 AND {alpha_count(x)} / greatest({token_count(x)}, 1) >= 0.40)"


def content_id(x: str) -> str:
    return f"substring(sha256({x}), 1, 16)"


def strip_header(x: str) -> str:
    return f"regexp_extract({x}, '(?s)\\n\\n(.*)', 1)"


def strip_quotes(x: str) -> str:
    return f"array_to_string(list_filter(string_split({x}, {NL}), lambda l: NOT regexp_matches(l, '{NEWSGROUP_QUOTE}')), {NL})"


def strip_footer(x: str) -> str:
    ls = f"string_split({strip(x)}, {NL})"
    idx = (f"list_max(list_filter(range(0, len({ls})), "
           f"lambda i: regexp_matches({strip(ls + '[i + 1]')}, '\\A-*\\z')))")
    return (f"CASE WHEN coalesce({idx}, 0) > 0 THEN array_to_string({ls}[1:{idx}], {NL}) ELSE {x} END")


CATS = ("cats AS (SELECT source AS category, CAST(row_number() OVER (ORDER BY source) - 1 AS INTEGER) AS label "
        "FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL))")


def corpus(n: int | None) -> str:
    """The clean corpus, its texts cut after ``n`` characters (None: whole)."""
    return (CATS + ",\n"
            "raw AS (SELECT d.doc_id, d.text, c.label FROM documents d LEFT JOIN cats c ON d.source = c.category),\n"
            + clean_ctes("raw", "doc_id, label", n=n) + ",\n"
            "corpus AS (SELECT s5.doc_id, " + content_id("s5.clean") + " AS content_id, s5.clean AS text, s5.label, "
            "cats.category FROM s5 LEFT JOIN cats USING (label) WHERE " + is_valid("s5.clean") + ")")


CORPUS = corpus(None)
CORPUS_CUT = corpus(MAX_CHARS)


def hashed_long(src: str, key: str, text: str, dim: int = 128, name: str = "hv") -> str:
    """Long-form unit hashed vectors ``name(key, dim, x)`` (non-zero entries)."""
    return (f"{name}_tok AS (SELECT {key} AS k, md5(w) AS h FROM (SELECT {key}, "
            f"unnest(list_filter(regexp_split_to_array(lower({text}), '[ \\t\\n\\r\\f]+'), lambda w: w <> '')) AS w FROM {src})),\n"
            f"{name}_cnt AS (SELECT k, CAST(('0x' || substring(h, 1, 8))::BIGINT % {dim} AS INTEGER) AS dim, "
            f"sum(CASE WHEN ('0x' || substring(h, 9, 1))::INTEGER % 2 = 0 THEN 1.0 ELSE -1.0 END)::DOUBLE AS c "
            f"FROM {name}_tok GROUP BY ALL),\n"
            f"{name}_nrm AS (SELECT k, sqrt(sum(c * c)) AS n FROM {name}_cnt GROUP BY k),\n"
            f"{name} AS (SELECT c.k AS {key}, c.dim, CASE WHEN n.n > 1e-10 THEN c.c / n.n ELSE c.c END AS x "
            f"FROM {name}_cnt c JOIN {name}_nrm n USING (k) WHERE c.c <> 0)")


POSTS = ("posts AS (SELECT c.conv_id, c.turn, concat('From: ', c.role, '@example.org', chr(10), "
         "'Subject: turn ', CAST(c.turn AS VARCHAR), chr(10), chr(10), c.role, ' writes:', chr(10), "
         "'> ', c.text, chr(13), chr(10), c.text, chr(13), chr(10), chr(10), chr(10), chr(10), "
         "coalesce(p.url, 'http://example.org/c/' || CAST(c.conv_id AS VARCHAR)), chr(10), "
         "'   ', c.text, '  ', chr(10), '-- ', chr(10), c.role, ' signature') AS raw "
         "FROM conversations c LEFT JOIN pages p ON p.page_id = c.conv_id)")


def fcm_ctes(steps: int, k: int, m: float, seed: int, ids: str = "corpus", vec: str = "hv", tag: str = "") -> str:
    """Unrolled fuzzy c-means in long form: u0 (seeded md5 init), then for
    t = 1..steps: v{t} (centroids from u{t-1}), d{t} (floored squared
    distances), u{t} = memb(v{t}), plus per-step loss and delta.  ``vec`` is
    ``(doc_id, dim, x)`` over non-zero entries; ``tag`` prefixes every name."""
    e = 1.0 / (m - 1.0)
    g = tag
    parts = [
        f"{g}xx AS MATERIALIZED (SELECT doc_id, sum(x * x) AS xx FROM {vec} GROUP BY doc_id)",
        f"{g}u0r AS (SELECT c.doc_id, g.k::INTEGER AS k, "
        f"(('0x' || substring(md5('{seed}|' || CAST(c.doc_id AS VARCHAR) || '|' || CAST(g.k AS VARCHAR)), 1, 8))::BIGINT + 1) "
        f"/ 4294967296.0 AS r FROM {ids} c CROSS JOIN range(0, {k}) g(k))",
        f"{g}u0 AS MATERIALIZED (SELECT doc_id, k, r / sum(r) OVER (PARTITION BY doc_id) AS u FROM {g}u0r)",
    ]
    for t in range(1, steps + 1):
        p = t - 1
        parts += [
            f"{g}w{t} AS MATERIALIZED (SELECT k, sum(pow(u, {m})) AS w FROM {g}u{p} GROUP BY k)",
            f"{g}v{t} AS MATERIALIZED (SELECT u.k, x.dim, sum(pow(u.u, {m}) * x.x) / any_value(w.w) AS v "
            f"FROM {g}u{p} u JOIN {vec} x USING (doc_id) JOIN {g}w{t} w USING (k) GROUP BY u.k, x.dim)",
            f"{g}vv{t} AS MATERIALIZED (SELECT k, sum(v * v) AS vv FROM {g}v{t} GROUP BY k)",
            f"{g}xv{t} AS MATERIALIZED (SELECT x.doc_id, v.k, sum(x.x * v.v) AS xv FROM {vec} x JOIN {g}v{t} v USING (dim) GROUP BY x.doc_id, v.k)",
            f"{g}d{t} AS MATERIALIZED (SELECT xx.doc_id, vv.k, greatest(xx.xx - 2.0 * coalesce(xv.xv, 0) + vv.vv, 1e-10) AS d "
            f"FROM {g}xx xx CROSS JOIN {g}vv{t} vv LEFT JOIN {g}xv{t} xv ON xv.doc_id = xx.doc_id AND xv.k = vv.k)",
            f"{g}u{t} AS MATERIALIZED (SELECT doc_id, k, pow(1.0 / d, {e}) / sum(pow(1.0 / d, {e})) OVER (PARTITION BY doc_id) AS u FROM {g}d{t})",
            f"{g}h{t} AS (SELECT {p} AS iter, (SELECT sum(pow(u.u, {m}) * d.d) FROM {g}u{t} u JOIN {g}d{t} d USING (doc_id, k)) AS loss, "
            f"(SELECT max(abs(a.u - b.u)) FROM {g}u{t} a JOIN {g}u{p} b USING (doc_id, k)) AS delta)",
        ]
    parts.append(f"{g}hist AS (" + " UNION ALL ".join(f"SELECT * FROM {g}h{t}" for t in range(1, steps + 1)) + ")")
    return ",\n".join(parts)


def fcm_until(k: int, m: float, tol: float, max_iter: int, seed: int, tag: str = "") -> str:
    """Fuzzy c-means run until no membership moves by ``tol``, at most ``max_iter`` steps, as a recursive CTE ``fit(iter,
    doc_id, k, u, loss, delta)``; step 0 is the start.  The statement begins with WITH RECURSIVE."""
    e = 1.0 / (m - 1.0)
    g = tag
    return ",\n".join([
        f"{g}xx AS MATERIALIZED (SELECT doc_id, sum(x * x) AS xx FROM hv GROUP BY doc_id)",
        f"{g}u0r AS (SELECT c.doc_id, g.k::INTEGER AS k, (('0x' || substring(md5('{seed}|' || CAST(c.doc_id AS VARCHAR) || '|' || CAST(g.k AS VARCHAR)), 1, 8))::BIGINT + 1) "
        f"/ 4294967296.0 AS r FROM corpus c CROSS JOIN range(0, {k}) g(k))",
        f"""{g}fit AS (SELECT 0 AS iter, doc_id, k, r / sum(r) OVER (PARTITION BY doc_id) AS u, 0.0::DOUBLE AS loss, 1.0::DOUBLE AS delta FROM {g}u0r
  UNION ALL SELECT iter, doc_id, k, u, loss, delta FROM (
    WITH cur AS (SELECT * FROM {g}fit WHERE iter < {max_iter} AND delta >= {tol}),
    w AS (SELECT k, sum(pow(u, {m})) AS w FROM cur GROUP BY k),
    v AS (SELECT c.k, x.dim, sum(pow(c.u, {m}) * x.x) / any_value(w.w) AS v FROM cur c JOIN hv x USING (doc_id) JOIN w USING (k) GROUP BY c.k, x.dim),
    vv AS (SELECT k, sum(v * v) AS vv FROM v GROUP BY k),
    xv AS (SELECT x.doc_id, v.k, sum(x.x * v.v) AS xv FROM hv x JOIN v USING (dim) GROUP BY x.doc_id, v.k),
    d AS (SELECT c.iter, c.doc_id, c.k, c.u AS before, greatest(xx.xx - 2.0 * coalesce(xv.xv, 0) + vv.vv, 1e-10) AS d
      FROM cur c JOIN {g}xx xx ON xx.doc_id = c.doc_id JOIN vv ON vv.k = c.k LEFT JOIN xv ON xv.doc_id = c.doc_id AND xv.k = c.k),
    n AS (SELECT iter, doc_id, k, before, d, pow(1.0 / d, {e}) / sum(pow(1.0 / d, {e})) OVER (PARTITION BY doc_id) AS u FROM d)
    SELECT iter + 1 AS iter, doc_id, k, u, sum(pow(u, {m}) * d) OVER () AS loss, max(abs(u - before)) OVER () AS delta FROM n))"""])


def membership_of(src: str, vec: str, cent: str, m: float, key: str = "doc_id") -> str:
    """SELECT producing ``(key, k, u)`` memberships of ``vec(key, dim, x)`` rows
    of ``src`` against centroids ``cent(k, dim, v)``."""
    e = 1.0 / (m - 1.0)
    return (f"(SELECT doc_id AS {key}, k, pow(1.0 / d, {e}) / sum(pow(1.0 / d, {e})) OVER (PARTITION BY doc_id) AS u FROM ("
            f"SELECT s.{key} AS doc_id, vv.k, greatest(coalesce(qx.xx, 0) - 2.0 * coalesce(qv.xv, 0) + vv.vv, 1e-10) AS d "
            f"FROM {src} s CROSS JOIN (SELECT k, sum(v * v) AS vv FROM {cent} GROUP BY k) vv "
            f"LEFT JOIN (SELECT {key}, sum(x * x) AS xx FROM {vec} GROUP BY {key}) qx ON qx.{key} = s.{key} "
            f"LEFT JOIN (SELECT x.{key}, c.k, sum(x.x * c.v) AS xv FROM {vec} x JOIN {cent} c USING (dim) GROUP BY x.{key}, c.k) qv "
            f"ON qv.{key} = s.{key} AND qv.k = vv.k))")
