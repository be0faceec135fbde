"""Text projections and predicates as native Column expressions.

No Python UDFs: everything stays inside Catalyst so that pruning and
pushdown keep working and the work runs JVM-side.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the cleaning rules being reproduced.
# WS is the set of characters Python's str.isspace() accepts, written in a
# regex syntax that both Java regex and RE2 understand.
WS = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NON_WS = r"[^\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# Java-side form of the same set: Unicode White_Space plus U+001C-U+001F
# (checked equal to str.isspace() over the BMP in the tests); much cheaper
# to evaluate than the explicit range list.
WS_J = r"(?U:[\s\x{1c}-\x{1f}])"
NON_WS_J = r"(?U:[^\s\x{1c}-\x{1f}])"
MAX_CHARS = 1500
MIN_TOKENS = 30
MIN_ALPHA_RATIO = 0.40
ATTRIBUTION_LINE = r"(?iud)\A.{0,60} writes?:\z"
URL_ONLY_LINE = r"(?md)^" + WS_J + r"*https?://" + NON_WS_J + r"+" + WS_J + r"*$"
NEWSGROUP_QUOTE = r"(writes in|writes:|wrote:|says:|said:|^In article|^Quoted from|^\||^>)"
# The same whitespace set as plain characters, for btrim.
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
            "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
            "\u2028\u2029\u202f\u205f\u3000")
SNIPPET_STORED = 500
SNIPPET_REPRESENTATIVE = 300
SNIPPET_BOUNDARY = 250
SNIPPET_SUMMARY = 120
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col) -> Column:
    """Python ``str.strip()``: trim Unicode whitespace at both ends."""
    return F.btrim(_c(col), F.lit(WS_CHARS))


def lines_of(col) -> Column:
    """``text.split('\\n')`` keeping empty trailing pieces."""
    return F.split(_c(col), "\n", -1)


# -- newsgroup loader strippers (B1-B3) -------------------------------------

def strip_header(col) -> Column:
    """B1: text after the first blank line, '' if there is none."""
    return F.regexp_extract(_c(col), r"(?s)\n\n(.*)", 1)


def strip_footer(col) -> Column:
    """B2: after trimming, cut at the last line that is blank or only
    dashes, unless that line is the first one (then keep the text)."""
    lines = lines_of(strip_ws(col))
    idx = F.array_max(F.filter(
        F.sequence(F.lit(0), F.size(lines) - 1),
        lambda i: strip_ws(F.get(lines, i)).rlike(r"\A-*\z")))
    return F.when(F.coalesce(idx, F.lit(0)) > 0,
                  F.array_join(F.slice(lines, F.lit(1), idx), "\n")).otherwise(_c(col))


def strip_quotes(col) -> Column:
    """Drop lines that look like quotations or their attributions."""
    return F.array_join(F.filter(lines_of(col), lambda ln: ~ln.rlike(NEWSGROUP_QUOTE)), "\n")


def strip_newsgroup(col) -> Column:
    """Loader order: headers, then footers, then quotes."""
    return strip_quotes(strip_footer(strip_header(col)))


# -- clean_text (B4-B10) -------------------------------------------------------

def normalise_newlines(col) -> Column:
    """CRLF and lone CR become LF (the regex only runs on texts that
    hold a CR at all)."""
    c = _c(col)
    return F.when(c.contains("\r"), F.regexp_replace(c, "\r\n?", "\n")).otherwise(c)


def _keep_line(line: Column) -> Column:
    s = strip_ws(line)
    return ~(s.startswith(">") | (s.endswith(":") & s.rlike(ATTRIBUTION_LINE)))


def drop_quoted_and_attribution(col) -> Column:
    """B5 + B6: drop '>' quoted lines and 'X writes:' attribution lines."""
    return F.array_join(F.filter(lines_of(col), _keep_line), "\n")


def collapse_blank_lines(col) -> Column:
    """Three or more newlines become two."""
    return F.regexp_replace(_c(col), "\n{3,}", "\n\n")


def drop_url_lines(col) -> Column:
    """Blank out lines that hold only a URL (surrounding whitespace,
    including adjacent blank lines, goes with it)."""
    return F.regexp_replace(_c(col), URL_ONLY_LINE, "")


def strip_and_truncate(col, max_chars: int | None = MAX_CHARS) -> Column:
    """Strip, then keep the first ``max_chars`` code points (None: all)."""
    return strip_ws(col) if max_chars is None else F.substring(strip_ws(col), 1, max_chars)


def clean_text(col, max_chars: int | None = MAX_CHARS) -> Column:
    """B4 -> B5/B6 -> B7 -> B8 -> B9 as one expression tree."""
    t = normalise_newlines(col)
    t = drop_quoted_and_attribution(t)
    t = collapse_blank_lines(t)
    t = drop_url_lines(t)
    return strip_and_truncate(t, max_chars)


# -- validity (B11-B13) ----------------------------------------------------------

def tokens(col) -> Column:
    """``text.split()``: runs of Unicode whitespace, no empty tokens."""
    return F.filter(F.split(_c(col), WS_J + "+"), lambda x: x != "")


def token_count(col) -> Column:
    """Number of whitespace-separated tokens."""
    return F.regexp_count(_c(col), F.lit(NON_WS_J + "+"))


def alpha_token_count(col) -> Column:
    """Tokens holding an ASCII letter: each match starts at a token's first
    letter and runs to the token's end, so it counts once per such token."""
    return F.regexp_count(_c(col), F.lit("[a-zA-Z]" + NON_WS_J + "*"))


def alpha_ratio(col) -> Column:
    """Share of tokens holding an ASCII letter (NULL for no tokens)."""
    n = token_count(col)
    return F.when(n > 0, alpha_token_count(col) / n)


def is_valid(col, min_tokens: int = MIN_TOKENS, min_alpha: float = MIN_ALPHA_RATIO) -> Column:
    """Enough tokens and enough alphabetic tokens."""
    n = token_count(col)
    return (n >= min_tokens) & (alpha_token_count(col) / F.greatest(n, F.lit(1)) >= min_alpha)


def content_id(col) -> Column:
    """First 16 hex digits of SHA-256 of the UTF-8 text."""
    return F.substring(F.sha2(_c(col), 256), 1, 16)


def snippet(col, n: int) -> Column:
    """B18."""
    return F.substring(_c(col), 1, n)


def fixed_digits(x, digits: int, given: int = 4) -> Column:
    """A number of magnitude below 8, already rounded to ``given`` decimals,
    with ``digits`` decimals as C's ``%.nf`` prints it: a half goes up or down
    by the exact binary value, which Java's formatter does not look at.
    Scaling by a power of two is exact, so the comparison is one of integers
    (small numbers are scaled further, down to the last bit of 0.0001)."""
    x = _c(x)
    a = F.abs(x)
    scale, step, unit = 10 ** given, 10 ** (given - digits), 10 ** digits
    t = F.round(a * scale).cast("long")

    def beyond(bits: int) -> Column:
        exact = (a * float(2 ** bits)).cast("long").cast("decimal(19,0)") * F.lit(scale).cast("decimal(6,0)")
        return exact - t.cast("decimal(9,0)") * F.lit(str(2 ** bits)).cast("decimal(21,0)")

    over = F.when(a < 1 / 64, beyond(66)).otherwise(beyond(60))
    low, high = F.pmod(t, F.lit(step)), F.floor(t / step)
    up = (low * 2 > step) | ((low * 2 == step) & ((over > 0) | ((over == 0) & (F.pmod(high, F.lit(2)) == 1))))
    n = high + F.when(up, 1).otherwise(0)
    return F.format_string(f"%s%d.%0{digits}d", F.when(x < 0, F.lit("-")).otherwise(F.lit("")), F.floor(n / unit), F.pmod(n, F.lit(unit)))
