"""URL verdicts: rules first, else naive Bayes over segmented words.

The words of a host's labels and of the path are found by a unigram Viterbi:
of all ways to split a letter run into words, the one with the largest product
of word probabilities.  The word list is counted over all pages (titles, and
the parts of their urls that are already separate) and stays a table: each
distinct letter run meets the words it holds in a join, whatever the list's
size.  A multinomial naive Bayes is trained on the urls that a rule decides and
scores all others.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.shared import written

# The rules (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Hashed word counts of the naive Bayes.
BUCKETS = 1 << 16
#: Longest word that the segmentation tries.
LONGEST = 24
#: Rows of a batch that a Python stage hands on, about.
ROWS = 20_000

_RUN = re.compile(r"[^\W\d_]+|\d+")


def parts(url: Column) -> tuple[Column, Column]:
    """Host (ASCII letters lower-cased) and path; both empty for null or no ``://``."""
    u = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (as text) and its verdict; null if none does."""
    text = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # longer rules are tried first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text = F.when(fits, F.lit(h + p)).otherwise(text)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


class Lexicon:
    """Word log-probabilities; unknown stretches cost more the longer they are."""

    def __init__(self, counts: dict[str, int], total: int | None = None):
        """``total``: the count of all words, if ``counts`` are those of some."""
        total = float(sum(counts.values()) if total is None else total) or 1.0
        self.cost = {w: -math.log(n / total) for w, n in counts.items()}
        self.unknown = math.log(total) + 2.0
        self.longest = min(LONGEST, max(map(len, counts), default=1))

    def split(self, run: str) -> list[str]:
        """The cheapest split of a letter run into words; an unknown stretch of n letters costs ``unknown + 2 n``."""
        if run in self.cost and len(run) <= 3:
            return [run]
        best = [0.0]
        back: list[tuple[int, bool]] = [(0, True)]
        open_ = [0.0]  # cost with an unknown stretch still open
        open_back = [0]
        for i in range(1, len(run) + 1):
            new, at = best[i - 1] + self.unknown + 2.0, i - 1
            if i > 1 and open_[i - 1] + 2.0 < new:
                new, at = open_[i - 1] + 2.0, open_back[i - 1]
            open_.append(new)
            open_back.append(at)
            c, k = new, (at, False)
            for j in range(max(0, i - self.longest), i):
                w = self.cost.get(run[j:i])
                if w is not None and best[j] + w < c:
                    c, k = best[j] + w, (j, True)
            best.append(c)
            back.append(k)
        out, i = [], len(run)
        while i:
            j = back[i][0]
            out.append(run[j:i])
            i = j
        return out[::-1]


def tokens(host: str, path: str, splits: dict[str, list[str]]) -> list[str]:
    """Segmented words of host and path (told apart by a prefix); digit runs by their length; runs not in ``splits`` are whole."""
    out = []
    for side, text in (("h", host), ("p", path)):
        for run in _RUN.findall(text.lower()):
            if run[0].isdigit():
                out.append(f"{side}:#{min(len(run), 4)}")
            else:
                out += [f"{side}:{w}" for w in splits.get(run, (run,))]
    return out


def _bucket(token: str) -> int:
    import zlib
    return zlib.crc32(token.encode()) % BUCKETS


def word_counts(pages: DataFrame) -> DataFrame:
    """``(w, n)``: counts over all pages of the words in titles, paths and hyphenated host labels, as a written table.

    Other host labels are left out: a frequent host would become a word that
    is never split.
    """
    host, path = parts(F.col("url"))
    hyphened = F.array_join(F.regexp_extract_all(host, F.lit("[^.]*-[^.]*"), F.lit(0)), " ")
    title = F.regexp_extract(F.coalesce(F.col("html").cast("string"), F.lit("")), "(?is)<title[^>]*>(.*?)</title", 1)
    words = F.split(F.lower(F.concat_ws(" ", hyphened, path, title)), "[^\\p{L}]+")
    return written(pages.select(F.explode(words).alias("w")).filter((F.length("w") >= 2) & (F.length("w") <= LONGEST))
                   .groupBy("w").agg(F.count(F.lit(1)).alias("n")), "url-words")


def _pairs(rows, names):
    """Batches of string pairs, about ``ROWS`` each."""
    a, b = [], []
    for x, y in rows:
        a.append(x)
        b.append(y)
        if len(a) >= ROWS:
            yield pa.record_batch({names[0]: pa.array(a, pa.string()), names[1]: pa.array(b, pa.string())})
            a, b = [], []
    if a:
        yield pa.record_batch({names[0]: pa.array(a, pa.string()), names[1]: pa.array(b, pa.string())})


def _runs(batches):
    """The distinct letter runs of each url."""
    def rows():
        for b in batches:
            for key, host, path in zip(*(b.column(i).to_pylist() for i in range(3))):
                for run in dict.fromkeys(r for text in (host, path) for r in _RUN.findall(text.lower()) if not r[0].isdigit()):
                    yield key, run
    return _pairs(rows(), ("u", "run"))


def _substrings(batches):
    """Every distinct stretch of 2 to ``LONGEST`` letters of each run, but for runs that are too short to split."""
    def rows():
        for b in batches:
            for run in b.column(0).to_pylist():
                for sub in {run[i:j] for i in range(len(run)) for j in range(i + 2, min(len(run), i + LONGEST) + 1)}:
                    yield run, sub
    return _pairs(rows(), ("run", "w"))


def _split(total: int):
    def run(batches):
        for b in batches:
            runs = b.column(0).to_pylist()
            found = [Lexicon({x["w"]: x["n"] for x in words}, total).split(r) for r, words in zip(runs, b.column(1).to_pylist())]
            yield pa.record_batch({"run": b.column(0), "words": pa.array(found, pa.list_(pa.string()))})
    return run


def segment(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """``(run, words)`` for those of the distinct ``run`` that split into several words; ``counts``: all words.

    Only the total of the counts reaches the driver.
    """
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    held = (runs.select("run").mapInArrow(_substrings, "run string, w string").join(counts, "w")
            .groupBy("run").agg(F.collect_list(F.struct("w", "n")).alias("held")))
    return written(held.mapInArrow(_split(total), "run string, words array<string>").filter(F.size("words") > 1), "url-splits")


def _tokens(batches):
    for b in batches:
        host, path, splits = (b.column(i).to_pylist() for i in (1, 2, 5))
        words = [tokens(h, p, {x["run"]: x["words"] for x in s or ()}) for h, p, s in zip(host, path, splits)]
        yield pa.record_batch({"page_id": b.column(0), "host": b.column(1), "path": b.column(2), "rule": b.column(3), "by_rule": b.column(4),
                               "words": pa.array([" ".join(w) for w in words], pa.string())})


def with_words(judged: DataFrame, counts: DataFrame) -> DataFrame:
    """``judged`` (``page_id, host, path, rule, by_rule``) with ``words``, the tokens of each url joined by blanks, as a written table."""
    keyed = judged.withColumn("u", F.md5(F.concat_ws("\n", "host", "path")))
    runs = written(keyed.select("u", "host", "path").dropDuplicates(["u"]).mapInArrow(_runs, "u string, run string"), "url-runs")
    splits = segment(runs.select("run").distinct(), counts)
    # the grouped side is written, so that the join below can split urls that many pages share
    own = written(runs.join(splits, "run").groupBy("u").agg(F.collect_list(F.struct("run", "words")).alias("splits")), "url-own-splits")
    rows = keyed.join(own, "u", "left").select("page_id", "host", "path", "rule", "by_rule", "splits")
    return written(rows.mapInArrow(_tokens, "page_id long, host string, path string, rule string, by_rule string, words string"), "url-tokens")


def _train(batches):
    counts = {"allow": np.zeros(BUCKETS, np.int64), "block": np.zeros(BUCKETS, np.int64)}
    urls = dict.fromkeys(counts, 0)
    for b in batches:
        for words, verdict in zip(*(b.column(i).to_pylist() for i in range(2))):
            urls[verdict] += 1
            for t in words.split():
                counts[verdict][_bucket(t)] += 1
    for v, table in counts.items():
        at = np.flatnonzero(table)
        yield pa.record_batch({"verdict": pa.array([v] * (len(at) + 1)), "at": pa.array(np.append(at, -1).astype(np.int64)),
                               "n": pa.array(np.append(table[at], urls[v]))})


class Bayes:
    """Log-odds of ``block`` per bucket and of the prior."""

    def __init__(self, counts: dict[str, np.ndarray], urls: dict[str, int]):
        p = {v: np.log((c + 0.5) / (c.sum() + 0.5 * BUCKETS)) for v, c in counts.items()}
        self.odds = (p["block"] - p["allow"]).astype(np.float64)
        self.prior = math.log((urls["block"] + 0.5) / (urls["allow"] + 0.5))
        self.seen = (counts["allow"] + counts["block"]) > 0

    def score(self, words: list[str]) -> float:
        """Log-odds of ``block``; words in no training url say nothing."""
        at = [_bucket(t) for t in words]
        return self.prior + float(sum(self.odds[i] for i in at if self.seen[i]))


def fit(judged: DataFrame) -> Bayes:
    """Naive Bayes from all urls (``words``) that a rule decided (``by_rule``); at most two tables of ``BUCKETS`` come back."""
    rows = (judged.filter("by_rule is not null").select("words", "by_rule").mapInArrow(_train, "verdict string, at long, n long")
            .groupBy("verdict", "at").agg(F.sum("n").alias("n")).collect())
    counts = {v: np.zeros(BUCKETS, np.int64) for v in ("allow", "block")}
    urls = dict.fromkeys(counts, 0)
    for r in rows:
        if r["at"] < 0:
            urls[r["verdict"]] = r["n"]
        else:
            counts[r["verdict"]][r["at"]] = r["n"]
    return Bayes(counts, urls)


def _judge(bayes: Bayes):
    def run(batches):
        for b in batches:
            score = [bayes.score(w.split()) for w in b.column(5).to_pylist()]
            verdict = [r or ("block" if s > 0 else "allow") for r, s in zip(b.column(4).to_pylist(), score)]
            yield pa.record_batch({"page_id": b.column(0), "host": b.column(1), "path": b.column(2), "rule": b.column(3),
                                   "verdict": pa.array(verdict, pa.string()), "score": pa.array(score, pa.float64()), "words": b.column(5)})
    return run


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict, score, words)``, one row per row of ``pages``.

    Null urls and urls without ``://``: empty host and path, no rule; they
    are judged by the prior like every url without a known word.  A rule fits
    its host and all its subdomains if the path starts with the rule's; the
    longest wins.  ``score`` is the log-odds of ``block``; at 0 or below the
    verdict is ``allow``.  If no rule decides any url, all are allowed.
    """
    host, path = parts(F.col("url"))
    split = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    judged = split.withColumn("rule", rule).withColumn("by_rule", verdict)
    judged = with_words(judged, word_counts(pages))
    return judged.mapInArrow(_judge(fit(judged)), "page_id long, host string, path string, rule string, verdict string, score double, words string")
