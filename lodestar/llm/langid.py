"""Language identification of whole, possibly mixed texts.

Every word is scored per language by its letter groups (naive Bayes over the
UTF-8 byte triples of the lower-cased word, hashed to a table of fixed size).
The word's script leaves only the languages that were learned with that
script.  A Viterbi pass over the words with a penalty for switching language
labels the text in spans; the document's language is the one with the most
letters in its spans.

Words are scored and walked in NumPy, all texts of a batch in step and long
texts in blocks, so no Python runs per word.
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.wordhash import slices, split_words

#: Labelled documents that the model is fitted on, at most, per language.
FIT_DOCS = 1500
#: Hashed byte triples.
BUCKETS = 1 << 16
#: Log-probability that a switch of language costs.
SWITCH = 12.0
#: A script belongs to a language that has at least this share of its words in it.
SCRIPT_SHARE = 0.01
#: Texts of more words are walked in blocks of words side by side.
LONG_WORDS, BLOCK_WORDS = 4096, 256
#: Letters of all scripts without a number of their own; also the words without a letter.
OTHER = 0

# First code points of Unicode ranges and their script.
SCRIPTS = ("other", "latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "devanagari", "bengali", "thai", "georgian", "hangul", "kana", "han")
RANGES = [
    (0x0000, 0), (0x0041, 1), (0x005B, 0), (0x0061, 1), (0x007B, 0), (0x00AA, 1), (0x00AB, 0), (0x00BA, 1), (0x00BB, 0), (0x00C0, 1), (0x00D7, 0),
    (0x00D8, 1), (0x00F7, 0), (0x00F8, 1), (0x02B9, 0), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0700, 0), (0x0750, 6),
    (0x0780, 0), (0x0900, 7), (0x0980, 8), (0x0A00, 0), (0x0E00, 9), (0x0E80, 0), (0x10A0, 10), (0x1100, 11), (0x1200, 0), (0x1E00, 1), (0x1F00, 2),
    (0x2000, 0), (0x3040, 12), (0x3100, 0), (0x3130, 11), (0x3190, 0), (0x3400, 13), (0xA000, 0), (0xAC00, 11), (0xD7B0, 0), (0xF900, 13),
    (0xFB00, 1), (0xFB13, 4), (0xFB1D, 5), (0xFB50, 6), (0xFE00, 0), (0xFE70, 6), (0xFF00, 0), (0xFF21, 1), (0xFF5B, 0), (0xFF66, 12), (0xFFA0, 11),
    (0xFFE0, 0), (0x20000, 13), (0x323B0, 0),
]
_FROM = np.array([r[0] for r in RANGES])
_SCRIPT = np.array([r[1] for r in RANGES], dtype=np.uint8)
#: Scripts and kinds (``L`` letter, ``M`` mark, ...) of all code points.
_TABLE = _SCRIPT[np.searchsorted(_FROM, np.arange(sys.maxunicode + 1), side="right") - 1]
_KIND = np.frombuffer("".join(unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1)).encode(), dtype=np.uint8)
_LETTER = _KIND == ord("L")
#: Marks are no letters, but many scripts write vowels with them: they belong to the triples.
_SPELLED = _LETTER | (_KIND == ord("M"))


def _code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offset and code point of every character of valid UTF-8."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    b = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
    first = b[at]
    cp = first.copy()
    two, three, four = (first >= 0xC0) & (first < 0xE0), (first >= 0xE0) & (first < 0xF0), first >= 0xF0
    cp[two] = (first[two] & 0x1F) << 6 | b[at[two] + 1] & 0x3F
    cp[three] = (first[three] & 0x0F) << 12 | (b[at[three] + 1] & 0x3F) << 6 | b[at[three] + 2] & 0x3F
    cp[four] = (first[four] & 0x07) << 18 | (b[at[four] + 1] & 0x3F) << 12 | (b[at[four] + 2] & 0x3F) << 6 | b[at[four] + 3] & 0x3F
    return at, cp


class Batch:
    """Words of a batch of texts with their script, letters and triples."""

    def __init__(self, texts: pa.Array):
        self.words = w = split_words(pc.utf8_lower(pc.fill_null(texts.cast(pa.string()), "")))
        self.n = len(w.start)
        self.text = np.repeat(np.arange(len(w)), w.counts)
        data = w.data
        at, cp = _code_points(data)
        script = _TABLE[cp]
        letter = _LETTER[cp]
        # the word of each character (characters between words have none, they hold no letters)
        of = np.searchsorted(w.start, at, side="right") - 1
        hit = letter & (of >= 0)
        counts = np.bincount(of[hit] * len(SCRIPTS) + script[hit], minlength=self.n * len(SCRIPTS)).reshape(self.n, len(SCRIPTS))
        self.letters = counts.sum(axis=1)
        self.script = np.where(self.letters > 0, counts.argmax(axis=1), OTHER) if self.n else np.zeros(0, np.int64)
        # triples over letters and marks only: other bytes count as the word's edge
        edge = np.zeros(len(data) + 2, dtype=np.uint32)
        is_letter = np.zeros(len(data), dtype=bool)
        is_letter[at[_SPELLED[cp]]] = True
        lead = np.maximum.accumulate(np.where((data & 0xC0) != 0x80, np.arange(len(data)), 0)) if len(data) else np.zeros(0, np.int64)
        inside = is_letter[lead] if len(data) else is_letter
        edge[1:-1] = np.where(inside, data, 0)
        mid = np.flatnonzero(inside)
        code = (edge[mid] << 16) | (edge[mid + 1] << 8) | edge[mid + 2]
        code = code * np.uint32(0x9E3779B1)
        self.bucket = (code >> np.uint32(16)).astype(np.int64)
        self.triple_word = np.searchsorted(w.start, mid, side="right") - 1


class Model:
    """``log_p``: (BUCKETS, languages) log-probabilities; ``allowed``: (scripts, languages); ``told``: scripts that some language was learned with."""

    def __init__(self, languages: list[str], log_p: np.ndarray, allowed: np.ndarray, told: np.ndarray | None = None):
        self.languages, self.log_p, self.allowed = languages, log_p, allowed
        self.told = allowed.any(axis=1) if told is None else told

    @classmethod
    def from_counts(cls, languages: list[str], triples: np.ndarray, scripts: np.ndarray) -> Model:
        p = (triples + 0.05) / (triples.sum(axis=0) + 0.05 * BUCKETS)
        share = scripts / np.maximum(1, scripts.sum(axis=1, keepdims=True))
        allowed = share.T >= SCRIPT_SHARE
        told = allowed.any(axis=1)
        allowed[OTHER] = True
        return cls(languages, np.log(p).astype(np.float32), allowed, told)

    def emissions(self, batch: Batch) -> np.ndarray:
        """(words, languages) log-scores; languages without the word's script are out, unknown scripts say nothing."""
        k = len(self.languages)
        e = np.empty((batch.n, k), dtype=np.float64)
        for j in range(k):
            e[:, j] = np.bincount(batch.triple_word, weights=self.log_p[batch.bucket, j], minlength=batch.n)[:batch.n]
        e -= e.max(axis=1, keepdims=True) if k else 0
        allowed = self.allowed[batch.script]
        some = allowed.any(axis=1, keepdims=True)
        return np.where(some & ~allowed, -40.0, np.where(some, np.maximum(e, -40.0), 0.0))

    def spans(self, batch: Batch) -> np.ndarray:
        """The language number of every word: Viterbi over each text, all texts in step."""
        e = self.emissions(batch)
        k, n = len(self.languages), batch.n
        label = np.zeros(n, dtype=np.int64)
        if not n or k < 2:
            return label
        counts = batch.words.counts.copy()
        for text in np.flatnonzero(counts > LONG_WORDS):
            at = batch.words.first[text]
            label[at:at + counts[text]] = self._long_spans(e[at:at + counts[text]])
            counts[text] = 0
        if not counts.any():
            return label
        order = np.argsort(-counts, kind="stable")
        first = batch.words.first[:-1][order]
        length = counts[order]
        active = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right")  # texts with more than t words
        stays = np.ones((n, k), dtype=bool)  # best way into a word's state is the same state before
        came = np.zeros(n, dtype=np.int8 if k < 128 else np.int32)  # else from the best state before
        score = e[first[:active[0]]]
        for t in range(1, int(length[0])):
            m = active[t]
            score = score[:m]
            top = score.argmax(axis=1)
            jump = score[np.arange(m), top] - SWITCH
            at = first[:m] + t
            keep = score >= jump[:, None]
            stays[at], came[at] = keep, top
            score = np.where(keep, score, jump[:, None]) + e[at]
            ends = np.flatnonzero(length[:m] == t + 1)
            label[at[ends]] = score[ends].argmax(axis=1)
        single = np.flatnonzero(length == 1)
        label[first[single]] = e[first[single]].argmax(axis=1)
        for t in range(int(length[0]) - 1, 0, -1):
            at = first[:active[t]] + t
            own = label[at]
            label[at - 1] = np.where(stays[at, own], own, came[at])
        return label

    def _long_spans(self, e: np.ndarray) -> np.ndarray:
        """The best path of one long text: blocks of words are walked side by side from each state they may start in,
        the blocks' best scores are chained, then each block is walked again from its start to its end."""
        n, k = e.shape
        blocks = -(-n // BLOCK_WORDS)
        e = np.concatenate([e, np.zeros((blocks * BLOCK_WORDS - n, k))]).reshape(blocks, BLOCK_WORDS, k)
        length = np.full(blocks, BLOCK_WORDS)
        length[-1] = n - (blocks - 1) * BLOCK_WORDS
        score = np.full((blocks, k, k), -np.inf)  # start and end state
        score[:, np.arange(k), np.arange(k)] = e[:, 0]
        for t in range(1, BLOCK_WORDS):
            m = blocks if t < length[-1] else blocks - 1
            now = score[:m]
            score[:m] = np.maximum(now, now.max(axis=2, keepdims=True) - SWITCH) + e[:m, t, None, :]
        start, before = np.zeros((blocks, k), dtype=np.int64), np.zeros((blocks, k), dtype=np.int64)
        total = np.zeros(k)
        for b in range(blocks):
            enter, came = total, np.arange(k)
            if b:
                jump = total.max() - SWITCH
                came = np.where(total >= jump, came, total.argmax())
                enter = np.maximum(total, jump)
            ways = enter[:, None] + score[b]
            start[b] = ways.argmax(axis=0)
            before[b] = came[start[b]]
            total = ways.max(axis=0)
        first, last = np.zeros(blocks, dtype=np.int64), np.zeros(blocks, dtype=np.int64)
        at = int(total.argmax())
        for b in range(blocks - 1, -1, -1):
            last[b], first[b] = at, start[b, at]
            at = before[b, at]
        r = np.arange(blocks)
        now = np.full((blocks, k), -np.inf)
        now[r, first] = e[r, 0, first]
        came = np.zeros((blocks, BLOCK_WORDS, k), dtype=np.int64)
        for t in range(1, BLOCK_WORDS):
            top = now.argmax(axis=1)
            jump = now[r, top] - SWITCH
            came[:, t] = np.where(now >= jump[:, None], np.arange(k), top[:, None])
            now = np.maximum(now, jump[:, None]) + e[:, t]
        label = np.zeros((blocks, BLOCK_WORDS), dtype=np.int64)
        label[r, length - 1] = last
        for t in range(BLOCK_WORDS - 1, 0, -1):
            m = blocks if t < length[-1] else blocks - 1
            label[:m, t - 1] = came[r[:m], t, label[:m, t]]
        return label.ravel()[:n]

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language and score of every text, and its words' labels (with the text number of each)."""
        batch = Batch(texts)
        label = self.spans(batch)
        n, k = len(texts), len(self.languages)
        told = self.told[batch.script]
        share = np.bincount(batch.text * k + label, weights=batch.letters * told, minlength=n * k).reshape(n, k) if k else np.zeros((n, 0))
        total = np.bincount(batch.text, weights=batch.letters, minlength=n)
        share += np.bincount(batch.text, weights=batch.letters * ~told, minlength=n)[:, None] / max(1, k)
        lang = [self.languages[j] if t else "und" for j, t in zip(share.argmax(axis=1).tolist(), total.tolist())] if k else ["und"] * n
        score = np.where(total > 0, share.max(axis=1) / np.maximum(total, 1), 0.0) if k else np.zeros(n)
        return lang, score, label, batch.text


def _count(languages: list[str]):
    number = {v: i for i, v in enumerate(languages)}

    def run(batches):
        k = len(languages)
        triples = np.zeros((k, BUCKETS))
        scripts = np.zeros((k, len(SCRIPTS)))
        for b in batches:
            for at, n in slices(b.column(1)):
                batch = Batch(b.column(1).slice(at, n))
                lang = np.array([number[x] for x in b.column(0).slice(at, n).to_pylist()])
                own = lang[batch.text]
                triples += np.bincount(own[batch.triple_word] * BUCKETS + batch.bucket, minlength=k * BUCKETS).reshape(k, BUCKETS)
                some = batch.letters > 0
                scripts += np.bincount(own[some] * len(SCRIPTS) + batch.script[some], minlength=scripts.size).reshape(scripts.shape)
        for kind, table in (("triple", triples), ("script", scripts)):
            for j in range(k):
                at = np.flatnonzero(table[j])
                yield pa.record_batch({"kind": pa.array([kind] * len(at), pa.string()), "lang": pa.array(np.full(len(at), j, np.int64)),
                                       "at": pa.array(at.astype(np.int64)), "n": pa.array(table[j][at])})
    return run


def fit(labelled: DataFrame, fit_docs: int = FIT_DOCS) -> Model:
    """A model of the non-null languages in ``labelled`` (``doc_id``, ``text``, ``lang``).

    The sample has about ``fit_docs`` texts a language, those whose hash falls
    in a fitting range, copies once; their whole texts are counted in Spark.  What reaches the
    driver is at most ``BUCKETS`` counts a language.
    """
    rows = labelled.filter("lang is not null and text is not null").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    # the hash bound that leaves about fit_docs rows a language is found from counts alone
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes, key=lambda x: x.encode())
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPTS), 0), bool))
    keep = F.lit(False)
    for lang in languages:
        part = min(1.0, fit_docs / sizes[lang])
        keep = keep | ((F.col("lang") == lang) & (F.pmod("h", F.lit(1 << 20)) < round(part * (1 << 20))))
    counted = (rows.filter(keep).dropDuplicates(["lang", "h"]).select("lang", "text").mapInArrow(_count(languages), "kind string, lang long, at long, n double")
               .groupBy("kind", "lang", "at").agg(F.sum("n").alias("n")).toPandas())
    triples, scripts = np.zeros((BUCKETS, len(languages))), np.zeros((len(languages), len(SCRIPTS)))
    t, s = counted[counted.kind == "triple"], counted[counted.kind == "script"]
    triples[t["at"].to_numpy(), t["lang"].to_numpy()] = t["n"].to_numpy()
    scripts[s["lang"].to_numpy(), s["at"].to_numpy()] = s["n"].to_numpy()
    return Model.from_counts(languages, triples, scripts)


def _predict(model: Model):
    def run(batches):
        for b in batches:
            for at, n in slices(b.column(2), 2 << 20):
                lang, score, _, _ = model.predict(b.column(2).slice(at, n))
                yield pa.record_batch({"doc_id": b.column(0).slice(at, n), "held_out": b.column(1).slice(at, n),
                                       "lang_pred": pa.array(lang, pa.string()), "score": pa.array(score, pa.float64())})
    return run


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``, one row per row of ``docs``.

    ``held_out``: crc32 of the id as text, modulo 3, is 1 (null id: held
    out).  The default model learns from all other rows.  ``score`` is the
    share of the letters that the language's spans hold; letters of scripts that
    no language was learned with count for all languages alike, so a text of
    such letters alone gets the first language and one over their number.  Null
    texts and texts without a letter: ``und`` and 0.  Ties go to the first language by
    code point.  Only ``doc_id``, ``text`` and, for learning, ``lang`` are
    read, so other columns may have any name.
    """
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(True))
    model = fit(docs.filter(~held).select("doc_id", "text", "lang")) if model is None else model
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double")
