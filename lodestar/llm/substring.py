"""Removal of long repeated passages by difference-cover anchors.

A window is ``W`` consecutive words of one document; a window is dropped in
every document but the ones with the smallest id that hold it.

*Anchors.*  A difference cover ``D`` modulo ``v`` has, for any two offsets,
a shift below ``v`` that takes both into ``D``.  Hashes of ``W - v + 1``
words are taken only at positions whose remainder is in ``D`` (6 of 31 for
W = 50), and still any two equal windows hold an anchor at the same place of
both.  Anchors found in one document only can't lie in a repeated window.

*Extension.*  Around each shared anchor the windows that hold it are grown to
their full ``W`` words and compared by the hash of their whole sequence; the
smallest id of each sequence keeps it.

Both steps are a grouped minimum (with map-side partial sums) and an equi-join
back to single rows, so a passage that a third of all documents share is never
gathered anywhere; the joins' hot keys are split by adaptive execution.  Exact
copies of a whole text skip both steps: all their windows start in the
smallest copy.  Texts without a shared anchor are never moved.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.shared import match, written
from lodestar.llm.wordhash import slices, split_words, window_hashes

#: Perfect difference sets (modulus: residues).
COVERS = {
    1: (0,),
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (1, 5, 11, 24, 25, 27),
}


def cover_for(width: int) -> tuple[int, tuple[int, ...]]:
    """The largest cover that leaves anchors of at least two fifths of a window."""
    v = max(m for m in COVERS if m == 1 or width - m + 1 >= 0.4 * width - 1)
    return v, COVERS[v]


def _places(words) -> tuple[np.ndarray, np.ndarray]:
    """Text number and position in its text of every word of a batch."""
    text = np.repeat(np.arange(len(words)), words.counts)
    return text, np.arange(len(text)) - words.first[text]


def _rows(key, ids, marks, text, pos) -> pa.RecordBatch:
    return pa.record_batch({"h": pa.array(key.view(np.int64)), "doc_id": pa.array(ids[text]),
                            "loc": pa.array((marks[text].astype(np.int64) << 32) | pos)})


def _anchors(width: int):
    v, cover = cover_for(width)
    length = width - v + 1
    chosen = np.isin(np.arange(v), cover)

    def run(batches):
        for b in batches:
            for at, n in slices(b.column("text")):
                words = split_words(b.column("text").slice(at, n))
                ids, marks = (b.column(x).slice(at, n).to_numpy(zero_copy_only=False) for x in ("doc_id", "mark"))
                text, pos = _places(words)
                key = window_hashes(words.hashes(), length)
                text, pos = text[:len(key)], pos[:len(key)]
                counts = words.counts[text]
                ok = chosen[pos % v] & (pos + length <= counts) & (counts >= width)
                if ok.any():
                    yield _rows(key[ok], ids, marks, text[ok], pos[ok])
    return run


def _windows(width: int):
    """Whole windows around the shared anchors of each text."""
    v, _ = cover_for(width)

    def run(batches):
        for b in batches:
            for at, n in slices(b.column("text")):
                part = b.slice(at, n)
                words = split_words(part.column("text"))
                ids, marks = (part.column(x).to_numpy(zero_copy_only=False) for x in ("doc_id", "mark"))
                found = part.column("anchors")
                p = found.flatten().to_numpy().astype(np.int64)
                of = np.repeat(np.arange(n), found.value_lengths().to_numpy())
                total = len(words.start)
                near = np.zeros(total + 1, dtype=np.int64)
                # windows that start at most v - 1 words before the anchor
                np.add.at(near, words.first[of] + np.maximum(p - v + 1, 0), 1)
                np.add.at(near, words.first[of] + p + 1, -1)
                key = window_hashes(words.hashes(), width)
                text, pos = _places(words)
                text, pos = text[:len(key)], pos[:len(key)]
                ok = (np.cumsum(near)[:len(key)] > 0) & (pos + width <= words.counts[text])
                if ok.any():
                    yield _rows(key[ok], ids, marks, text[ok], pos[ok])
    return run


def _kept(width: int, with_text: bool, carry: tuple[str, ...]):
    """Words that no dropped window covers, with their count, digest and (on request) text."""
    def run(batches):
        for b in batches:
            for at, n in slices(b.column("text")):
                part = b.slice(at, n)
                words = split_words(part.column("text"))
                copies, drops = part.column("is_copy"), part.column("starts")
                total, removed, digest, texts = [], [], [], []
                for i in range(n):
                    lo, hi = int(words.first[i]), int(words.first[i + 1])
                    gone = np.zeros(hi - lo + 1, dtype=np.int64)
                    if copies[i].as_py():
                        gone[:] = hi - lo >= width
                    elif drops[i].is_valid:
                        s = drops[i].values.to_numpy().astype(np.int64)
                        np.add.at(gone, s, 1)
                        np.add.at(gone, s + width, -1)
                        np.cumsum(gone, out=gone)
                    keep = gone[:-1] == 0
                    raw = words.data[words.base[i]:words.base[i + 1]].tobytes()
                    joined = b" ".join(raw.split() if keep.all() else [w for w, k in zip(raw.split(), keep.tolist()) if k])
                    total.append(hi - lo)
                    removed.append(int((~keep).sum()))
                    digest.append(hashlib.sha256(joined).hexdigest())
                    if with_text:
                        whole = part.column("text")[i].as_py()
                        texts.append(whole if keep.all() else _cut(raw, words, lo, int(words.base[i]), keep))
                out = {"doc_id": part.column("doc_id"), "n_words": pa.array(total, pa.int64()),
                       "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(digest, pa.string())}
                yield pa.record_batch(out | ({"kept_text": pa.array(texts, pa.string())} if with_text else {}) | {c: part.column(c) for c in carry})
    return run


def _cut(raw: bytes, words, lo: int, base: int, keep: np.ndarray) -> str:
    """The text without its dropped words and the white space before each of them."""
    out, at = [], 0
    edge = np.flatnonzero(np.diff(np.r_[True, keep, True].astype(np.int8)))  # runs of dropped words: [from, to)
    for a, b in zip(edge[::2], edge[1::2]):
        out.append(raw[at:int(words.end[lo + a - 1]) - base if a else 0])
        at = int(words.end[lo + b - 1]) - base
    out.append(raw[at:])
    return b"".join(out).decode()


def drop_repeats(docs: DataFrame, width: int = 50, with_text: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256[, kept_text][, carried columns])``, one row per row of ``docs``.

    Words are the maximal runs without ASCII white space, taken unchanged; a
    word goes if a window over it also starts in a document with a smaller
    id.  Null or empty text: no words, the digest of the empty string (and
    ``kept_text`` as it came).  Rows without an id lose nothing and take
    nothing from others.  Rows that repeat an id are one document: they take
    nothing from each other.  Only ``doc_id``, ``text`` and the columns in
    ``carry`` (strings, passed on) are read, so others may have any name.
    """
    more = [F.col(c).cast("string").alias(c) for c in carry]
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)
    own = base.filter("doc_id is not null and text is not null").withColumn("mark", F.hash("text"))

    # exact copies of a whole text with a smaller id
    names = own.select("doc_id", "mark", F.xxhash64("text").alias("t"), F.length("text").alias("n"))
    first = written(names.groupBy("t", "mark", "n").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                     .filter("first < last"), "substring-first")
    copies = written(names.join(first, ["t", "mark", "n"]).filter("doc_id > first").select("doc_id", "mark").distinct(), "substring-copies")
    single = match(own, copies, ["doc_id", "mark"], "left_anti").select("doc_id", "mark", "text", *carry)

    rows = "h long, doc_id long, loc long"
    anchors = single.select("doc_id", "mark", "text").mapInArrow(_anchors(width), rows)
    shared = written(anchors.groupBy("h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("h"),
                      "substring-shared")
    # places are kept once, however many rows repeat a text and its id
    mark, place = F.shiftright("loc", 32).cast("int").alias("mark"), F.col("loc").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    found = written(anchors.join(shared, "h").select("doc_id", mark, place.alias("p"))
                     .groupBy("doc_id", "mark").agg(F.collect_set("p").alias("anchors")), "substring-found")
    ids = found.select("doc_id", "mark")

    # only texts with shared anchors are dealt out by id, once for all three uses
    suspects = match(single, ids, ["doc_id", "mark"], "left_semi")
    windows = (suspects.join(found, ["doc_id", "mark"], "left").select("doc_id", "mark", "text", "anchors", *carry)
               .mapInArrow(_windows(width), rows))
    # the owners' key is an expression of the grouped one: they are dealt anew, so that the join can split hot windows
    owner = (windows.groupBy("h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi")
             .select((F.col("h").bitwiseXOR(F.lit(1))).alias("key"), "lo"))
    dropped = (windows.withColumn("key", F.col("h").bitwiseXOR(F.lit(1))).join(owner, "key").filter("doc_id > lo")
               .select("doc_id", mark, place.alias("p")).groupBy("doc_id", "mark").agg(F.collect_set("p").alias("starts")))

    fields = ("doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")
              + "".join(f", {c} string" for c in carry))
    shape = lambda df, copy: df.select("doc_id", "text", F.lit(copy).alias("is_copy"),
                                       F.lit(None).cast("array<int>").alias("starts"), *carry)
    cut = suspects.join(dropped, ["doc_id", "mark"], "left").select("doc_id", "text", F.lit(False).alias("is_copy"), "starts", *carry)
    whole = (shape(match(single, ids, ["doc_id", "mark"], "left_anti"), False).unionByName(shape(match(own, copies, ["doc_id", "mark"], "left_semi"), True))
             .unionByName(shape(base.filter("doc_id is null or text is null"), False)))
    return cut.unionByName(whole).mapInArrow(_kept(width, with_text, tuple(carry)), fields)
