"""Document fingerprints as invertible Bloom lookup sketches.

*Paragraphs.*  A text is cut at line ends and, inside longer lines, where a
rolling hash of 12 bytes says so (every 32 bytes on average, in any script),
so an edit changes the paragraphs it touches and no others.  A paragraph's
digest is 64 bits of its bytes and of its number among equal paragraphs of
the text, so repeated paragraphs count each.

*Sketch.*  Each digest is added to one cell of each of three tables: a count,
a sum of digests, a sum of their check hashes.  The fingerprint is the sketch
of the least size as base64, a function of the text alone.

*Comparison.*  Two sketches are subtracted cell by cell; what both texts hold
is gone.  A cell with one digest left gives it away; it is taken out of its
other cells, and so on.  If cells remain, both texts are sketched again with
tables four times as large, until all differing digests are known.  Likeness
is the shared paragraphs' part of all, by counts: 1 for equal texts, two empty
texts included.

*Next documents.*  Ranges of (``doc_id``, text hash) are laid out from the
keys alone; texts move once, each to its range, the first of a range also to
the one before as its end.  A task reads its range in order and holds a slice
of it.  Rows equal in id and text are one document: they are counted before
the move and get the same result.  Nulls come first among ids; equal ids are
ordered by the hash of their text.  A single document is followed by itself.
Null text is empty.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.shared import match, written
from lodestar.llm.wordhash import Words, mix64, split_words

_U = np.uint64
#: Bytes of the rolling window, and the mean length of a paragraph's piece.
WINDOW, MEAN = 12, 32
#: Cells of one table of the least sketch, and the step to the next size.
CELLS, GROW = 4, 4
SALTS = (_U(0x243F6A8885A308D3), _U(0x13198A2E03707344), _U(0xA4093822299F31D0))
CHECK = _U(0x082EFA98EC4E6C89)
#: Joined bytes of texts a task works on at a time; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20


# ------------------------------------------------------------------ paragraphs

class Digests:
    """Paragraph digests of a batch of texts; those of text ``i`` are ``value[first[i]:first[i + 1]]``."""

    def __init__(self, value: np.ndarray, first: np.ndarray):
        self.value, self.first = value, first

    def __len__(self) -> int:
        return len(self.first) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number in ``rows``, digest) of all digests of some texts."""
        n = self.counts[rows]
        at = np.repeat(self.first[rows] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum())) if len(rows) else np.zeros(0, np.int64)
        return np.repeat(np.arange(len(rows)), n), self.value[at]


def paragraphs(texts: pa.Array) -> Digests:
    """Digests of the paragraphs of every text."""
    base = split_words(texts)  # only its joined bytes and the texts' offsets are used
    data, offsets = base.data, np.asarray(base.base, dtype=np.int64)
    n, size = len(data), np.diff(offsets)
    cut = np.zeros(n + 1, dtype=bool)
    if n:
        cut[1:] = data == 0x0A
    if n >= WINDOW:
        rolled = np.zeros(n - WINDOW + 1, dtype=np.uint32)
        mixed = ((data.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)) ^ np.uint32(0x85EBCA6B)
        for j in range(WINDOW):
            rolled = rolled * np.uint32(0x01000193) + mixed[j:n - WINDOW + 1 + j]
        rolled ^= rolled >> np.uint32(15)
        rolled *= np.uint32(0x2C1B3C6D)
        cut[WINDOW:] |= rolled >> np.uint32(32 - MEAN.bit_length() + 1) == 0
    # a window that reaches into the text before says nothing
    for back in range(1, WINDOW):
        at = offsets[:-1][size > back] + back
        cut[at] = data[at - 1] == 0x0A
    cut[offsets[:-1][size > 0]] = True
    cut[n] = False
    start = np.flatnonzero(cut)
    end = np.append(start[1:], n)
    first = np.searchsorted(start, offsets)
    value = Words(data, start, end, first, offsets).hashes()
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    by = np.lexsort((value, text))
    v, t = value[by], text[by]
    new = np.ones(len(v), dtype=bool)
    new[1:] = (v[1:] != v[:-1]) | (t[1:] != t[:-1])
    run = np.flatnonzero(new)
    nth = np.arange(len(v)) - np.repeat(run, np.diff(np.append(run, len(v))))
    return Digests(mix64(v + nth.astype(np.uint64) * SALTS[0]), first)


# ------------------------------------------------------------------ sketches

def _cells(digest: np.ndarray, cells: int) -> list[np.ndarray]:
    return [(mix64(digest ^ salt) & _U(cells - 1)).astype(np.int64) + j * cells for j, salt in enumerate(SALTS)]


class Sketch:
    """``count``, ``total`` and ``check`` of (texts, 3 x cells) cells; sums are modulo 2**64."""

    def __init__(self, rows: int, cells: int):
        self.cells = cells
        self.count = np.zeros((rows, 3 * cells), dtype=np.int64)
        self.total = np.zeros((rows, 3 * cells), dtype=np.uint64)
        self.check = np.zeros((rows, 3 * cells), dtype=np.uint64)

    def add(self, row: np.ndarray, digest: np.ndarray, sign: np.ndarray | int = 1) -> None:
        """Add (sign 1) or take out (sign -1) one digest a row number given."""
        if not len(digest):
            return
        sign = np.broadcast_to(np.asarray(sign, dtype=np.int64), digest.shape)
        factor = sign.view(np.uint64) if sign.flags.c_contiguous else sign.copy().view(np.uint64)
        check = mix64(digest ^ CHECK) * factor
        signed = digest * factor
        width = 3 * self.cells
        for at in _cells(digest, self.cells):
            flat = row * width + at
            np.add.at(self.count.reshape(-1), flat, sign)
            np.add.at(self.total.reshape(-1), flat, signed)
            np.add.at(self.check.reshape(-1), flat, check)

    def minus(self, other: Sketch) -> Sketch:
        out = Sketch(0, self.cells)
        out.count, out.total, out.check = self.count - other.count, self.total - other.total, self.check - other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, digest, sign) of all digests found, and which rows are known whole.  Empties the sketch as far as it can."""
        found = []
        while True:
            row, cell = np.nonzero(np.abs(self.count) == 1)
            sign = self.count[row, cell]
            digest = self.total[row, cell] * sign.view(np.uint64)
            pure = self.check[row, cell] == mix64(digest ^ CHECK) * sign.view(np.uint64)
            row, digest, sign = row[pure], digest[pure], sign[pure]
            if not len(row):
                break
            by = np.lexsort((digest, row))
            row, digest, sign = row[by], digest[by], sign[by]
            new = np.ones(len(row), dtype=bool)
            new[1:] = (row[1:] != row[:-1]) | (digest[1:] != digest[:-1])
            row, digest, sign = row[new], digest[new], sign[new]
            found.append((row, digest, sign))
            self.add(row, digest, -sign)
        whole = ~(self.count.any(axis=1) | self.total.any(axis=1) | self.check.any(axis=1))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), whole
        return *(np.concatenate(x) for x in zip(*found)), whole

    def strings(self) -> list[str]:
        """The cells of every text as base64."""
        parts = [x.astype(f"<{kind}") for x, kind in ((self.count, "i4"), (self.total, "u8"), (self.check, "u8"))]
        return [base64.b64encode(b"".join(p[i].tobytes() for p in parts)).decode() for i in range(len(self.count))]


def sketch(digests: Digests, rows: np.ndarray | None = None, cells: int = CELLS) -> Sketch:
    rows = np.arange(len(digests)) if rows is None else rows
    out = Sketch(len(rows), cells)
    out.add(*digests.take(rows))
    return out


def differences(a: Digests, a_rows: np.ndarray, b: Digests, b_rows: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, digest, sign) of the paragraphs that only the first (1) or only the second (-1) text of a pair holds."""
    pair, out = np.arange(len(a_rows)), []
    while len(pair):
        row, digest, sign, whole = sketch(a, a_rows[pair], cells).minus(sketch(b, b_rows[pair], cells)).peel()
        known = whole[row]
        out.append((pair[row[known]], digest[known], sign[known]))
        pair, cells = pair[~whole], cells * GROW
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


def likeness(a: Digests, a_rows: np.ndarray, b: Digests, b_rows: np.ndarray) -> np.ndarray:
    """Shared paragraphs as a part of all paragraphs of each pair."""
    pair, _, _ = differences(a, a_rows, b, b_rows)
    apart = np.bincount(pair, minlength=len(a_rows))
    both = a.counts[a_rows] + b.counts[b_rows]
    return np.where(both + apart > 0, (both - apart) / np.maximum(1, both + apart), 1.0)


# ------------------------------------------------------------------ documents and their followers

def _in_ranges(docs: DataFrame) -> DataFrame | None:
    """Distinct documents by range and order: ``part``, ``last`` (an end that belongs to the next range), ``doc_id``, ``text``, ``n``."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    keys = written(rows.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("n")), "fingerprint-keys")
    # one row a range reaches the driver: the first key of each
    heads = (keys.repartitionByRange(parts, F.asc_nulls_first("doc_id"), "h").groupBy(F.spark_partition_id().alias("part"))
             .agg(F.min(F.struct("doc_id", "h")).alias("head")).orderBy("head").select("head.*").collect())
    if not heads:
        return None
    repeated = written(keys.filter("n > 1"), "fingerprint-repeated")
    rows = rows.withColumn("n", F.lit(1).cast("long"))
    if not repeated.isEmpty():
        once = match(rows, repeated.select("doc_id", "h"), ["doc_id", "h"], "left_semi").groupBy("doc_id", "h").agg(F.min("text").alias("text"), F.sum("n").alias("n"))
        rows = match(rows, repeated.select("doc_id", "h"), ["doc_id", "h"], "left_anti").unionByName(once)
    bounds = F.array(*[F.struct(F.lit(h["doc_id"]).cast("long").alias("doc_id"), F.lit(h["h"]).alias("h")) for h in heads])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, (len(heads) - 1).bit_length())))])
    # the last bound that does not exceed a row's key, by halving; a struct's null comes first
    own = F.struct("doc_id", "h")
    at = F.aggregate(steps, F.lit(0), lambda p, s: F.when((p + s < len(heads)) & (F.get(bounds, p + s) <= own), p + s).otherwise(p))
    rows = rows.withColumn("part", at)
    first = own == F.get(bounds, F.col("part"))
    before = F.pmod(F.col("part") - 1, F.lit(len(heads)))
    places = F.when(first, F.array(F.struct("part", F.lit(False).alias("last")), F.struct(before.alias("part"), F.lit(True).alias("last")))).otherwise(
        F.array(F.struct("part", F.lit(False).alias("last"))))
    return (rows.withColumn("to", F.explode(places)).select("to.part", "to.last", "doc_id", "h", "text", "n").repartitionById(len(heads), F.col("part"))
            .sortWithinPartitions("part", "last", F.asc_nulls_first("doc_id"), "h").select("part", "last", "doc_id", "text", "n"))


def _slices(batches):
    """Runs of consecutive rows of one range; the last row of a run starts the next one."""
    run, size = [], 0
    for b in batches:
        for row in zip(*[b.column(i).to_pylist() for i in range(b.num_columns)]):
            run.append(row)
            size += len(row[3])
            if row[1] or size > SLICE_BYTES and len(run) > 1:
                yield run
                run, size = ([], 0) if row[1] else ([row], len(row[3]))


def _fingerprints(batches):
    for run in _slices(batches):
        text = [r[3] for r in run]
        tail = [len(t) // 4 for t in text]
        edited = [t[:len(t) - k] + after[:k] for t, k, after in zip(text, tail, text[1:])]
        own, other = paragraphs(pa.array(text, pa.large_string())), paragraphs(pa.array(edited, pa.large_string()))
        at = np.arange(len(edited))
        yield pa.record_batch({
            "doc_id": pa.array([r[2] for r in run[:-1]], pa.int64()), "n_chars": pa.array([len(t) for t in text[:-1]], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
            "fingerprint": pa.array(sketch(own, at).strings(), pa.string()), "edited_fingerprint": pa.array(sketch(other).strings(), pa.string()),
            "near_edited": pa.array(likeness(own, at, other, at)), "near_next": pa.array(likeness(own, at, own, at + 1)),
            "n": pa.array([r[4] for r in run[:-1]], pa.int64())})


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness to each other and to the next document's.

    The edited text has the last quarter of the code points (rounded down)
    replaced by as many from the start of the next document, or all of them.
    """
    ranges = _in_ranges(docs)
    if ranges is None:
        return docs.sparkSession.createDataFrame([], RESULT)
    found = ranges.mapInArrow(_fingerprints, RESULT + ", n long")
    names = [c.split()[0] for c in RESULT.split(", ")]
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select(*names)
