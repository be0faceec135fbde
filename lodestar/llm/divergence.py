"""Source divergence audit over count-level bitmaps.

Every group (lang, source) has, for each number of times it uses a term, the
bitset of the terms it uses that often.  The terms of a language are dealt
into blocks of about ``BLOCK`` by their hash and ordered by frequency inside
a block, so that a 64-bit word of a bitset holds terms of like counts.  For
two groups the AND of two bitsets, counted, is a cell of their joint table of
counts; the cell times ``f`` of its two counts is its part of the pair's
value.  The bitset of the terms that a group doesn't use is the complement of
all its others.

Words are counted a slice of documents at a time, as one row per language and
term with its documents and its uses by source; these rows are written, the
document counts are summed from them, and only the rows of kept terms are
opened up and summed by source.  A block's bitsets meet in tasks of two bands of
``BAND`` groups, so a task's size depends on neither the vocabulary nor the
number of sources; one language may hold all rows.  Pairs of sources are
the result itself.

Null text, lang and source count as ''.  Every row is a document, repeated
rows too.  A language without kept terms has value 0 for all pairs and no
term rows; a language with one source has no pairs.  An empty table gives no
rows.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.shared import match, written
from lodestar.llm.wordhash import slices
from lodestar.session import bounded_broadcast

#: Bytes of a term: ASCII letters and all beyond ASCII; A-Z are lowered.
IN_TERM = np.zeros(256, dtype=bool)
IN_TERM[0x41:0x5B] = IN_TERM[0x61:0x7B] = IN_TERM[0x80:] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[0x41:0x5B] += 32
#: Joined bytes of documents whose words are counted together; a longer text is counted alone.
SLICE_BYTES = 8 << 20
#: Terms a block of bitsets, and groups a band.
BLOCK = 1024
BAND = 32
#: Rows of groups or languages (some 100 bytes each) that may be broadcast.
MAX_BROADCAST_GROUPS = 200_000


def share(n, total, terms):
    """``1 + floor(10**9 * (n + 5) / (total + 5 * terms))``, exactly."""
    wide = "decimal(38,0)"
    top = F.lit(1_000_000_000).cast("decimal(10,0)") * (n.cast("decimal(19,0)") + F.lit(5).cast("decimal(1,0)"))
    below = (total.cast("decimal(20,0)") + F.lit(5).cast("decimal(1,0)") * terms.cast("decimal(17,0)")).cast(wide)
    return F.call_function("div", top.cast(wide), below) + F.lit(1).cast("long")


def term_array(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The text number and the term of every term of a batch of non-null texts."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    inside = IN_TERM[raw]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    edges = offsets[1:-1][offsets[1:-1] < len(raw)]
    starts[edges] = inside[edges]  # a text's first byte starts a term, whatever the text before ends with
    start = np.flatnonzero(starts)
    kept = np.cumsum(inside, dtype=np.int64)
    at = np.append(kept[start] - 1, kept[-1] if len(kept) else 0)
    terms = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(at), pa.py_buffer(LOWERED[raw[inside]])])
    return np.searchsorted(offsets, start, side="right") - 1, terms.dictionary_encode()


def _counted(batches):
    """One row per language and term of a slice: its documents and its uses by source."""
    for b in batches:
        for at, n in slices(b.column("text"), SLICE_BYTES):
            part = b.slice(at, n)
            text, terms = term_array(part.column("text"))
            if not len(text):
                continue
            lang, source = part.column("lang").dictionary_encode(), part.column("source").dictionary_encode()
            of_lang, of_source = (x.indices.to_numpy().astype(np.int64) for x in (lang, source))
            known, sources = len(terms.dictionary), len(source.dictionary)
            pair, uses = np.unique(text * known + terms.indices.to_numpy(), return_counts=True)
            doc, term = pair // known, pair % known
            key = (of_lang[doc] * known + term) * sources + of_source[doc]
            by = np.argsort(key, kind="stable")
            key, uses = key[by], uses[by]
            first = np.flatnonzero(np.diff(key, prepend=-1))
            used, docs, key = np.add.reduceat(uses, first), np.diff(np.append(first, len(key))), key[first]
            row = np.flatnonzero(np.diff(key // sources, prepend=-1))
            entries = pa.StructArray.from_arrays([source.dictionary.take(pa.array(key % sources)), pa.array(used.astype(np.int64))], names=["source", "n"])
            own = key[row] // sources
            yield pa.record_batch({
                "lang": lang.dictionary.take(pa.array(own // known)).cast(pa.string()),
                "term": terms.dictionary.take(pa.array(own % known)).cast(pa.large_string()).cast(pa.string()),
                "docs": pa.array(np.add.reduceat(docs, row).astype(np.int64)),
                "uses": pa.ListArray.from_arrays(pa.array(np.append(row, len(key)), pa.int32()), entries)})


def _grouped(docs: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables: groups with their sums, kept terms with theirs, and the counts above 0 of groups."""
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    found = written(plain.mapInArrow(_counted, "lang string, term string, docs long, uses array<struct<source: string, n: long>>"), "divergence-found")
    kept = written(found.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs).select("lang", "term"), "divergence-kept")
    uses = match(found.select("lang", "term", "uses"), kept, ["lang", "term"], "left_semi").select("lang", "term", F.inline("uses"))
    counts = written(uses.groupBy("lang", "source", "term").agg(F.sum("n").alias("n")), "divergence-counts")
    terms = written(counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n")), "divergence-terms")
    sums = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    every = plain.select("lang", "source").distinct()
    groups = (every.join(own, ["lang", "source"], "left").join(sums, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
              .withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
              .withColumn("bands", F.ceil(F.count(F.lit(1)).over(Window.partitionBy("lang")) / BAND).cast("int")))
    return written(groups, "divergence-groups"), terms, counts


def _joint_values(key, table):
    """Values of all pairs of two bands over one block: ANDs of bitsets, counted, times the difference of their shares."""
    lang, _, low, high = (k.as_py() for k in key)
    col = {c: table.column(c).to_numpy() for c in ("number", "p", "place", "bits", "size")}
    size, present = int(col["size"][0]), col["place"] < 0
    number, zero_p = col["number"][present], col["p"][present]
    by = np.argsort(number)
    number, zero_p = number[by], zero_p[by]
    of = np.searchsorted(number, col["number"])
    band = number // BAND
    left, right = np.flatnonzero(band == low), np.flatnonzero(band == high)
    total = np.zeros((len(left), len(right)), np.int64)
    for w in range((size + 63) // 64):
        rows = np.flatnonzero(col["place"] == w)
        used = np.zeros(len(number), np.uint64)
        np.bitwise_or.at(used, of[rows], col["bits"][rows].view(np.uint64))
        full = np.uint64(2**min(64, size - 64 * w) - 1)
        group = np.concatenate([of[rows], np.arange(len(number))])
        bits = np.concatenate([col["bits"][rows].view(np.uint64), full & ~used])
        p = np.concatenate([col["p"][rows], zero_p])
        by = np.argsort(group, kind="stable")
        group, bits, p = group[by], bits[by], p[by]
        a, b = np.isin(group, left), np.isin(group, right)
        cells = np.bitwise_count(bits[a][:, None] & bits[b][None, :]).astype(np.int64) * np.abs(p[a][:, None] - p[b][None, :])
        first = [np.flatnonzero(np.diff(group[side], prepend=-1)) for side in (a, b)]
        total += np.add.reduceat(np.add.reduceat(cells, first[0], axis=0), first[1], axis=1)
    x, y = number[left][:, None] + 0 * number[right][None, :], number[right][None, :] + 0 * number[left][:, None]
    some = x < y
    return pa.table({"lang": pa.array([lang] * int(some.sum()), pa.string()), "a": pa.array(x[some].astype(np.int32)), "b": pa.array(y[some].astype(np.int32)),
                     "value": pa.array(total[some])})


def pair_values(groups: DataFrame, terms: DataFrame, counts: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(lang, a, b, value)`` for numbers ``a < b`` of groups of languages with kept terms."""
    in_block = Window.partitionBy("lang", "block")
    sizes, _ = bounded_broadcast(groups.select("lang", "terms").distinct(), MAX_BROADCAST_GROUPS)
    placed = (terms.join(sizes, "lang").withColumn("block", F.pmod(F.xxhash64("term"), F.ceil(F.col("terms") / block)).cast("long"))
              .withColumn("at", F.row_number().over(in_block.orderBy(F.desc("lang_n"), "term")) - 1)
              .withColumn("size", F.count(F.lit(1)).over(in_block).cast("int")).select("lang", "term", "block", "at", "size"))
    placed = written(placed, "divergence-places")
    known, _ = bounded_broadcast(groups.select("lang", "source", "number", "bands", "total", "terms"), MAX_BROADCAST_GROUPS)
    bit = F.expr("shiftleft(1L, at % 64)")
    levels = (counts.join(placed, ["lang", "term"]).withColumn("place", (F.col("at") / 64).cast("int"))
              .groupBy("lang", "source", "block", "size", "n", "place").agg(F.bit_or(bit).alias("bits")).join(known, ["lang", "source"]))
    none = (placed.select("lang", "block", "size").distinct().join(known, "lang")
            .select("*", F.lit(0).cast("long").alias("n"), F.lit(-1).alias("place"), F.lit(0).cast("long").alias("bits")))
    rows = levels.unionByName(none.select(*levels.columns))
    own, other = F.expr(f"number div {BAND}").cast("int"), F.col("other")
    dealt = (rows.withColumn("p", share(F.col("n"), F.col("total"), F.col("terms"))).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("bands") - 1)))
             .select("lang", "block", F.least(own, other).alias("low"), F.greatest(own, other).alias("high"), "number", "p", "place", "bits", "size"))
    return (dealt.groupBy("lang", "block", "low", "high").applyInArrow(_joint_values, "lang string, a int, b int, value long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))


def divergence(docs: DataFrame, min_docs: int = 30, top: int = 50, block: int = BLOCK) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how far the sources of each language lie apart, and by which terms."""
    groups, terms, counts = _grouped(docs, min_docs)
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    values = written(pair_values(groups, terms, counts, block), "divergence-values")
    values = values.unionByName(values.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = groups.select("lang", "source", F.col("number").alias("a"))
    others = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("b"))
    pairs = (names.join(others, "lang").filter("a <> b").join(values, ["lang", "a", "b"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
             .withColumn("rank", F.row_number().over(ranked)))
    known, _ = bounded_broadcast(groups.select("lang", "source", "total", "terms", "lang_total"), MAX_BROADCAST_GROUPS)
    p, q = share(F.col("n"), F.col("total"), F.col("terms")), share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    marked = (counts.join(terms, ["lang", "term"]).join(known, ["lang", "source"]).withColumn("value", p - q).filter("value > 0")
              .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
              .withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top))
    return pairs.unionByName(marked)
