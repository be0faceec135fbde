"""Mixing sources to target weights by Sainte-Lague apportionment.

1. *Targets.*  Sources share ``share`` times all words by weight; a target
   stops at ``max_repeat`` times its source's words and the excess is shared
   among the others by weight until none is above (closed form: sources
   ordered by cap per weight).
2. *Quotas.*  The mix is cut into equal blocks of words.  Blocks go to sources
   by the highest quotients ``target / (2 * seats + 1)``, then each source's
   blocks to its shards by the same rule, as integers.
3. *Blocks.*  A shard lays its documents end to end in seeded order, as a
   cycle of words; its quota is a run of blocks from a seeded start.  A run
   longer than the shard goes round again, so no document is taken more than
   ``max_repeat`` times.

Shards are hash shards of bounded size, so a source with most of the rows is
spread over many tasks; only one row a shard meets in a group of its source.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.shared import written
from lodestar.llm.wordhash import slices, split_words

#: Words of a shard, about; the shard is the unit whose documents are put in order.
SHARD_WORDS = 200_000
#: Shards of a source, at most; a source beyond that has larger shards (their quotas meet in one task).
MAX_SHARDS = 65_536
#: Largest block of words.
BLOCK_WORDS = 64
#: A source has at least this many blocks, so that rounding stays below a percent of it.
MIN_BLOCKS = 128


def n_words(text: Column) -> Column:
    """Number of runs without ASCII white space (null: 0)."""
    bare = F.btrim(F.coalesce(text.cast("string"), F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, "[ \\t\\n\\x0B\\f\\r]+", -1))).cast("long")


def place_of(seed: int) -> Column:
    """A document's place in the seeded order, from its id and text."""
    return F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), F.col("text").cast("string"))


def sainte_lague(votes: np.ndarray, seats: int, caps: np.ndarray) -> np.ndarray:
    """Integer seats by highest quotients ``votes / (2 s + 1)``, at most ``caps`` each; ties go to the earlier entry.

    Seats are first dealt for a divisor found by bisection that gives too
    few, and the few that are missing one by one.
    """
    votes, caps = votes.astype(float), caps.astype(np.int64)
    seats = int(min(seats, caps[votes > 0].sum()))
    out = np.zeros(len(votes), dtype=np.int64)
    if seats <= 0:
        return out

    def dealt(d: float) -> np.ndarray:
        return np.minimum(np.floor(votes / d + 0.5).astype(np.int64), np.where(votes > 0, caps, 0))

    few, many = 2 * votes.max() + 1, votes[votes > 0].min() / (2.0 * seats + 2)  # divisors: no seats; all seats
    for _ in range(200):
        mid = (few * many) ** 0.5
        if not many < mid < few:
            break
        if dealt(mid).sum() > seats:
            many = mid
        else:
            few = mid
    out = dealt(few)
    while out.sum() < seats:
        quotient = np.where(out < caps, votes / (2.0 * out + 1), -1.0)
        out[int(quotient.argmax())] += 1
    return out


def _apportion(table: pa.Table) -> pa.Table:
    """Seats of one group: columns ``votes``, ``seats`` (the group's), ``cap``; rows in the order of ``at``."""
    table = table.sort_by("at")
    got = sainte_lague(*(f(table.column(c)) for c, f in (("votes", lambda x: x.to_numpy()), ("seats", lambda x: x[0].as_py()),
                                                         ("cap", lambda x: x.to_numpy()))))
    return pa.table({"group": table.column("group"), "at": table.column("at"), "quota": pa.array(got, pa.int64())})


def targets(sources: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_repeat: int = 2) -> DataFrame:
    """``sources`` (source, source_size) with ``at`` (order by code point, null last), ``weight`` and ``target``.

    Windows without partitions run over one row per source.
    """
    by_name = Window.partitionBy(F.lit(1)).orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(1))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("at") - 1) % len(weights)).cast("int"))
    s = (sources.withColumn("at", F.row_number().over(by_name)).withColumn("weight", weight)
         .withColumn("cap", (F.col("source_size") * max_repeat).cast("double"))
         .withColumn("total", F.sum("source_size").over(every) * F.lit(float(share))))
    # sources that stop at their cap come first in this order; the others share the rest by weight
    by_fill = Window.partitionBy(F.lit(1)).orderBy(F.col("cap") / F.col("weight"), "at")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing))
    s = s.withColumn("level", level).withColumn("stops", F.col("cap") <= F.col("level") * F.col("weight"))
    common = F.max(F.when(~F.col("stops"), F.col("level"))).over(every)  # levels fall after the first that does not stop
    return (s.withColumn("target", F.when(F.col("stops"), F.col("cap")).otherwise(common * F.col("weight")))
            .select("source", "source_size", "at", "weight", "target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_repeat: int = 2, seed: int = 7,
        shard_words: int = SHARD_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, word_from)``, one row per row of ``docs``.

    ``size`` counts the words of the whole text (null: 0); ``taken`` is the
    number of words the mix takes of the document, repeats counted, at most
    ``max_repeat * size``.  The words beyond whole repeats are the run of
    ``taken % size`` words that starts at ``word_from`` (going round its end).
    Null sources are a source of their own, the last.  Rows that repeat an id
    are told apart by their text; fully equal rows by nothing, so they are
    laid one after the other.  A source without words has target 0.  The
    result depends on the rows and ``seed`` only, not on their partitions.
    """
    sized = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                                n_words(F.col("text")).alias("size"), place_of(seed).alias("place")), "mix")
    sources = written(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_repeat), "mix-sources")

    # one block size for all: small enough for the smallest source
    all_sources = Window.partitionBy(F.lit(1))
    least = F.min(F.when(F.col("source_size") > 0, F.col("source_size"))).over(all_sources)
    block = F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(least / MIN_BLOCKS))).cast("long")
    shared = (sources.withColumn("block", F.coalesce(block, F.lit(1).cast("long")))
              .withColumn("seats", F.round(F.sum("target").over(all_sources) / F.col("block")).cast("long"))
              .withColumn("cap", F.floor(F.col("source_size") * max_repeat / F.col("block")).cast("long")))
    fields = "group int, at int, quota long"
    source_quota = (shared.select(F.lit(0).alias("group"), "at", F.col("target").alias("votes"), "seats", "cap")
                    .groupBy("group").applyInArrow(_apportion, fields))
    plan = (shared.join(source_quota.select("at", "quota"), "at")
            .withColumn("shards", F.least(F.lit(MAX_SHARDS), F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words))).cast("int"))
            .select(F.col("source").alias("of"), "at", "source_size", "target", "block", "quota", "shards"))

    placed = (sized.join(plan, F.col("source").eqNullSafe(F.col("of")))
              .withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "place"), F.col("shards")).cast("int")))
    shards = placed.groupBy("at", "shard").agg(F.sum("size").alias("shard_size"), F.first("block").alias("block"), F.first("quota").alias("seats"))
    quotas = (shards.select(F.col("at").alias("group"), F.col("shard").alias("at"), F.col("shard_size").cast("double").alias("votes"), "seats",
                            F.floor(F.col("shard_size") * max_repeat / F.col("block")).cast("long").alias("cap"))
              .groupBy("group").applyInArrow(_apportion, fields).select(F.col("group").alias("at"), F.col("at").alias("shard"), "quota"))
    runs = (shards.join(quotas, ["at", "shard"])
            .withColumn("words", F.col("quota") * F.col("block"))
            .withColumn("whole", F.when(F.col("shard_size") > 0, F.floor(F.col("words") / F.col("shard_size"))).otherwise(0).cast("long"))
            .withColumn("run", F.col("words") - F.col("whole") * F.col("shard_size"))
            .withColumn("start", F.when(F.col("shard_size") > 0, F.pmod(F.xxhash64(F.lit(seed + 2), "at", "shard"), F.col("shard_size"))).otherwise(0))
            .select("at", "shard", "shard_size", "whole", "run", "start"))
    order = Window.partitionBy("at", "shard").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    laid = (placed.withColumn("offset", F.coalesce(F.sum("size").over(order), F.lit(0)))
            .join(runs, ["at", "shard"]))
    # the run is [start, start + run) on the cycle; seen from the document it may be cut in two
    lo, hi = F.col("offset"), F.col("offset") + F.col("size")
    end = F.col("start") + F.col("run")
    first = F.greatest(F.lit(0), F.least(hi, end) - F.greatest(lo, F.col("start")))
    second = F.greatest(F.lit(0), F.least(hi, end - F.col("shard_size")) - lo)
    begins = F.when(first > 0, F.greatest(lo, F.col("start")) - lo).otherwise(F.lit(0))
    return laid.select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"),
                       (F.col("whole") * F.col("size") + first + second).cast("long").alias("taken"),
                       begins.cast("long").alias("word_from"), "place", "source")


def _repeat(columns: list[str]):
    def run(batches):
        for b in batches:
            for at, n in slices(b.column("text")):
                part = b.slice(at, n)
                words = split_words(part.column("text"))
                take, texts = [], []
                for i, (taken, begin) in enumerate(zip(part.column("taken").to_pylist(), part.column("word_from").to_pylist())):
                    lo, size = int(words.first[i]), int(words.first[i + 1] - words.first[i])
                    if not taken or not size:
                        continue
                    whole, run_words = divmod(taken, size)
                    own = [part.column("text")[i].as_py()] * whole
                    if run_words:
                        cut = lambda a, z: words.data[words.start[lo + a]:words.end[lo + z - 1]].tobytes().decode()  # noqa: E731, B023
                        end = begin + run_words
                        own.append(cut(begin, end) if end <= size else cut(begin, size) + "\n" + cut(0, end - size))
                    take += [i] * len(own)
                    texts += own
                out = part.take(pa.array(take, pa.int64()))
                yield pa.record_batch({c: pa.array(texts, pa.string()) if c == "text" else out.column(c) for c in columns})
    return run


def taken_text(docs: DataFrame, taken: DataFrame, seed: int = 7) -> DataFrame:
    """The rows of the mix, with the columns of ``docs``: a row for each whole repeat and one for the words beyond.

    ``taken`` is what ``mix`` gave for ``docs`` and ``seed``.  Documents that
    the mix does not take are left out.  Equal rows are taken together.
    """
    columns = docs.columns
    plan = written(taken.select("place", "taken", "word_from"), "mix-taken")
    keyed = docs.withColumn("place", place_of(seed))
    if not plan.groupBy("place").count().filter("count > 1").isEmpty():
        plan = plan.groupBy("place").agg(F.sum("taken").alias("taken"), F.max("word_from").alias("word_from"))
        keyed = keyed.dropDuplicates(["place"])
    chosen = keyed.join(plan.filter("taken > 0"), "place").select(*columns, "taken", "word_from")
    return chosen.mapInArrow(_repeat(columns), docs.schema)
