"""B15-B17 and the derived newsgroup-style post table used to exercise the
loader strippers and the cleaning chain on real table rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lodestar.functions import text as tx
from lodestar.session import spread
from lodestar.sources.tables import decode_labels
from lodestar.sources.versions import VersionedTable


def clean_and_validate(raw: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``clean`` and ``valid`` columns (B10 + B13)."""
    return (raw.withColumn("clean", tx.clean_text(F.col(text_col)))
            .withColumn("valid", tx.is_valid(F.col("clean"))))


def cleaned(raw: DataFrame, keys: list[str], text_col: str = "text", max_chars: int | None = tx.MAX_CHARS) -> DataFrame:
    """``keys`` + ``clean``.  The clean text comes out of a one-element
    ``explode``: the optimizer does not push predicates on generated columns
    below the generator, so a later validity filter cannot re-evaluate the
    whole cleaning chain inside the filter (it runs once per row)."""
    return raw.select(*keys, F.explode(F.array(tx.clean_text(F.col(text_col), max_chars))).alias("clean"))


def prepare_corpus(raw: DataFrame, cats: DataFrame, max_chars: int | None = tx.MAX_CHARS) -> DataFrame:
    """Clean -> keep valid -> content id -> category name.

    ``raw`` is ``(doc_id, text, label, ...)``; output is ``(doc_id,
    content_id, text, label, category)``.  ``max_chars`` cuts the cleaned text
    (an encoder's window); None keeps it whole.
    """
    kept = (cleaned(raw, ["doc_id", "label"], max_chars=max_chars).where(tx.is_valid(F.col("clean")))
            .select("doc_id", "label", F.col("clean").alias("text"))
            .withColumn("content_id", tx.content_id(F.col("text"))))
    return decode_labels(kept, cats).select("doc_id", "content_id", "text", "label", "category")


def write_corpus(table: VersionedTable, raw: DataFrame, cats: DataFrame, max_chars: int | None = None, inputs: str = "") -> dict:
    """B17 published as a version of ``table``, with B15's totals from the same pass.

    Rows read and rows kept are observed by the write itself; nothing is
    scanned twice.  ``raw`` should come from its last shuffle, as a shuffle
    that is run again after a loss would count its rows again.
    """
    read = Observation()
    version = table.publish(prepare_corpus(raw.observe(read, F.count(F.lit(1)).alias("rows")), cats, max_chars), inputs)
    kept = table.manifest(version)["rows"]
    return {"kept": kept, "discarded": read.get["rows"] - kept}


def retention_report(raw: DataFrame, by: str | None = None) -> DataFrame:
    """Kept / discarded / percent discarded (optionally per group)."""
    keys = [by] if by else []
    # cleaned once a row: both sums would repeat the whole chain
    v = cleaned(spread(raw), keys).select(*keys, F.explode(F.array(tx.is_valid(F.col("clean")))).alias("valid"))
    agg = v.groupBy(*keys).agg(
        F.sum(F.when(F.col("valid"), 1).otherwise(0)).cast("long").alias("kept"),
        F.sum(F.when(F.col("valid"), 0).otherwise(1)).cast("long").alias("discarded"))
    return agg.withColumn("pct_discarded", F.round(
        F.try_divide(F.col("discarded") * 100.0, F.col("kept") + F.col("discarded")), 1))


def duplicate_groups(corpus: DataFrame) -> DataFrame:
    """Groups of identical cleaned texts with their lowest doc_id.

    Plain aggregation (partial + final), so a content id holding a large
    share of the rows is pre-aggregated map-side instead of landing whole
    in one window task."""
    return (corpus.groupBy("content_id")
            .agg(F.count(F.lit(1)).alias("n_copies"), F.min("doc_id").alias("keep_doc_id")))


def dedup(corpus: DataFrame) -> DataFrame:
    """One row per content id, the one with the lowest doc_id."""
    cols = corpus.columns
    best = corpus.groupBy("content_id").agg(
        F.min_by(F.struct(*[c for c in cols if c != "content_id"]), F.col("doc_id")).alias("r"))
    return best.select("content_id", "r.*").select(*cols)


def newsgroup_posts(conversations: DataFrame, pages: DataFrame) -> DataFrame:
    """A raw post per conversation turn, shaped like a newsgroup message:
    header block, attribution line, quoted line with CRLF, body, a run of
    blank lines, a URL-only line (the page with the same id, if any), an
    indented copy of the body and a signature footer."""
    p = pages.select(F.col("page_id").alias("conv_id"), "url")
    c = conversations.join(p, "conv_id", "left")
    url = F.coalesce(F.col("url"), F.concat(F.lit("http://example.org/c/"), F.col("conv_id").cast("string")))
    nl = F.lit("\n")
    raw = F.concat(
        F.lit("From: "), F.col("role"), F.lit("@example.org"), nl,
        F.lit("Subject: turn "), F.col("turn").cast("string"), nl, nl,
        F.col("role"), F.lit(" writes:"), nl,
        F.lit("> "), F.col("text"), F.lit("\r\n"),
        F.col("text"), F.lit("\r\n\n\n\n"),
        url, nl,
        F.lit("   "), F.col("text"), F.lit("  "), nl,
        F.lit("-- "), nl, F.col("role"), F.lit(" signature"))
    return c.select(F.col("conv_id"), F.col("turn"), raw.alias("raw"))
