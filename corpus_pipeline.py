"""The training-data pipeline: five stages over ``documents``, each applying one operator.

Every function takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which
is written as Parquet and read again as the next stage's ``docs``.  All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm.minhash import near_duplicates
from lodestar.llm.mixing import mix, taken_text
from lodestar.llm.packing import pack_documents
from lodestar.llm.quality import judge
from lodestar.llm.queries import table, tokenizer
from lodestar.llm.shared import match, written
from lodestar.llm.substring import drop_repeats
from lodestar.session import checkpoint_root, ship_package

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _ready(spark: SparkSession) -> None:
    checkpoint_root(spark)
    ship_package(spark)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base test or a rule rejects go; rows that repeat an id are judged each by its own text."""
    _ready(spark)
    verdicts = judge(docs, table(spark, sf_dir, "labels"))
    gone = written(verdicts.filter("not kept").select("doc_id", "mark").distinct(), "pipeline-rejected")
    return match(docs.withColumn("mark", F.xxhash64("text")), gone, ["doc_id", "mark"], "left_anti").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id (five words, similarity 0.8).

    Of rows that repeat an id the one with the smallest text stays; rows without an id all stay.
    """
    _ready(spark)
    gone = written(near_duplicates(docs, k=5, percent=80).filter("not kept").select("doc_id").distinct(), "pipeline-copies")
    kept = match(docs, gone, ["doc_id"], "left_anti").select(*COLUMNS)
    repeated = written(docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "pipeline-repeated")
    if repeated.isEmpty():
        return kept
    once = (match(kept, repeated, ["doc_id"], "left_semi").groupBy("doc_id").agg(F.min(F.struct(*COLUMNS[1:])).alias("r"))
            .select("doc_id", "r.*"))
    return match(kept, repeated, ["doc_id"], "left_anti").unionByName(once)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words that a document with a smaller id holds are cut out; documents left without a word go."""
    _ready(spark)
    kept = drop_repeats(docs, width=50, with_text=True, carry=("lang", "source"))
    return (kept.filter("n_words > n_removed").withColumnRenamed("kept_text", "text")
            .withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares: a document is repeated, cut to the words that the mix takes of it, or left out."""
    _ready(spark)
    taken = mix(docs)
    return taken_text(docs, taken).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens; every row of the mix is a document of its own."""
    _ready(spark)
    return pack_documents(docs, tokenizer(), capacity=2048)


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Neither the tokenizer nor the packing can be stated in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's output is a table in the shared folder."""
    _ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
