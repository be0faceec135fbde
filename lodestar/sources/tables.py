"""Scans, dimension decode and persisted tables.

All reads use explicit schemas so no inference job runs, and all tables
are keyed by id (never by position), so reloads join by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.session import bounded_broadcast

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])
EMBEDDINGS = T.StructType([
    T.StructField("vec_id", T.LongType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()),
])
LABELS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("quality", T.IntegerType()),
    T.StructField("toxic", T.IntegerType()),
])
CONVERSATIONS = T.StructType([
    T.StructField("conv_id", T.LongType()),
    T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
])
PAGES = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])
BENCHMARK = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("text", T.StringType()),
])
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
SCHEMAS = {"documents": DOCUMENTS, "embeddings": EMBEDDINGS, "labels": LABELS,
           "conversations": CONVERSATIONS, "pages": PAGES, "benchmark": BENCHMARK,
           "events": EVENTS}

# Upper bound on the category dimension we are willing to broadcast.
MAX_CATEGORIES = 100_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one parquet table with its declared schema."""
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def split_of(doc_id) -> F.Column:
    """Deterministic train/test split: 'test' for one fifth of the ids."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit("split|"), doc_id.cast("string"))), 1, 8), 16, 10)
    return F.when(h.cast("long") % 5 == 0, F.lit("test")).otherwise(F.lit("train"))


def categories(documents: DataFrame, category_col: str = "source") -> DataFrame:
    """Category dimension ``(label INT, category STRING)``: distinct category
    names numbered in name order (null names nothing).  Partial aggregation
    keeps the distinct small before its shuffle; the numbering window runs
    over that distinct set only.  The dimension is written once, as its size
    is checked before every join."""
    w = Window.orderBy("category")
    return (documents.select(F.col(category_col).alias("category")).where("category IS NOT NULL").distinct()
            .withColumn("label", (F.row_number().over(w) - 1).cast("int"))
            .select("label", "category").checkpoint())


def scan_corpus(spark: SparkSession, sf_dir: str, subset: str = "all",
                category_col: str = "source", cats: DataFrame | None = None) -> DataFrame:
    """A1: raw labelled corpus ``(doc_id, text, label, category, split)``;
    ``subset`` is one of all/train/test and becomes a plain filter.  Texts are
    not moved: the dimension is broadcast if its counted rows are within the
    bound.  Rows without a category stay, with a null label."""
    docs = read_table(spark, sf_dir, "documents")
    cats = categories(docs, category_col) if cats is None else cats
    raw = (docs.select("doc_id", "text", F.col(category_col).alias("category"))
           .join(bounded_broadcast(cats, MAX_CATEGORIES)[0], "category", "left")
           .select("doc_id", "text", "label", "category", split_of(F.col("doc_id")).alias("split")))
    if subset != "all":
        raw = raw.where(F.col("split") == subset)
    return raw


def decode_labels(df: DataFrame, cats: DataFrame) -> DataFrame:
    """A2: label -> category name; unknown labels keep a null name."""
    return df.join(bounded_broadcast(cats, MAX_CATEGORIES)[0], "label", "left")


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    """A3/A4/A5/A7/A8 sink: overwrite a parquet table (optionally partitioned)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    """A8 JSON sink for analysis tables."""
    df.write.mode("overwrite").json(path)
    return path


def load_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """Reload a written table; ``None`` when it does not exist."""
    try:
        r = spark.read
        if schema is not None:
            r = r.schema(schema)
        return r.parquet(path)
    except Exception as e:  # missing path
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return None
        raise


def vector_table(corpus: DataFrame, vectors: DataFrame) -> DataFrame:
    """A5: join clean corpus and vectors by key; keep a 500-char snippet as
    the stored text (what a reload returns)."""
    return (corpus.join(vectors, "doc_id")
            .select("doc_id", "content_id", F.substring("text", 1, 500).alias("text"),
                    "category", "label", "embedding"))


def vector_rows(encoded: DataFrame) -> DataFrame:
    """A5 from a corpus that carries its vectors: the same columns, without a join."""
    return encoded.select("doc_id", "content_id", F.substring("text", 1, 500).alias("text"), "category", "label", "embedding")
