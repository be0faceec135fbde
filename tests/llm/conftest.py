import pytest
from llm_helpers import prose
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: For tests outside of this folder that find this file under the name conftest when both folders are run.
SF_CHECK = "/root/testdata/sf0.01"
#: Names that the operators use inside.
CLASHING = ("h", "key", "n", "mark", "component", "size", "place", "lo", "p", "c", "word_from", "w", "lines", "held_out")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang, source]) rows; ``clash`` adds columns with the operators' inner names."""
    def make(rows, clash=False, partitions=3):
        rows = [(*r, *(None,) * (4 - len(r)), len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(rows, DOC).repartition(partitions)
        if clash:
            from pyspark.sql import functions as F
            df = df.select("*", *[F.lit("x").alias(c) for c in CLASHING])
        return df
    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty, one word, white space only, repeated rows, exact and near copies, a very long text."""
    a, b = prose(1, 120), prose(2, 150)
    near = a[:60] + ["other"] + a[61:]
    long = prose(3, 30_000, 5000)
    return [
        (1, " ".join(a), "en", "s1"), (2, " ".join(near), "en", "s1"), (3, " ".join(a), "en", None), (3, " ".join(a), "en", None),
        (4, " ".join(b), "fr", "s2"), (5, None, None, "s2"), (6, "", "fr", "s2"), (7, "word", "fr", "s3"), (8, " \t\n ", "en", "s3"),
        (None, " ".join(a), "en", "s1"), (None, None, None, None), (9, " ".join(b[:70] + prose(4, 90)), "fr", "s2"),
        (10, " ".join(long), "en", "s1"), (11, " ".join(long[:20_000] + prose(5, 100)), "en", "s1"), (12, "One Two three", "en", "s9"),
        (13, "one two THREE", "en", "s9"), (14, "été x  y", "fr", "s2"), (15, "a\x0bb\x0cc\rd", "en", "s3"),
    ]
