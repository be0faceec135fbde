"""Versioned tables: whole versions, readers that go on, changed inputs, writers side by side."""

import threading

import pytest
from pyspark.sql import functions as F

from lodestar.operators.encode import hashed_vector
from lodestar.plans import common
from lodestar.session import scratch_path
from lodestar.sources import tables as tb
from lodestar.sources.versions import VersionedTable, fingerprint


@pytest.fixture
def table(spark):
    return VersionedTable(spark, scratch_path(spark, "versions"))


def test_never_written(table):
    assert table.read() is None and len(table) == 0 and table.versions() == [] and table.manifest() is None


def test_replace_while_being_read(spark, table):
    assert table.publish(spark.range(10)) == 1
    before = table.read()
    assert table.publish(spark.range(100, 103)) == 2
    assert before.count() == 10 and sorted(r["id"] for r in table.read().collect()) == [100, 101, 102]
    assert len(table) == 3 and table.read(1).count() == 10 and table.versions() == [1, 2]


def test_a_failed_write_changes_nothing(spark, table):
    table.publish(spark.range(4))
    with pytest.raises(Exception):
        table.publish(spark.range(4).select(F.raise_error(F.lit("broken")).alias("id")))
    assert table.versions() == [1] and table.read().count() == 4


def test_partitions_empty_tables_and_forgetting(spark, table):
    table.publish(spark.range(6).withColumn("bucket", (F.col("id") % 2).cast("int")), partition_by="bucket")
    assert "PartitionFilters: [isnotnull(bucket" in table.read().where("bucket = 1")._jdf.queryExecution().executedPlan().toString()
    table.publish(spark.range(0).withColumn("bucket", F.lit(1)), partition_by="bucket")
    assert table.read().collect() == [] and table.read().columns == ["id", "bucket"] and len(table) == 0
    table.publish(spark.range(1))
    assert table.forget(keep=1) == [1, 2] and table.versions() == [3] and table.read().count() == 1


def test_writers_side_by_side_get_numbers_of_their_own(spark, table):
    got = []
    threads = [threading.Thread(target=lambda n=n: got.append(table.publish(spark.range(n)))) for n in (3, 4, 5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == [1, 2, 3] and sorted(table.read(v).count() for v in got) == [3, 4, 5]


def test_changed_inputs_are_seen(spark, table, tmp_path):
    """The same folder with other rows: the kept table is built anew; unchanged, it is not."""
    rows = lambda n: [(i, " ".join(f"word{i}x{j} and more" for j in range(20)), "en", "src", 1) for i in range(n)]
    write = lambda n: spark.createDataFrame(rows(n), tb.DOCUMENTS).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    write(5)
    seen = fingerprint(spark, str(tmp_path))
    assert common.corpus(spark, str(tmp_path)).count() == 5 and fingerprint(spark, str(tmp_path)) == seen
    write(8)
    assert fingerprint(spark, str(tmp_path)) != seen and common.corpus(spark, str(tmp_path)).count() == 8
    builds = []
    for inputs in ("a", "a", "b"):
        table.current(inputs, lambda: builds.append(1) or spark.range(2))
    assert len(builds) == 2 and fingerprint(spark, f"{tmp_path}/missing") == fingerprint(spark, f"{tmp_path}/absent")


def test_vector_rows_keep_the_snippet(spark):
    df = spark.createDataFrame([(1, "c", "w " * 400, "src", 0)], "doc_id long, content_id string, text string, category string, label int")
    row = tb.vector_rows(df.withColumn("embedding", hashed_vector(F.col("text")))).first()
    assert len(row["text"]) == 500 and len(row["embedding"]) == 128


def test_corpus_write_observes_what_it_keeps(spark, table):
    """One scan of the texts in the plan that is written; totals equal a count of both sides."""
    from lodestar.operators import corpus as cp
    rows = [(i, " ".join(["some words here"] * (20 if i % 3 else 2)), "en", "s", 1) for i in range(30)]
    docs = spark.createDataFrame(rows, tb.DOCUMENTS)
    cats = spark.createDataFrame([(0, "s")], "label int, category string")
    raw = docs.select("doc_id", "text", F.lit(0).alias("label"))
    got = cp.write_corpus(table, raw, cats)
    assert got == {"kept": 20, "discarded": 10} and table.read().count() == 20
