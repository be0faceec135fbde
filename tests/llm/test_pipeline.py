"""Every stage against brute force on its own input, and the whole run against its stages."""
import hashlib
import re

import corpus_pipeline
import pytest
from llm_helpers import prose
from test_minhash import shingles
from test_quality import counts
from test_substring import expected as cut

from lodestar.llm.queries import QUERIES

COLUMNS = list(corpus_pipeline.COLUMNS)


@pytest.fixture(scope="module")
def folder(spark, make_docs, edge_rows, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    rows = edge_rows + [(100 + i, " ".join(prose(i, 60 + 5 * i)), ("en", "fr")[i % 2], f"s{i % 3}") for i in range(25)]
    rows += [(130, " ".join(["spam"] * 80), "en", "s1"), (131, " ".join(prose(3, 70)) + "\n" + " ".join(prose(105, 80)), "en", "s2")]
    make_docs(rows).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(100 + i, 1, 0) for i in range(25)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "minhash_dedup", "substring_dedup", "mix_sources", "pack_sequences"]
    out = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        out.append(docs)
        if i < 4:
            assert docs.columns == COLUMNS
    given = rows_of(spark.read.parquet(f"{folder}/documents.parquet"))
    base = lambda t: (c := counts(t))[0] >= 50 and 100 * c[4] <= 50 * c[0]
    kept = [r for r in given if base(r[1])]  # too few labels for a cutoff
    assert rows_of(out[0]) == kept

    # one row of each group of near copies, the one with the smallest id; rows without an id stay
    ids = sorted({r[0] for r in kept if r[0] is not None})
    sets = {i: shingles(next(r[1] for r in kept if r[0] == i), 5) for i in ids}
    group = {i: i for i in ids}
    for _ in ids:
        for x in ids:
            for y in ids:
                if 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                    group[x] = group[y] = min(group[x], group[y])
    stay = {i for i in ids if group[i] == i}
    assert rows_of(out[1]) == sorted({r for r in kept if r[0] is None or r[0] in stay}, key=str)

    # repeated passages are cut, and documents without any words left go
    want = [(r[0], r[3]) for r in cut(rows_of(out[1]), 50) if r[1] > r[2]]
    left = rows_of(out[2])
    digest = lambda t: hashlib.sha256(" ".join(re.findall(r"[^\x20\x09-\x0D]+", t)).encode()).hexdigest()
    assert sorted(((r[0], digest(r[1])) for r in left), key=str) == sorted(want, key=str)
    assert all(r[4] == len(r[1]) for r in left)

    # the mix holds half as many words again, and no document more than twice
    size, taken = {}, {}
    for r in left:
        size[r[0]] = size.get(r[0], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r[1]))
    for r in rows_of(out[3]):
        assert r[4] == len(r[1])
        taken[r[0]] = taken.get(r[0], 0) + len(r[1].split())
    assert all(n <= 2 * size[i] for i, n in taken.items())
    assert abs(sum(taken.values()) - 1.5 * sum(size.values())) < 0.02 * sum(size.values())

    pieces = out[4].collect()
    assert {r["doc_id"] for r in pieces} == set(taken)
    used = {}
    for r in pieces:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in used.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 2048 and (at == 2048 or at & (at - 1) == 0)


def test_run_is_the_registered_query(spark, folder):
    import __spark_entry__
    assert __spark_entry__.queries()["pipeline"].__name__ == "run" and corpus_pipeline.ORACLE_SQL is None
    assert corpus_pipeline.run(spark, folder).count() > 0
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_empty_documents(spark, make_docs, folder, tmp_path):
    docs = make_docs([])
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        assert docs.count() == 0
