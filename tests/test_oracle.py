"""Registered queries against their DuckDB oracle SQL on the smallest
tables (the driver runs the same comparison at sf0.01)."""

import os

import duckdb
import pytest

from tests.conftest import SF_SMALL

FAST = ["a1_scan_corpus", "a2_decode_labels", "b2_strip_footer", "b3_newsgroup_loader", "b10_clean_posts",
        "b13_is_valid", "b15_retention", "b16_dedup", "c1_hashed_vectors", "c5_sq_dist", "d1_topk", "d3_cluster_topk",
        "d5_answer_text", "e3_memberships", "e4_objective", "h6_replay", "h9_stats", "h13_scope_audit",
        "i5_threshold_sweep", "g2_top_categories", "g7_top_terms", "f3_davies_bouldin"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["documents", "embeddings", "labels", "conversations", "pages", "benchmark", "events"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_a_callable_and_names_match():
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 80


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF_SMALL)
    r = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in r.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(x) for x in df.collect()]) == _rows(dcols, r.fetchall())


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0
    assert "cache_hit" in df.columns or "rank" in df.columns
