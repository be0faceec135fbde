import re

from llm_helpers import prose

from lodestar.llm.components import connected_components
from lodestar.llm.minhash import near_duplicates


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1)))


def expected(rows, k, percent=80):
    sets = {}
    for r in rows:
        if r[0] is not None:
            sets.setdefault(r[0], []).append(shingles(r[1], k))
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and any(a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[x] for b in sets[y]):
                lo, hi = sorted((root(x), root(y)))
                parent[hi] = lo
    return sorted(((r[0], len(shingles(r[1], k)), None if r[0] is None else root(r[0]), r[0] is None or root(r[0]) == r[0]) for r in rows), key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def test_edge_cases_match_brute_force(make_docs, edge_rows):
    for k in (4, 5):
        assert result(near_duplicates(make_docs(edge_rows, clash=True), k=k)) == expected(edge_rows, k)


def test_empty_table(make_docs):
    assert near_duplicates(make_docs([])).collect() == []


def test_chains_and_a_large_group_of_near_copies(make_docs):
    """Copies that differ in some words, many of them near the limit, so that stars alone can't join them."""
    base = prose(7, 200)
    rows = []
    for i in range(150):
        words = list(base)
        for j in range(1 + i % 7):
            words[(37 * i + 29 * j) % 200] = f"x{i}_{j}"
        rows.append((100 + i, " ".join(words), "en", "s"))
    # a chain: each is near its neighbours only
    rows += [(500 + i, " ".join(prose(8, 400)[i * 6:i * 6 + 200]), "en", "s") for i in range(30)]
    assert result(near_duplicates(make_docs(rows), k=4)) == expected(rows, 4)


def test_several_texts_under_one_id(make_docs):
    a, b = " ".join(prose(11, 80)), " ".join(prose(12, 80))
    rows = [(9, a), (9, b), (4, a), (5, b), (6, "else where")]
    assert result(near_duplicates(make_docs(rows), k=4)) == expected(rows, 4)


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 3), (7, 8), (8, 8), (None, 1), (5, 4), (4, 5), (20, 21)] + [(100, i) for i in range(101, 200)], "u long, v long")
    got = {r["vertex"]: r["component"] for r in connected_components(edges).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 7: 7, 8: 7, 4: 4, 5: 4, 20: 20, 21: 20, **{i: 100 for i in range(100, 200)}}
    assert connected_components(edges.limit(0)).collect() == []
