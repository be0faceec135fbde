import base64
import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from llm_helpers import prose
from lodestar.llm import fingerprint as fp


def pieces(text: str) -> list[bytes]:
    """Paragraphs of one text by a plain walk over its bytes."""
    data, out, start = text.encode(), [], 0
    for i in range(1, len(data)):
        cut = data[i - 1] == 10
        if i >= fp.WINDOW:
            h = 0
            for b in data[i - fp.WINDOW:i]:
                h = (h * 0x01000193 + ((((b + 1) * 0x9E3779B1) ^ 0x85EBCA6B) & 0xFFFFFFFF)) & 0xFFFFFFFF
            h ^= h >> 15
            cut |= (h * 0x2C1B3C6D & 0xFFFFFFFF) >> 27 == 0
        if cut:
            out.append(data[start:i])
            start = i
    return out + [data[start:]] if data else []


def alike(a: str, b: str) -> float:
    x, y = Counter(pieces(a)), Counter(pieces(b))
    return (x & y).total() / (x | y).total() if x or y else 1.0


def corpus():
    r, rows = random.Random(2), []
    for i in range(150):
        lines = ["".join(r.choice(["été ", "word ", "漢字", "lorem ipsum ", "x"]) for _ in range(r.randrange(30))) for _ in range(r.randrange(12))]
        rows.append((r.randrange(10**12), "\n".join(lines)))
    rows += [(3, None), (4, ""), (5, "abc"), (6, "abcd"), (7, "same\n" * 400), (8, "same\n" * 400), (9, "same\n" * 401), (None, "no id"), (None, None),
             (10, " ".join(prose(1, 60_000, 3000))), (11, "tail " + " ".join(prose(1, 60_000, 3000))), (12, "twice"), (12, "twice"), (12, "once")]
    return rows + [(77, "many equal rows of one id")] * 60


def followed(rows):
    """Each distinct (id, text) with the text of the next, ids ascending with nulls first; ties by the hash are left to the caller."""
    docs = sorted({(i, t or "") for i, t in rows}, key=lambda d: (d[0] is not None, d[0] or 0))
    return [(a[0], a[1], b[1]) for a, b in zip(docs, docs[1:] + docs[:1])]


def test_paragraphs_equal_a_plain_walk():
    texts = [t for _, t in corpus()] + ["\n", "\n\n\n", "a" * 11, "b" * 500]
    got = fp.paragraphs(pa.array(texts))
    sizes = [len(pieces(t or "")) for t in texts]
    assert got.counts.tolist() == sizes
    alone = [fp.paragraphs(pa.array([t])).value.tolist() for t in texts]
    assert [got.value[a:b].tolist() for a, b in zip(got.first, got.first[1:])] == alone  # a batch's other texts have no say
    assert len({v for t, v in zip(texts, map(tuple, alone))}) == len(set(t or "" for t in texts))
    assert all(len(set(v)) == len(v) for v in alone)  # equal paragraphs are numbered


def test_peeling_gives_exactly_the_differences():
    r = np.random.default_rng(5)
    for n_same, n_a, n_b in ((0, 0, 0), (0, 1, 0), (300, 2, 1), (50, 40, 0), (1000, 900, 1100), (0, 5000, 1)):
        same, a, b = (r.integers(0, 2**64, n, dtype=np.uint64) for n in (n_same, n_a, n_b))
        left, right = fp.Digests(np.concatenate([same, a]), np.array([0, n_same + n_a])), fp.Digests(np.concatenate([b, same]), np.array([0, n_same + n_b]))
        pair, digest, sign = fp.differences(left, np.array([0]), right, np.array([0]))
        assert sorted(digest[sign == 1].tolist()) == sorted(a.tolist()) and sorted(digest[sign == -1].tolist()) == sorted(b.tolist())
        assert not pair.any()


def test_failed_peeling_is_told_and_a_larger_sketch_succeeds():
    r = np.random.default_rng(6)
    digests = fp.Digests(r.integers(0, 2**64, 200, dtype=np.uint64), np.array([0, 200]))
    assert not fp.sketch(digests, cells=4).peel()[3][0]
    row, digest, sign, whole = fp.sketch(digests, cells=256).peel()
    assert whole[0] and sorted(digest.tolist()) == sorted(digests.value.tolist()) and (sign == 1).all()


def test_against_brute_force(spark):
    rows = corpus()
    names = "doc_id long, text string"
    docs = spark.createDataFrame(rows, names).selectExpr("*", "'x' h", "1 n", "2 part", "3 last", "4 `to`", "5 fingerprint").repartition(6)
    got = fp.fingerprint_documents(docs).collect()
    assert len(got) == len(rows)
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    want = {}
    for i, text, after in followed(rows):
        want.setdefault(i, []).append((text, after))
    seen, last = {}, max(i for i, _ in rows if i is not None)
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if r["doc_id"] in (None, 12, 11, last):  # ids with ties, and what comes before one, below
            continue
        (text, after), = want[r["doc_id"]]
        k = len(text) // 4
        edited = text[:len(text) - k] + after[:k]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        if r["doc_id"] != 10:
            assert abs(r["near_edited"] - alike(text, edited)) < 1e-12 and abs(r["near_next"] - alike(text, after)) < 1e-12
        assert len(base64.b64decode(r["fingerprint"])) == 12 * 20
        for t, f in ((text, r["fingerprint"]), (edited, r["edited_fingerprint"])):
            assert seen.setdefault(t, f) == f
    assert len(set(seen.values())) == len(seen)
    by = {r["doc_id"]: r for r in got}
    (text, _), = want[last]  # followed by the first of the rows without an id
    k = len(text) // 4
    starts = {hashlib.sha256((text[:len(text) - k] + after[:k]).encode()).hexdigest() for after in ("no id", "")}
    assert by[last]["n_chars"] == len(text) and by[last]["edited_sha256"] in starts
    assert by[7]["near_next"] == 1 and by[7]["fingerprint"] == by[8]["fingerprint"] and by[8]["near_next"] == 400 / 401
    assert by[10]["near_next"] > 0.99 and 0.55 < by[10]["near_edited"] < 0.65
    assert len({tuple(r) for r in got if r["doc_id"] == 77}) == 1


def test_ties_take_each_other_in_turn(spark):
    """Rows of one id are in one fixed order, whatever the partitions; the last is followed by the first."""
    rows = [(1, f"text {i} of the same id\n") for i in range(40)] + [(None, "a null id")]
    a, b = ([tuple(r) for r in fp.fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(p)).collect()] for p in (1, 5))
    assert sorted(map(str, a)) == sorted(map(str, b)) and len(a) == 41
    texts = [t for _, t in rows]
    after = {hashlib.sha256((x[:len(x) - len(x) // 4] + y[:len(x) // 4]).encode()).hexdigest() for x in texts for y in texts}
    assert all(r[2] in after for r in a)


def test_one_document_and_none(spark):
    one = fp.fingerprint_documents(spark.createDataFrame([(1, "alone in the world")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1
    assert one[0]["edited_sha256"] == hashlib.sha256(b"alone in the walon").hexdigest()
    assert fp.fingerprint_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []
