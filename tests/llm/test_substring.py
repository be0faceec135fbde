import hashlib
import itertools
import re

from llm_helpers import prose

from lodestar.llm import substring
from lodestar.llm.substring import COVERS, drop_repeats


def expected(rows, width):
    split = [(r[0], re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    first = {}
    for i, words in split:
        for s in range(len(words) - width + 1):
            w = tuple(words[s:s + width])
            if i is not None:
                first[w] = min(i, first.get(w, i))
    out = []
    for i, words in split:
        gone = set()
        for s in range(len(words) - width + 1):
            if i is not None and first[tuple(words[s:s + width])] < i:
                gone |= set(range(s, s + width))
        kept = [w for j, w in enumerate(words) if j not in gone]
        out.append((i, len(words), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def test_covers_are_covers():
    for v, d in COVERS.items():
        assert {(a - b) % v for a, b in itertools.product(d, d)} == set(range(v))


def test_edge_cases_match_brute_force(make_docs, edge_rows):
    assert result(drop_repeats(make_docs(edge_rows, clash=True))) == expected(edge_rows, 50)


def test_every_alignment_and_length(make_docs):
    passage = prose(21, 120)
    rows = [(i, " ".join(prose(300 + i, i % 37) + passage[i % 5:i % 5 + n] + prose(900 + i, i % 11)))
            for i, n in enumerate([*range(45, 60), 49, 50, 51, 80, 110] * 4)]
    assert result(drop_repeats(make_docs(rows))) == expected(rows, 50)
    assert result(drop_repeats(make_docs(rows), width=9)) == expected(rows, 9)


def test_overlapping_owners(make_docs):
    """A passage whose halves come from different documents, and one that repeats within its document."""
    a, b = prose(31, 90), prose(32, 90)
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(a[30:] + b[:60])), (4, " ".join(a[:55] * 2)), (4, " ".join(b[:55])), (0, " ".join(b[20:75]))]
    assert result(drop_repeats(make_docs(rows))) == expected(rows, 50)


def test_repeated_rows_share_their_places(make_docs, monkeypatch):
    """Many equal rows of one id: the list of anchors is one row's."""
    a = prose(51, 80)
    text = " ".join(prose(52, 30) + a)
    rows = [(1, " ".join(a))] + [(2, text)] * 40
    seen = {}
    written = substring.written

    def spy(df, name):
        seen[name] = written(df, name)
        return seen[name]
    monkeypatch.setattr(substring, "written", spy)
    assert result(drop_repeats(make_docs(rows))) == expected(rows, 50)
    found = [r["anchors"] for r in seen["substring-found"].collect()]
    assert len(found) == 2 and all(len(p) == len(set(p)) for p in found)


def test_text_keeps_its_white_space(make_docs):
    a = prose(41, 60)
    rows = [(1, " ".join(a)), (2, "start\nhere  " + " ".join(a) + "\n the\tend "), (3, "plain \n text"), (4, None), (None, " x ")]
    got = {r["doc_id"]: r["kept_text"] for r in drop_repeats(make_docs(rows), with_text=True, carry=("lang",)).collect()}
    assert got == {1: " ".join(a), 2: "start\nhere\n the\tend ", 3: "plain \n text", 4: None, None: " x "}


def test_empty_table(make_docs):
    assert drop_repeats(make_docs([])).collect() == []
