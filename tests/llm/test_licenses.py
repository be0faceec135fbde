import random

from llm_helpers import prose

from lodestar.llm.licenses import _TEMPLATES, TEMPLATES, align, exact, increasing, scan, scan_documents, words_of


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_increasing_is_longest():
    r = random.Random(1)
    for _ in range(200):
        v = [r.randrange(12) for _ in range(r.randrange(12))]
        got = increasing(v)
        best = [0] * len(v)
        for i in range(len(v)):
            best[i] = 1 + max((best[j] for j in range(i) if v[j] < v[i]), default=0)
        assert len(got) == max(best, default=0) and all(v[x] < v[y] and x < y for x, y in zip(got, got[1:]))


def test_alignment_is_common_and_long():
    r = random.Random(2)
    for i in range(100):
        b = prose(i, 60, 80)
        a = [w for w in b if r.random() > 0.1]
        for _ in range(5):
            a.insert(r.randrange(len(a)), "new")
        got = align(a, b)
        assert all(a[i] == b[j] for i, j in got) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))
        assert len(got) >= 0.9 * lcs(a, b)


def test_notices_and_texts():
    noise = " ".join(prose(3, 500))
    for name, text in TEMPLATES.items():
        assert name in [r[2] for r in scan(f"{noise} {text}. {noise}")], name
        assert scan(text)[0][0] == 1.0
    twice = f"Released under the MIT License. {noise} Released under the MIT License!"
    assert [r[2] for r in scan(twice)] == ["MIT-notice"] and scan(noise) == [] and scan(None) == [] and scan("") == []
    words = TEMPLATES["MIT"].split()
    changed = " ".join("changed" if i % 12 == 5 else w for i, w in enumerate(words))
    assert scan(noise + " " + changed)[0][2] == "MIT" and scan(" ".join(words[: len(words) // 2])) == []


def test_adjacent_copies():
    """Copies close together, between prose with the template's frequent words, are found at one of their places."""
    assert scan("the code is released under the MIT license and released under the MIT license as the file says")[0][:4] == (1.0, 5, "MIT-notice", 3)
    for name, text in TEMPLATES.items():
        words = words_of(text)
        stops = ["the", "code", "of", "the", "program", "and", "to", "any", "use", "in", "this", "is", "license", "under"]
        changed = ["changed" if i % 12 == 5 else w for i, w in enumerate(words)]
        for copy in (words, changed) if len(words) > 12 else (words,):
            for copies in (2, 3, 5):
                for gap in ([], ["the", "and", "of"], stops):
                    text = stops + (copy + gap) * copies + stops
                    found = [r for r in scan(" ".join(text)) if r[2] == name]
                    assert found and found[0][1] >= sum(a == b for a, b in zip(copy, words)), (name, copies, gap)
                    assert found[0][4] - found[0][3] < 2 * len(words)


def test_bit_vectors_equal_the_table():
    r = random.Random(4)
    for t in _TEMPLATES:
        for _ in range(20):
            a = [r.choice([*t.words, "other"]) for _ in range(r.randrange(2 * len(t.words)))]
            got = exact(a, t.words)
            assert t.common(a) == len(got) == lcs(a, t.words)
            assert all(a[i] == t.words[j] for i, j in got) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))


def test_whole_table(make_docs):
    rows = [(1, "Licensed under CC BY-NC 4.0."), (2, None), (3, ""), (None, "Released under the MIT License"), (4, " ".join(prose(1, 40_000))), (1, "nothing here")]
    got = sorted(((r["doc_id"], r["license"], r["coverage"]) for r in scan_documents(make_docs(rows, clash=True)).collect()), key=str)
    assert got == sorted([(1, "CC-BY-NC-4.0-notice", 1.0), (2, None, 0.0), (3, None, 0.0), (None, "MIT-notice", 1.0), (4, None, 0.0), (1, None, 0.0)], key=str)
    assert scan_documents(make_docs([])).collect() == []
