import numpy as np
from llm_helpers import prose

from lodestar.llm.mixing import mix, sainte_lague, taken_text


def waterfill(sizes, weights, share=1.5, cap=2):
    total, open_, target = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        level = total / sum(weights[i] for i in open_)
        over = {i for i in open_ if weights[i] * level >= cap * sizes[i]}
        if not over:
            for i in open_:
                target[i] = weights[i] * level
            break
        for i in over:
            target[i] = cap * sizes[i]
            total -= target[i]
        open_ -= over
    return target


def test_sainte_lague_is_the_highest_quotients():
    r = np.random.default_rng(3)
    for _ in range(200):
        n = int(r.integers(1, 12))
        votes = r.integers(0, 1000, n) * (r.random(n) < 0.8)
        caps = r.integers(0, 60, n)
        seats = int(r.integers(0, 150))
        got = sainte_lague(votes, seats, caps)
        want = np.zeros(n, dtype=int)
        while want.sum() < min(seats, caps[votes > 0].sum()):
            q = np.where((want < caps) & (votes > 0), votes / (2 * want + 1), -1)
            want[int(q.argmax())] += 1
        assert got.sum() == want.sum() and sorted(votes / (2 * got + 1)) == sorted(votes / (2 * want + 1)) or (got == want).all()


def rows():
    out = [(i, " ".join(prose(i, 20 + i * 13 % 300)), "en", ["a", "b", "c", "é", None, "B"][(i * i) % 6 if i % 3 else 0]) for i in range(400)]
    return out + [(900, None, None, "a"), (901, "", None, "zz"), (None, "x y z", None, "a"), (902, " \n", None, None), (5, "again with this id", None, "b")]


def test_targets_sizes_and_caps(make_docs):
    data = rows()
    got = mix(make_docs(data, clash=True), shard_words=5000).collect()
    assert len(got) == len(data)
    names = sorted({r[3] for r in data}, key=lambda s: (s is None, s or ""))
    sizes = [sum(len((r[1] or "").split()) for r in data if r[3] == s) for s in names]
    want = dict(zip(names, waterfill(sizes, [(3, 1, 2)[i % 3] for i in range(len(names))])))
    for s, n in zip(names, sizes):
        own = [r for r in got if r["source"] == s]
        assert all(r["source_size"] == n and abs(r["target"] - want[s]) < 1e-6 * max(1, want[s]) for r in own)
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - want[s]) <= max(1, 0.03 * want[s])


def test_reruns_and_partitions_agree(make_docs):
    a = mix(make_docs(rows(), partitions=1), shard_words=5000).collect()
    b = mix(make_docs(rows(), partitions=7), shard_words=5000).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_text_of_the_mix(make_docs):
    docs = make_docs(rows())
    taken = mix(docs, shard_words=5000)
    want = {}
    for r in taken.collect():
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["taken"]
    got = {}
    for r in taken_text(docs, taken).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(r["text"].split())
    assert got == {k: v for k, v in want.items() if v}


def test_equal_rows_and_empty_table(make_docs):
    docs = make_docs([(1, "a b c d", "x", "s")] * 5 + [(2, "e f", "x", "t")])
    taken = mix(docs)
    assert sum(len(r["text"].split()) for r in taken_text(docs, taken).collect()) == sum(r["taken"] for r in taken.collect())
    assert mix(make_docs([])).collect() == []
