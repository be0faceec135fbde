import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import functions as F

from lodestar.llm import divergence as dv

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, min_docs=30, top=50):
    """Every count of every kept term in every group, by the contract's words."""
    docs = [(lang or "", source or "", [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = sorted(t for t in df if df[t] >= min_docs)
        groups = defaultdict(Counter)
        for _, source, terms in mine:
            groups[source].update(t for t in terms if t in set(kept))
        groups = dict(groups)

        def share(counts):
            n = sum(counts.values())
            return {t: 1 + 10**9 * (counts[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p, q = {s: share(c) for s, c in groups.items()}, share(sum(groups.values(), Counter()))
        for s in groups:
            found = [("pair", o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in groups if o != s]
            found += [("term", t, p[s][t] - q[t]) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part in ("pair", "term"):
                ranked = sorted((x for x in found if x[0] == part), key=lambda x: (-x[2], x[1].encode()))
                out += [(lang, s, *x, i + 1) for i, x in enumerate(ranked) if part == "pair" or i < top]
    return sorted(out)


def corpus(n=900):
    r = random.Random(3)
    rows = []
    for i in range(n):
        lang, source = r.choice(["en", "en", "en", "de", None]), r.choice(["hot"] * 5 + ["s1", "S2", "é", None, ""])
        words = [f"Word{chr(97 + min(25, int(r.expovariate(0.15))))}{'x' * r.randrange(3)}" for _ in range(r.randrange(60))]
        rows.append((i, r.choice([" ", "\n", "1", "--"]).join(words + r.choice([["ÉTÉ", "été"], ["漢字", " "], []])), lang, source))
    rows += [(1, rows[1][1], "en", "hot")] * 40 + [(None, None, "en", None), (5, "", "fr", "only"), (6, "few words", "fr", "two"), (7, None, None, "no term")]
    return rows


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_equals_plain_counts(make_docs):
    """Several blocks of terms (of 40), several bands of sources (33 and more), nulls, repeated rows, clashing names."""
    rows = corpus()
    assert got(dv.divergence(make_docs(rows, clash=True), block=40)) == plain(rows)
    assert got(dv.divergence(make_docs(rows, partitions=1), min_docs=300, top=3)) == plain(rows, 300, 3)


def test_many_sources(make_docs):
    r = random.Random(1)
    rows = [(i, " ".join(r.choice("abcdefghij") * 3 for _ in range(12)), "xx", f"host{i % 71}") for i in range(600)]
    assert got(dv.divergence(make_docs(rows), min_docs=2, block=3)) == plain(rows, 2)


def test_no_rows_and_one_long_text(make_docs):
    assert got(dv.divergence(make_docs([]))) == []
    rows = [(1, "Long word " * 200_000, "en", "a"), (2, "word", "en", "b")]
    assert got(dv.divergence(make_docs(rows), min_docs=1)) == plain(rows, 1)


def test_shares_are_exact_beyond_64_bits(spark):
    wanted = [(0, 0, 1), (10**15, 3 * 10**17, 10**9), (2**40, 2**41 + 7, 12345), (7, 9 * 10**18, 3)]
    df = spark.createDataFrame(wanted, "n long, total long, terms long").select(dv.share(F.col("n"), F.col("total"), F.col("terms")).alias("p"))
    assert sorted(r["p"] for r in df.collect()) == sorted(1 + 10**9 * (n + 5) // (t + 5 * v) for n, t, v in wanted)


def test_cells_of_one_block():
    """Bitsets of 70 terms in two words: joint cells with zeros by complement equal the plain sum."""
    r = random.Random(4)
    counts = {g: [r.choice([0, 0, 1, 2, 5]) for _ in range(70)] for g in range(5)}
    share = {g: {n: 1000 * (g + 1) * (n + 1) // 7 for n in (0, 1, 2, 5)} for g in counts}
    rows = [(g, share[g][0], -1, 0, 70) for g in counts]
    for g, mine in counts.items():
        for word in range(2):
            for n in {1, 2, 5}:
                bits = sum(1 << i for i in range(64) if word * 64 + i < 70 and mine[word * 64 + i] == n)
                if bits:
                    rows.append((g, share[g][n], word, bits - 2**64 if bits >= 2**63 else bits, 70))
    r.shuffle(rows)
    cols = list(zip(*rows))
    table = pa.table({"number": pa.array(cols[0], pa.int32()), "p": pa.array(cols[1], pa.int64()), "place": pa.array(cols[2], pa.int32()),
                      "bits": pa.array(cols[3], pa.int64()), "size": pa.array(cols[4], pa.int32())})
    out = dv._joint_values([pa.scalar(x) for x in ("en", 0, 0, 0)], table).to_pylist()
    want = {(a, b): sum(abs(share[a][x] - share[b][y]) for x, y in zip(counts[a], counts[b])) for a in counts for b in counts if a < b}
    assert {(o["a"], o["b"]): o["value"] for o in out} == want
