import random
import zlib

import numpy as np
import pyarrow as pa

from lodestar.llm.langid import Batch, Model, fit, identify

SYLLABLES = {"aa": ["ba", "do", "ki", "lu", "men"], "bb": ["str", "ung", "sch", "keit", "ver"], "cc": ["жа", "ни", "ко", "ста"]}


def sentence(lang, seed, n):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(n))


def rows(n=240):
    return [(i, sentence(("aa", "bb", "cc")[i % 3], i, 5 + i % 40), ("aa", "bb", "cc")[i % 3]) for i in range(n)]


def test_held_out_accuracy_and_edges(make_docs):
    data = rows() + [(1000, None, "aa"), (1001, "", "aa"), (1002, "123 --- !!", "bb"), (None, sentence("aa", 5, 9), "aa"), (1003, sentence("bb", 9, 30_000), None),
                     (7, sentence("bb", 77, 8), "bb"), (1004, "漢字", None)]
    got = identify(make_docs([(*r, None) for r in data], clash=True)).collect()
    assert len(got) == len(data)
    for r in got:
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
    by = {r["doc_id"]: r for r in got if r["doc_id"] != 7}
    assert [by[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3
    held = [i for i in range(240) if i != 7 and by[i]["held_out"]]
    assert np.mean([by[i]["lang_pred"] == ("aa", "bb", "cc")[i % 3] for i in held]) > 0.97
    assert by[1003]["lang_pred"] == "bb" and by[None]["lang_pred"] == "aa" and by[1004]["lang_pred"] in ("aa", "bb", "cc")


def test_no_labels_and_empty_table(make_docs):
    assert {r["lang_pred"] for r in identify(make_docs([(1, "some text"), (2, None)])).collect()} == {"und"}
    assert identify(make_docs([])).collect() == []


def model(make_docs) -> Model:
    return fit(make_docs([(*r, None) for r in rows()]).select("doc_id", "text", "lang"))


def test_spans_of_mixed_text(make_docs):
    m = model(make_docs)
    text = " ".join([sentence("aa", 1, 30), sentence("bb", 2, 20), sentence("cc", 3, 10)])
    lang, _, label, of = m.predict(pa.array([text, sentence("bb", 4, 3), "x"]))
    own = [m.languages[j] for j in label[of == 0]]
    want = ["aa"] * 30 + ["bb"] * 20 + ["cc"] * 10
    assert np.mean([a == b for a, b in zip(own, want)]) > 0.93 and lang[0] == "aa" and lang[1] == "bb"


def test_viterbi_equals_brute_force(make_docs):
    """The walk over all texts in step gives each text's best path under the switching penalty."""
    from lodestar.llm.langid import SWITCH
    m = model(make_docs)
    texts = pa.array([" ".join(sentence(random.Random(i * 7 + j).choice("abc") * 2, i * 9 + j, 2) for j in range(i % 5 + 1)) for i in range(12)] + [None, "", "z"])
    batch = Batch(texts)
    e, label = m.emissions(batch), m.spans(batch)
    k = len(m.languages)
    for i in range(len(texts)):
        lo, hi = batch.words.first[i], batch.words.first[i + 1]
        if lo == hi:
            continue
        score = e[lo].copy()
        for t in range(lo + 1, hi):
            score = np.array([max(score[b] - (SWITCH if b != a else 0) for b in range(k)) for a in range(k)]) + e[t]
        own = sum(e[t, label[t]] for t in range(lo, hi)) - SWITCH * sum(label[t] != label[t + 1] for t in range(lo, hi - 1))
        assert abs(own - score.max()) < 1e-6


def test_every_letter_counts(make_docs):
    """Languages whose scripts have no number of their own are learned and told apart; und is for texts without a letter."""
    scripts = {"am": "ሀለሐመሠረ", "km": "កខគឃងច", "ta": "கஙசஞடண", "si": "කඛගඝඞඟ", "gom": "𐌰𐌱𐌲𐌳"}
    langs = sorted(scripts)
    data = []
    for i in range(300):
        r = random.Random(i)
        lang = langs[i % 5] if i % 6 else "aa"
        data.append((i, " ".join("".join(r.choice(scripts[lang]) for _ in range(4)) for _ in range(12)) if i % 6 else sentence("aa", i, 12), lang))
    more = [(900, "கஙச க் hello டண கஙச ஞடண டணக", None), (901, "١٢٣ 12 — ் ،", None), (902, "ﬁ", None), (903, "ｈｅｌｌｏ", None), (904, "ꯀꯁ", None), (905, "ﾊﾛｰ", None), (906, "ㄅㄆ", None)]
    got = {r["doc_id"]: r for r in identify(make_docs(data + more)).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in data)
    assert got[900]["lang_pred"] == "ta" and got[900]["score"] > 0.5
    assert (got[901]["lang_pred"], got[901]["score"]) == ("und", 0.0)
    assert all(got[i]["lang_pred"] != "und" and got[i]["score"] > 0 for i in (902, 903, 904, 905, 906))


def test_letters_are_those_of_unicode():
    import unicodedata
    text = "aé ß 漢 க் ក០ ሀ ߀ߊ ܐ ހ Ⴀ ᠠ Ａ ｱ 𐌰 𠀀 × 1 ٣ ، ̈"
    batch = Batch(pa.array([text]))
    assert batch.letters.tolist() == [sum(unicodedata.category(c)[0] == "L" for c in w) for w in text.lower().split()]


def test_partitions_that_lack_a_language(spark, make_docs):
    """Two languages over eight partitions that hold one of them each (adaptive coalescing off)."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        data = [(i, sentence("aa" if i < 20 else "bb", i, 12), "aa" if i < 20 else "bb", None) for i in range(40)]
        docs = make_docs(data, partitions=8).repartitionByRange(8, "doc_id")
        got = {r["doc_id"]: r["lang_pred"] for r in identify(docs).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(got[r[0]] == r[2] for r in data) >= 39


def test_blocks_of_a_long_text_give_a_best_path():
    """The path over blocks has the score of the plain walk's best path, for lengths around the blocks' edges."""
    from lodestar.llm.langid import BLOCK_WORDS, SWITCH
    r = np.random.default_rng(4)
    for n, k in ((1, 3), (BLOCK_WORDS, 2), (BLOCK_WORDS + 1, 4), (5 * BLOCK_WORDS - 1, 3), (2000, 5)):
        e = r.normal(size=(n, k)) * 6
        e += np.repeat(np.eye(k)[r.integers(0, k, n // 40 + 1)] * 5, 40, axis=0)[:n]
        best = e[0].copy()
        for t in range(1, n):
            best = np.maximum(best, best.max() - SWITCH) + e[t]
        label = Model([str(i) for i in range(k)], np.zeros((1, k)), np.ones((1, k), bool))._long_spans(e)
        own = e[np.arange(n), label].sum() - SWITCH * (label[1:] != label[:-1]).sum()
        assert abs(own - best.max()) < 1e-6


def test_long_texts_are_quick_and_equal_in_parts(make_docs):
    import time
    m = model(make_docs)
    words = sentence("aa", 1, 150_000).split() + sentence("bb", 2, 150_000).split()
    at = time.time()
    lang, score, label, _ = m.predict(pa.array([" ".join(words), sentence("bb", 4, 9), None]))
    assert time.time() - at < 10 and lang[1] == "bb" and 0.4 < score[0] < 0.6
    assert np.mean(label[:150_000] == 0) > 0.99 and np.mean(label[150_000:300_000] == 1) > 0.99


def test_scripts_that_were_not_learned_say_nothing(make_docs):
    m = model(make_docs)
    lang, score, _, _ = m.predict(pa.array(["தமிழ் மொழி இது", "漢字漢字", "漢字 " + sentence("bb", 3, 6)]))
    assert np.allclose(score[:2], 1 / 3) and lang[:2] == ["aa", "aa"] and lang[2] == "bb" and 0.8 < score[2] < 1
