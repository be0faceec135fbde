import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestar.llm.packing import pack, pack_documents

P = pytest.importorskip("public_tokenizers")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=60), st.sampled_from([8, 64, 128]))
def test_pieces_cover_every_token_once(lengths, capacity):
    pieces = pack(np.array(lengths, dtype=np.int64), capacity)
    for d, n in enumerate(lengths):
        at = 0
        for _, start, length, _, _ in sorted(p for p in pieces if p[0] == d):
            assert start == at and length > 0
            at += length
        assert at == n
    sequences = {}
    for _, _, length, q, offset in pieces:
        sequences.setdefault(q, []).append((offset, length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == capacity or at & (at - 1) == 0


def test_costs_are_balanced():
    r = np.random.default_rng(1)
    lengths = r.integers(10, 900, 2000)
    cost = {}
    for d, _, length, q, _ in pack(lengths, 2048):
        cost[q] = cost.get(q, 0) + length + length * length / 1024
    full = sorted(cost.values())[30:]
    assert max(full) < 1.35 * np.mean(full)


def test_documents_against_the_tokenizer(make_docs, edge_rows):
    from tokenizers import Tokenizer

    from lodestar.llm.queries import tokenizer
    rows = edge_rows + [(70, "a<|endoftext|>b"), (71, "tail \n\n  spaces   "), (72, "😀 ünï <b>")]
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = pack_documents(make_docs(rows, clash=True), tokenizer()).collect()
    want = sorted(((r[0], tuple(tok.encode(r[1] or "", add_special_tokens=False).ids) + (1,)) for r in rows), key=str)
    by_doc = {}
    for i, ids in want:
        by_doc.setdefault(i, set()).add(ids)
    assert sum(r["length"] for r in got) == sum(len(ids) for _, ids in want)
    for r in got:
        assert any(len(ids) == r["doc_tokens"] and zlib.crc32(np.array(ids[r["start"]:r["start"] + r["length"]], dtype="<u4").tobytes()) == r["ids_crc32"]
                   for ids in by_doc[r["doc_id"]])
    used = {}
    for r in got:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in used.values():
        total = sum(n for _, n in own)
        assert total <= 2048 and (total == 2048 or total & (total - 1) == 0)
        assert [o for o, _ in sorted(own)] == list(np.cumsum([0] + [n for _, n in sorted(own)][:-1]))


def test_empty_table(make_docs):
    from lodestar.llm.queries import tokenizer
    assert pack_documents(make_docs([]), tokenizer()).collect() == []
