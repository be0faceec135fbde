"""Cost-balanced packing of token sequences.

A document costs ``linear * n + quadratic * n * n`` for its ``n`` tokens
(attention stays within a document).  Documents are packed in windows of
bounded size as a task streams through its rows:

1. Full-length pieces of long documents are sequences of their own.
2. The rest goes, longest first, whole to the sequence of lowest cost that
   still has room for it.  A window has as many full sequences as its tokens
   fill.
3. What finds no room whole is cut to fill the sequences up, and the tokens
   beyond the last full sequence become sequences whose lengths are powers of
   two, which are not padded.  So nothing is padded.

No shuffle: a window is a run of one task's rows, its tokens are never moved,
and a lost task gives the same rows again.  Sequence ids hold the task's
partition in the upper and a counter in the lower 32 bits.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tokens of a window, about; bounds a task's memory.
WINDOW_TOKENS = 1 << 21
#: Attention cost of a document of n tokens: n + n * n / QUADRATIC.
QUADRATIC = 1024.0


def cost(n, quadratic: float = QUADRATIC):
    return n + n * n / quadratic


def pack(lengths: np.ndarray, capacity: int, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of documents with ``lengths`` tokens."""
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    rest = []  # (length, document, start)
    for d, n in enumerate(lengths.tolist()):
        whole = n // capacity
        for i in range(whole):
            pieces.append((d, i * capacity, capacity, sequence, 0))
            sequence += 1
        if n % capacity:
            rest.append((n % capacity, d, whole * capacity))
    rest.sort(key=lambda r: (-r[0], r[1]))
    k = sum(r[0] for r in rest) // capacity
    room, costs = np.full(k, capacity, dtype=np.int64), np.zeros(k)
    left = []
    for n, d, start in rest:
        best = int(np.where(room >= n, costs, np.inf).argmin()) if k else 0
        if k and room[best] >= n:
            pieces.append((d, start, n, sequence + best, int(capacity - room[best])))
            room[best] -= n
            costs[best] += cost(n, quadratic)
        else:
            left.append((n, d, start))
    # what found no room whole fills the cheapest open sequences up
    open_ = [(costs[i], i) for i in np.flatnonzero(room).tolist()]
    heapq.heapify(open_)
    tail = []
    for n, d, start in left:
        while n and open_:
            c, i = open_[0]
            m = min(n, int(room[i]))
            pieces.append((d, start, m, sequence + i, int(capacity - room[i])))
            room[i] -= m
            n, start = n - m, start + m
            if room[i]:
                heapq.heapreplace(open_, (c + cost(m, quadratic), i))
            else:
                heapq.heappop(open_)
        if n:
            tail.append((n, d, start))
    sequence += k
    size, at = 0, 0  # powers of two, largest first
    total = sum(t[0] for t in tail)
    for n, d, start in tail:
        while n:
            if at == size:
                size, at = 1 << (total.bit_length() - 1), 0
                sequence += 1
            m = min(n, size - at)
            pieces.append((d, start, m, sequence - 1, at))
            n, start, at, total = n - m, start + m, at + m, total - m
    return pieces


def _emit(window: list[tuple], capacity: int, quadratic: float, base: int) -> tuple[pa.RecordBatch, int]:
    lengths = np.array([len(ids) for _, ids in window], dtype=np.int64)
    pieces = pack(lengths, capacity, quadratic)
    crc = [zlib.crc32(window[d][1][s:s + n].tobytes()) for d, s, n, _, _ in pieces]
    d, s, n, q, o = (np.array(c, dtype=np.int64) for c in zip(*pieces)) if pieces else (np.zeros(0, np.int64),) * 5
    out = pa.record_batch({
        "doc_id": pa.array([window[i][0] for i in d.tolist()], pa.int64()), "start": pa.array(s), "length": pa.array(n),
        "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": pa.array(lengths[d] if len(d) else d),
        "sequence_id": pa.array(q + base), "offset": pa.array(o)})
    return out, int(q.max()) + 1 if len(q) else 0


def _packer(encoder, capacity: int, window_tokens: int, quadratic: float):
    def run(batches):
        from pyspark import TaskContext
        encode = encoder()
        base = TaskContext.get().partitionId() << 32
        window, tokens = [], 0
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            for i in range(b.num_rows):
                own = encode(texts[i].as_py() or "")
                window.append((ids[i].as_py(), own))
                tokens += len(own)
                if tokens >= window_tokens:
                    out, used = _emit(window, capacity, quadratic, base)
                    yield out
                    base += used
                    window, tokens = [], 0
        if window:
            yield _emit(window, capacity, quadratic, base)[0]
    return run


def byte_bpe(tokenizer_json: str, ranks_file: str, pattern: str, end_id: int = 1):
    """A function that makes the encoder of one task: ids of a text, then ``end_id``, as little-endian uint32.

    ``ranks_file`` holds the same vocabulary as ``tokenizer_json`` as byte
    ranks; its encoder gives the same ids several times faster.  Texts that
    hold a special token's string are left to the tokenizer itself, as only
    that one knows it.
    """
    def make():
        import base64
        import json
        import os

        import tiktoken
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(r) for a, r in (line.split() for line in f.read().splitlines() if line)}
        fast = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        with open(tokenizer_json, encoding="utf-8") as f:
            special = [t["content"] for t in json.load(f).get("added_tokens", [])]
        whole: list = []

        def encode(text: str) -> np.ndarray:
            if any(s in text for s in special):
                if not whole:
                    whole.append(Tokenizer.from_file(tokenizer_json))
                ids = whole[0].encode(text, add_special_tokens=False).ids
                return np.array(ids + [end_id], dtype="<u4")
            return np.append(fast.encode_to_numpy(text, disallowed_special=()), np.uint32(end_id)).astype("<u4", copy=False)
        return encode
    return make


def pack_documents(docs: DataFrame, encoder, capacity: int = 2048, window_tokens: int = WINDOW_TOKENS,
                   quadratic: float = QUADRATIC) -> DataFrame:
    """Pieces ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` of all documents.

    ``encoder`` makes a task's function from a text to its ids (an end id
    included, so every row has a piece).  Null texts are empty texts; null
    and repeated ids are kept as they are, each row packed for itself.  A
    sequence is full (``capacity``) or its length is a power of two.  Only
    ``doc_id`` and ``text`` are read, so other columns may have any name.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(_packer(encoder, capacity, window_tokens, quadratic),
                            "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
