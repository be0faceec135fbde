"""Words and rolling word hashes of whole texts, vectorised per batch.

A word is a maximal run of characters other than U+0020 and U+0009-U+000D.
All of these are single bytes in UTF-8, so a batch of texts is cut into
words on its joined bytes, without a loop over texts or words.

Hashes are 64-bit.  A word's hash is a polynomial over per-byte random
values; a window's hash is a polynomial over finished word hashes.  Both are
finished with a bijective mixer, so they depend on the content only and are
equal in every process.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**64, 256, dtype=np.uint64, endpoint=False)
_RADIX = _U(0x9E3779B97F4A7C15)
_RADIX_INV = _U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
#: Joined bytes handled at a time (working arrays then stay in cache); a longer text makes a batch of its own.
CHUNK_BYTES = 256 << 10


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finisher (xor-shift and multiply, three rounds)."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(29))
    x = x * _U(0xA0761D6478BD642F)
    return x ^ (x >> _U(32))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64 (the usual length is kept)."""
    kept = _POWERS.get(int(base))
    if kept is not None and len(kept) >= n:
        return kept[:n]
    out = np.full(max(n, CHUNK_BYTES), base, dtype=np.uint64)
    out[0] = 1
    np.cumprod(out, out=out)
    if n <= CHUNK_BYTES:
        _POWERS[int(base)] = out
    return out[:n]


class Words:
    """The words of a batch of texts.

    ``start``/``end`` are byte offsets into ``data``; words of text ``i`` are
    ``first[i]:first[i + 1]``.
    """

    __slots__ = ("data", "start", "end", "first", "base")

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, base: np.ndarray):
        self.data, self.start, self.end, self.first, self.base = data, start, end, first, base

    def __len__(self) -> int:
        return len(self.first) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool = False, salt: int = 0) -> np.ndarray:
        """64-bit hash of every word."""
        n = len(self.data)
        if n == 0 or len(self.start) == 0:
            return np.zeros(len(self.start), dtype=np.uint64)
        data = _LOWER[self.data] if lower else self.data
        table = _BYTE if not salt else mix64(_BYTE + _U(salt) * _RADIX) | _U(1)
        acc = table[data]
        acc *= _powers(_RADIX, n)
        np.cumsum(acc, out=acc)
        # the word is acc[start:end]; dividing by radix**start makes it position-free
        before = np.where(self.start > 0, acc[self.start - 1], _U(0))
        h = acc[self.end - 1] - before
        h *= _powers(_RADIX_INV, n)[self.start]
        h += (self.end - self.start).astype(np.uint64) * _U(0xC2B2AE3D27D4EB4F)
        return mix64(h)

    def text(self, i: int, word_from: int = 0, word_to: int | None = None) -> bytes:
        """Words ``word_from:word_to`` of text ``i`` joined by one space."""
        a, b = self.first[i], self.first[i + 1]
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.start[a:b][word_from:word_to], self.end[a:b][word_from:word_to]))


def split_words(texts: pa.Array) -> Words:
    """Words of an Arrow string array (null: no words)."""
    texts = pc.fill_null(texts.cast(pa.large_string()) if texts.type != pa.large_string() else texts, "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    lo, hi = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    raw = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[lo:hi] if hi > lo else np.zeros(0, np.uint8)
    offsets = offsets - lo if len(offsets) else np.zeros(1, np.int64)
    word = ~_SPACE[raw]
    starts_here = word.copy()
    starts_here[1:] &= ~word[:-1]
    ends_here = word.copy()
    ends_here[:-1] &= ~word[1:]
    # a text boundary also ends a word
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(raw))]
    starts_here[inner] = word[inner]
    ends_here[inner - 1] = word[inner - 1]
    start = np.flatnonzero(starts_here)
    end = np.flatnonzero(ends_here) + 1
    first = np.searchsorted(start, offsets)
    return Words(raw, start, end, first, offsets)


def window_hashes(h: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes of ``h``."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    if k <= 8:
        acc = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            acc *= _RADIX
            acc += mix64(h[j:j + n] + _U(salt + j))
        return mix64(acc)
    w = mix64(h + _U(salt)) if salt else h
    acc = np.concatenate([[_U(0)], np.cumsum(w * _powers(_RADIX, len(w)), dtype=np.uint64)])
    out = acc[k:] - acc[:-k]
    out *= _powers(_RADIX_INV, len(w))[:n]
    return mix64(out)


def slices(texts: pa.Array, limit: int = CHUNK_BYTES):
    """(offset, length) runs of rows whose texts join to about ``limit`` bytes."""
    if not len(texts):
        return
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    run = np.cumsum(size)
    at = 0
    while at < len(size):
        done = run[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(run, done + limit, side="right")))
        yield at, to - at
        at = to
