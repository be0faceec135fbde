"""Turning texts into unit vectors.

Built-in encoder: signed feature hashing of lower-cased tokens, one small
Arrow-batched helper per batch (cut the joined bytes into tokens, md5 each
distinct token once, ``np.bincount`` scatter).  No shuffle: each row's vector
is computed where the row lives.  ``token_codes``/``hashed_counts_catalyst``
state the same rule with native expressions (used in tests).
"""

from __future__ import annotations

import hashlib
from typing import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions.vectors import NORM_EPS
from lodestar.session import ship_package

# Fixed values of the hashed encoder.
HASH_DIM = 128
TOKEN_SPLIT = r"[ \t\n\r\f]+"


def token_codes(text_col, dim: int = HASH_DIM) -> Column:
    """Per token: ``bucket * 2 + parity`` where bucket = first 8 hex digits
    of md5(token) mod dim and parity = the 9th hex digit's low bit."""
    toks = F.filter(F.split(F.lower(text_col), TOKEN_SPLIT), lambda t: t != "")

    def code(t):
        h = F.md5(t)
        bucket = F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % dim
        parity = F.conv(F.substring(h, 9, 1), 16, 10).cast("int") % 2
        return (bucket * 2 + parity).cast("int")

    return F.transform(toks, code)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0C, 0x0D]] = True


def _tokens(texts: list[str]) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The text number and the token of every token of a batch, cut on the batch's joined bytes."""
    joined = pa.array(texts, pa.large_string())
    offsets = np.frombuffer(joined.buffers()[1], dtype=np.int64)
    raw = np.frombuffer(joined.buffers()[2] or b"", dtype=np.uint8)[:offsets[-1]]
    inside = ~_SPACE[raw]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    edges = offsets[1:-1][offsets[1:-1] < len(raw)]
    starts[edges] = inside[edges]  # a text's first byte starts a token, whatever the text before ends with
    start = np.flatnonzero(starts)
    kept = np.cumsum(inside, dtype=np.int64)
    at = np.append(kept[start] - 1, kept[-1] if len(kept) else 0)
    tokens = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(at), pa.py_buffer(raw[inside])])
    return np.searchsorted(offsets, start, side="right") - 1, tokens.dictionary_encode()


def _hash_batch(texts: list, dim: int, normalise: bool) -> np.ndarray:
    """Signed hashed counts of a batch of texts.  Each distinct token of the
    batch is hashed once (token frequencies are heavily skewed), then one
    ``bincount`` scatters the whole batch."""
    row, tokens = _tokens([t.lower() if t is not None else "" for t in texts])
    digest = b"".join(hashlib.md5(t).digest()[:5] for t in tokens.dictionary.to_pylist())
    code = np.frombuffer(digest, dtype=np.uint8).reshape(-1, 5).astype(np.int64)
    bucket = (code[:, 0] << 24 | code[:, 1] << 16 | code[:, 2] << 8 | code[:, 3]) % dim
    sign = 1.0 - 2.0 * (code[:, 4] >> 4 & 1)
    which = tokens.indices.to_numpy()
    dense = np.bincount(row * dim + bucket[which], weights=sign[which], minlength=len(texts) * dim).astype(np.float64).reshape(len(texts), dim)
    if normalise:
        norm = np.sqrt((dense * dense).sum(axis=1, keepdims=True))
        dense = np.where(norm > NORM_EPS, dense / np.where(norm > NORM_EPS, norm, 1.0), dense)
    return dense


#: Bytes of texts that are hashed together; a longer text is hashed alone.
BATCH_BYTES = 512 << 10


def _encoder_udf(dim: int, normalise: bool):
    ship_package()

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def hashed(texts: pa.Array) -> pa.Array:
        flat, at = np.zeros((len(texts), dim)), 0
        size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        while at < len(texts):  # only a slice's texts are strings of Python at a time
            to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + BATCH_BYTES, side="right")))
            flat[at:to] = _hash_batch(texts.slice(at, to - at).to_pylist(), dim, normalise)
            at = to
        return pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * dim, pa.int32()), pa.array(flat.ravel()))
    return hashed


def hashed_counts(text_col, dim: int = HASH_DIM) -> Column:
    """Signed token counts per bucket (exact small integers, as doubles)."""
    return _encoder_udf(dim, False)(text_col)


def hashed_counts_catalyst(text_col, dim: int = HASH_DIM) -> Column:
    """Same as ``hashed_counts`` with higher-order functions only (O(T*D);
    the readable statement used to test the numpy helper)."""
    codes = token_codes(text_col, dim)
    return F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.aggregate(
        codes, F.lit(0.0).cast("double"),
        lambda a, c: a + F.when((c / 2).cast("int") == i, F.lit(1.0) - 2.0 * (c % 2)).otherwise(0.0)))


def hashed_vector(text_col, dim: int = HASH_DIM) -> Column:
    """C1 + C2: unit-length hashed vector ``ARRAY<DOUBLE>``.

    Counts are integers and the norm is one correctly rounded sqrt, so the
    result is bit-identical whatever the summation order."""
    return _encoder_udf(dim, True)(text_col)


Encoder = Callable[[Column], Column]


def encode(df: DataFrame, text_col: str = "text", out_col: str = "embedding",
           encoder: Encoder | None = None) -> DataFrame:
    """Add a unit vector column computed from ``text_col``.

    ``encoder`` is pluggable: any ``Column -> Column`` (e.g. an iterator
    pandas UDF that loads a model once per task) producing ARRAY<DOUBLE>.
    """
    enc = encoder or hashed_vector
    return df.withColumn(out_col, enc(F.col(text_col)))


def encode_incremental(corpus: DataFrame, done: DataFrame, key: str = "doc_id",
                       text_col: str = "text", encoder: Encoder | None = None) -> DataFrame:
    """C4: encode only rows whose key is not in ``done`` (keyed anti join)."""
    todo = corpus.join(done.select(key).distinct(), key, "left_anti")
    return encode(todo, text_col, encoder=encoder)


def encode_queries(queries: DataFrame, text_col: str = "query",
                   encoder: Encoder | None = None) -> DataFrame:
    """Encode each distinct query text once."""
    distinct = queries.select(text_col).distinct()
    return encode(distinct, text_col, encoder=encoder)
