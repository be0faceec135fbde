"""Upper bounds of dot products, for the block joins of search and cache.

A block's rows are ordered so that runs of ``LEAF`` rows (leaves) lie near
each other.  Rows are projected on the leading axes of a block of requests;
with the length of what is left as one more coordinate, the dot product of two
projections is at least that of the rows (Cauchy-Schwarz).  So a request out of
reach of the box around a leaf meets none of its rows, and products of short
projections leave few pairs to look at.  All is single precision with a margin
for its rounding; what is within the margin is decided in double precision by
the caller.  Bounds never change a result, whatever the vectors are.
"""

from __future__ import annotations

import numpy as np

#: Rows of a leaf, and axes of the boxes around them.
LEAF, BOX_AXES = 256, 6
#: Share of the requests' squared length that short projections keep.
KEPT = 0.85
#: Vectors up to this length are bounded.
LONGEST = 1e6


def margin(dim: int) -> float:
    """More than rounding to single precision moves a dot product of two unit vectors."""
    return (dim + 16) * 2.0 ** -23


def wide_margin(dim: int) -> float:
    """The same for projections made in single precision, whose coordinates are sums of ``dim`` products."""
    return margin(dim) * max(1.0, dim ** 0.5)


def single(x: np.ndarray) -> np.ndarray:
    """``x`` in single precision; rows that are not finite become zero."""
    with np.errstate(over="ignore"):
        small = x.astype(np.float32)
    odd = ~np.isfinite(small).all(axis=1)
    if odd.any():
        small[odd] = 0
    return small


def axes(small: np.ndarray, kept: float = KEPT) -> np.ndarray:
    """Orthonormal columns, the leading axes first, that keep a share of the rows' squared length (``BOX_AXES`` at least)."""
    w, v = np.linalg.eigh(small.T.astype(np.float64) @ small)
    share = np.cumsum(w[::-1]) / max(w.sum(), 1e-300)
    return np.ascontiguousarray(v[:, ::-1][:, :max(BOX_AXES, int(np.searchsorted(share, kept)) + 1)], dtype=np.float32)


def projected(small: np.ndarray, on: np.ndarray) -> np.ndarray:
    """Coordinates on the axes, and an upper bound of the length of what is left."""
    u = small @ on
    square = np.einsum("ij,ij->i", small, small)
    left = np.maximum(square - np.einsum("ij,ij->i", u, u), 0) + wide_margin(small.shape[1]) * square
    return np.concatenate([u, np.sqrt(left)[:, None]], axis=1)


def _boxed(u: np.ndarray) -> np.ndarray:
    """Projections on the first axes only."""
    n = min(BOX_AXES, u.shape[1] - 1)
    rest = u[:, n:]
    return np.concatenate([u[:, :n], np.sqrt(np.einsum("ij,ij->i", rest, rest))[:, None]], axis=1)


def leaf_order(x: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """An order of the rows in which runs of ``leaf`` rows are near each other: halves along the widest axis."""
    if len(x) <= leaf:
        return np.arange(len(x))
    small = single(x)
    b, out = _boxed(projected(small, axes(small))), []

    def cut(idx):
        if len(idx) <= leaf:
            out.append(idx)
            return
        half = max(1, len(idx) // leaf // 2) * leaf
        by = np.argpartition(b[idx, b[idx].var(axis=0).argmax()], half)
        cut(idx[by[:half]])
        cut(idx[by[half:]])
    cut(np.arange(len(x)))
    return np.concatenate(out)


class Leaves:
    """Boxes around the leaves of a block of entries given by their projections ``u``."""

    def __init__(self, u: np.ndarray, leaf: int = LEAF):
        self.starts = np.arange(0, len(u), leaf)
        self.slices = [slice(a, min(a + leaf, len(u))) for a in self.starts.tolist()]
        b = _boxed(u)
        self.lo, self.hi = np.minimum.reduceat(b, self.starts), np.maximum.reduceat(b, self.starts)
        self.square = np.maximum.reduceat(np.einsum("ij,ij->i", b, b), self.starts)

    def bound(self, u: np.ndarray) -> np.ndarray:
        """(requests, leaves): an upper bound of the dot products of projected requests and the rows of a leaf, without margin."""
        b = _boxed(u)
        gap = np.zeros((len(b), len(self.starts)), dtype=np.float32)
        for c in range(b.shape[1]):
            g = np.maximum(self.lo[:, c] - b[:, c:c + 1], b[:, c:c + 1] - self.hi[:, c])
            np.maximum(g, 0, out=g)
            gap += g * g
        # u.v = (|u|^2 + |v|^2 - |u - v|^2) / 2
        return (np.einsum("ij,ij->i", b, b)[:, None] + self.square - gap) / 2
