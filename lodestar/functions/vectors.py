"""Array expressions over vectors and memberships.

These are the readable Catalyst forms.  The hot paths (top-k scans, fit
iterations) use numpy over Arrow batches and are tested against these.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
NORM_EPS = 1e-10          # vectors at or below this norm stay unchanged
DIST_FLOOR = 1e-10        # floor for squared distances
ENTROPY_EPS = 1e-10       # inside the log of the membership entropy
AMBIGUOUS_U = 0.3         # a cluster "counts" above this membership
AMBIGUOUS_MIN = 2         # ... and a row is ambiguous with at least this many


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def sq_norm(v) -> Column:
    return F.aggregate(_c(v), F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double") * x)


def l2_norm(v) -> Column:
    return F.sqrt(sq_norm(v))


def l2_normalize(v) -> Column:
    """Unit length; near-zero vectors are returned unchanged (as double)."""
    n = l2_norm(v)
    vd = F.transform(_c(v), lambda x: x.cast("double"))
    return F.when(n > NORM_EPS, F.transform(vd, lambda x: x / n)).otherwise(vd)


def dot(a, b) -> Column:
    """Dot product accumulated in double (cosine for unit vectors)."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y),
                       F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def sq_dist_raw(a, b) -> Column:
    """Squared Euclidean distance."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)),
                       F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def sq_dist(a, b) -> Column:
    """Squared Euclidean distance floored at 1e-10."""
    return F.greatest(sq_dist_raw(a, b), F.lit(DIST_FLOOR))


def memberships_from_dists(dists, m: float) -> Column:
    """u_c = d_c^(-1/(m-1)) / sum_j d_j^(-1/(m-1))."""
    e = 1.0 / (m - 1.0)
    inv = F.transform(_c(dists), lambda d: F.pow(F.lit(1.0) / d, F.lit(e)))
    s = F.aggregate(inv, F.lit(0.0).cast("double"), lambda a, x: a + x)
    return F.transform(inv, lambda x: x / s)


def argmax(u) -> Column:
    """Index of the largest entry, lowest index on ties (0-based)."""
    return (F.array_position(_c(u), F.array_max(_c(u))) - 1).cast("int")


def entropy(u) -> Column:
    """-sum u ln(u + 1e-10), natural log."""
    return -F.aggregate(_c(u), F.lit(0.0).cast("double"),
                        lambda a, x: a + x * F.log(x + F.lit(ENTROPY_EPS)))


def uniform_membership(k: int) -> Column:
    """1/K everywhere (used when no model is available)."""
    return F.array_repeat(F.lit(1.0 / k), k)


def ranked_clusters(u) -> Column:
    """Clusters by membership, descending; ties go to the higher index
    (the tail of an ascending sort)."""
    idx = F.transform(_c(u), lambda x, i: F.struct(x.alias("u"), i.alias("cluster")))
    return F.sort_array(idx, asc=False)


def top_memberships(u, n: int = 4, digits: int = 4) -> Column:
    """The n largest memberships as a map ``cluster_j -> round(u, 4)``."""
    top = F.slice(ranked_clusters(u), 1, n)
    return F.map_from_entries(F.transform(
        top, lambda s: F.struct(F.concat(F.lit("cluster_"), s["cluster"].cast("string")),
                                F.round(s["u"], digits))))


def is_ambiguous(u) -> Column:
    """At least two clusters with membership above 0.3."""
    return F.size(F.filter(_c(u), lambda x: x > AMBIGUOUS_U)) >= AMBIGUOUS_MIN


def probes_top(u, n: int = 3) -> Column:
    """H2: the n clusters with the largest membership (ties: higher index)."""
    return F.transform(F.slice(ranked_clusters(u), 1, n), lambda s: s["cluster"])


def probes_dominant_plus(u, secondary: float = 0.25, multi_cluster: bool = True) -> Column:
    """H1: the argmax cluster, plus every cluster with u >= secondary."""
    am = argmax(u)
    if not multi_cluster:
        return F.array(am)
    idx = F.transform(_c(u), lambda x, i: F.struct(x.alias("u"), i.alias("c")))
    return F.transform(F.filter(idx, lambda s: (s["u"] >= secondary) | (s["c"] == am)),
                       lambda s: s["c"])
