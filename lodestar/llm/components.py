"""Connected components by alternating star contractions.

Each round points every vertex's neighbours at the smallest vertex around it
(once over larger, once over smaller neighbours), as a grouped minimum and a
join back; a round's edges are cut from their lineage by ``checkpoint()``.
No neighbour list is ever gathered, so a vertex may hold any share of the
edges, and nothing but one checksum a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _larger(edges: DataFrame) -> DataFrame:
    """Both directions of ``(u, v)``: every ``v`` larger than ``u`` is pointed at the smallest vertex around ``u``."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _smaller(edges: DataFrame) -> DataFrame:
    """``v < u`` throughout: ``u`` and its neighbours are pointed at the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def connected_components(edges: DataFrame, a: str = "u", b: str = "v") -> DataFrame:
    """``(vertex, component)`` for every vertex of an edge; the component is its smallest vertex.

    Rows with a null end and self loops are left out; repeated and reversed
    edges count once.  No edges: no rows.
    """
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .filter(F.col(a).isNotNull() & F.col(b).isNotNull()).filter("u <> v").distinct().checkpoint())
    seen = _checksum(e)
    while seen[0]:
        e = _smaller(_larger(e)).checkpoint()
        now = _checksum(e)
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("v").alias("vertex")).distinct()
    return (e.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
            .unionByName(roots.select("vertex", F.col("vertex").alias("component"))))
