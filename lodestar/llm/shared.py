"""Small helpers of several operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.session import scratch_path

#: Key rows that may be broadcast, some 50 bytes each; beyond it their joins shuffle.
MAX_BROADCAST_KEYS = 500_000


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends here, and lost executors take nothing with them."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def match(rows: DataFrame, keys: DataFrame, on: list[str], how: str) -> DataFrame:
    """``rows`` with (``left_semi``) or without (``left_anti``) the written ``keys``; null equals null.

    The keys are broadcast if their count allows it; then ``rows`` are not moved.
    """
    other = keys.select(*[F.col(c).alias(f"_{c}") for c in on])
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rows.join(F.broadcast(other) if keys.count() <= MAX_BROADCAST_KEYS else other, same, how)
