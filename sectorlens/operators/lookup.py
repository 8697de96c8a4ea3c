"""Joins against company-level lookups whose size is not known in advance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024


def measured_bytes(df: DataFrame) -> int:
    """Bytes ``df`` holds as text, plus a fixed cost per row; one aggregate job."""
    row_cost = F.lit(16)
    for name in df.columns:
        row_cost = row_cost + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) + 8
    return df.agg(F.coalesce(F.sum(row_cost.cast("long")), F.lit(0)).alias("bytes")).first()[0]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """True when ``df`` was measured and is small enough to copy to every executor."""
    return limit > 0 and measured_bytes(df) <= limit


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join a large table with a lookup that has one row per key.

    A lookup that measures small is broadcast and the large side is not moved.
    Beyond the limit the join shuffles, and adaptive execution splits the
    partitions of a hot key on the large side (inner and left joins allow it).
    """
    side = F.broadcast(lookup) if fits_broadcast(lookup, limit) else lookup
    return fact.join(side, on, how)
