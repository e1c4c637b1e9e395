"""Size-checked broadcasts."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 16 << 20


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a checkpointed table for broadcast if its rows, ``row_bytes`` wide
    at most, fit the limit; otherwise the join stays a shuffle join, whose
    skewed partitions adaptive execution splits."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df
