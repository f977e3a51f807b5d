"""Size checks that decide between plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# A side below this may be sent to every executor.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024

# Input files below this fit one task whatever the key distribution is.
ONE_TASK_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate: file sizes for scans, an upper bound for joins."""
    statistics = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(statistics.sizeInBytes()))


def input_bytes(df: DataFrame) -> int:
    """Size of everything the query reads. Unlike the estimate of a join, which multiplies
    both sides, this stays near the truth for lookups, unions and filters."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def is_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    return estimated_bytes(df) <= limit


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast hint behind a size check; otherwise a shuffled join with skew handling."""
    return F.broadcast(df) if is_small(df, limit) else df
