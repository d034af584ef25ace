"""Broadcast hints behind a check of size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def dimension(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A dimension table with a broadcast hint if it really is small; else AQE picks the join."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
