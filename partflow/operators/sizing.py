"""Broadcast behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup table of up to this many rows is broadcast (a price table row is an id and a
# double, so this is a few tens of MB per executor at most).
MAX_BROADCAST_ROWS = 2_000_000


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` if it has at most ``max_rows`` rows, else ``df`` unchanged (a
    shuffle join then). The check is an exact distributed count: every task counts its
    own partition (column-pruned to what the table's filters need) and only one number
    per task is combined. A ``limit(n).count()`` would instead funnel up to n rows per
    partition into a single task."""
    n = df.count()
    return F.broadcast(df) if n <= max_rows else df
