"""Broadcast sides whose size is looked at first."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Rows that a side may have to be broadcast.
MOST_ROWS = 20_000


def small_side(df: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows, else as it is: the join is then by shuffle, where
    adaptive execution splits large keys.  The look reads at most ``most`` + 1 rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
