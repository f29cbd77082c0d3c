"""Joins to a table of one row per key, when a few keys may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it holds more than one in so many of the rows; so there are fewer hot keys than this.
SHARE = 1000


def lookup(rows: DataFrame, table: DataFrame, key: str, weight: str) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row per ``key`` and, in ``weight``, how many rows there are of
    it; rows whose key is not there or null are left out.

    Rows of hot keys (fewer than ``SHARE`` keys, whatever the input) meet their entry by broadcast and are not shuffled;
    what is left has no key above one in ``SHARE`` rows and is joined by shuffle."""
    total = table.agg(F.sum(weight)).first()[0] or 0
    hot = table.filter(F.col(weight) > total / SHARE)
    cold = table.filter(F.col(weight) <= total / SHARE)
    near = rows.join(F.broadcast(hot), key)
    far = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return near.unionByName(far)
