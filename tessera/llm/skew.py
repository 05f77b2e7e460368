"""Joins in which one key may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy from this share of the rows; there are at most 1 / share such keys.
HEAVY_SHARE = 1 / 1000
#: Largest number of rows that `small` lets be broadcast.
BROADCAST_ROWS = 20_000
#: The same for rows of one or two longs.
NARROW_ROWS = 500_000


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``limit`` rows, else as it is.

    ``df`` should be a table on disk, since its rows are counted.
    """
    return F.broadcast(df) if df.count() <= limit else df


def least_heavy(total: int) -> int:
    """So many rows make a key heavy."""
    return max(64, int(total * HEAVY_SHARE))


def join_by_group(rows: DataFrame, groups: DataFrame, key: list[str], size: str, total: int, how: str = "inner") -> DataFrame:
    """Join ``rows`` with one row of ``groups`` for each key.

    ``groups[size]`` says how many of the ``total`` rows have the key.  Keys of at
    least ``HEAVY_SHARE`` of all rows, of which there are at most 1 / share, are
    broadcast, so that no task receives a heavy key; the others are shuffled and
    none of them is large.  ``groups`` should be a table on disk.  how: inner or left.
    """
    least = least_heavy(total)
    heavy = F.broadcast(groups.filter(F.col(size) >= least))
    light = groups.filter(F.col(size) < least)
    hot = rows.join(heavy, key, "inner")
    rest = rows.join(heavy.select(*key), key, "left_anti").join(light, key, how)
    return hot.unionByName(rest)
