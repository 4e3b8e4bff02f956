"""Joins whose keys may hold any share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lineage import cut

#: A key is hot if it holds more than a HOT_KEYS-th of the rows, so there are at most so many, whatever the size.
HOT_KEYS, LEAST_HOT = 10_000, 1_000


def join_one(rows: DataFrame, side: DataFrame, keys: str | Sequence[str], how: str = "left",
             counts: DataFrame | None = None, deal: str | None = None) -> DataFrame:
    """``rows`` joined with ``side``, which has one row of few narrow columns for each key; how is left or inner.

    Hot keys, at most HOT_KEYS, are joined by a broadcast, so their rows stay where they are; what remains is shuffled by
    the keys, of which no task then gets more than a small share. Both are read more than once, so they are tables or
    cheap to make. Null keys match nothing. ``counts``: a table of the keys and their rows ``_n``, if known. ``deal``: a column
    by which rows lie together already; those that are shuffled are dealt out by it again.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if counts is None:
        counts = cut(rows.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > LEAST_HOT))
    counts = counts.dropna(subset=keys).filter(F.col("_n") > LEAST_HOT)

    def shuffled(some: DataFrame) -> DataFrame:
        joined = some.join(side, keys, how)
        return joined.repartition(deal) if deal else joined

    if counts.isEmpty():
        return shuffled(rows)
    limit = max(LEAST_HOT, rows.count() // HOT_KEYS)
    hot = cut(counts.filter(F.col("_n") > limit).select(*keys).join(side, keys))
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(hot), keys).unionByName(shuffled(rest))
