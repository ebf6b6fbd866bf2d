"""Sorting and top-k — O01–O07.

``orderBy`` is a range-partitioned sort; ``orderBy(..).limit(n)`` becomes
TakeOrderedAndProject, which keeps only ``n`` rows per task before the final
merge — the top-k is never a full sort or a driver-side loop.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sort_by(df: DataFrame, *keys: Column) -> DataFrame:
    return df.orderBy(*keys)


def top_n(df: DataFrame, n: int, *keys: Column) -> DataFrame:
    """The first ``n`` rows under ``keys`` (give a full tiebreak to be
    deterministic)."""
    return df.orderBy(*keys).limit(n)


def top_k_groups(df: DataFrame, key: str | Sequence[str], k: int, count_col: str = "count") -> DataFrame:
    """Count per key, then the ``k`` most frequent (key breaks ties)."""
    keys = [key] if isinstance(key, str) else list(key)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
    return counted.orderBy(F.desc(count_col), *[F.asc(c) for c in keys]).limit(k)
