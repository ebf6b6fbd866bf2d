"""Set operations — U01–U03."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """Bag union by column name (no shuffle)."""
    return a.unionByName(b)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def split_complement(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Keyed subset and its exact complement: rows where the predicate is
    NULL go to the rest, so the two counts always add up to the whole."""
    hit = F.coalesce(predicate, F.lit(False))
    return df.where(hit), df.where(~hit)
