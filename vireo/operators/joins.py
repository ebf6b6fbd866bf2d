"""Joins — J01–J16.

Spark chooses the physical join (broadcast hash when a side is measured to
be small at run time by AQE, otherwise sort-merge); nothing here forces a
broadcast of a side whose size is not bounded.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vireo.operators.project import rename_all

HOW = {"inner", "left", "left_outer", "right", "right_outer", "full", "full_outer",
       "left_semi", "left_anti", "cross"}


def join(a: DataFrame, b: DataFrame, on: str | Sequence[str] | Column, how: str = "inner") -> DataFrame:
    """Equi-join USING column name(s) (one key copy) or ON an expression
    (both copies kept)."""
    if how not in HOW:
        raise ValueError(f"unknown join type {how}")
    return a.join(b, on, how)


def cross_join(a: DataFrame, b: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Cartesian product, optionally renamed to unique names.

    Only meant for inputs with a known small size (the reference uses two
    8-row tables); the planner picks a broadcast nested loop for a small side.
    """
    out = a.crossJoin(b)
    return rename_all(out, names) if names else out


def self_join(df: DataFrame, cond: Column, how: str = "inner", left: str = "a", right: str = "b") -> DataFrame:
    """``df.alias(a).join(df.alias(b), cond)``; reference columns as
    ``F.col("a.x")``."""
    return df.alias(left).join(df.alias(right), cond, how)


def join_with(a: DataFrame, b: DataFrame, cond: Column, how: str = "inner",
              left: str = "_1", right: str = "_2") -> DataFrame:
    """Typed ``joinWith`` — each side packed into one struct column."""
    sa = a.select(F.struct(*a.columns).alias(left))
    sb = b.select(F.struct(*b.columns).alias(right))
    return sa.join(sb, cond(sa[left], sb[right]) if callable(cond) else cond, how)
