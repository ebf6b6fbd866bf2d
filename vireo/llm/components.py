"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import Scratch


def _minima(edges: DataFrame) -> DataFrame:
    """(u, low): the smallest neighbour of u.

    The second key changes no group.  It only makes the join that follows
    shuffle both its sides itself, so that AQE can split a hub's rows.
    """
    return edges.groupBy("u", F.pmod("u", F.lit(7)).alias("_")).agg(F.min("v").alias("low")).select("u", "low")


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, src: str, dst: str, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) of every node that has an edge to another; component is the smallest node.

    ``edges`` has two long columns, in any direction, repeated or with loops
    (loops are ignored).  Each round is written to the shared folder; rounds
    grow with the logarithm of a component's diameter.
    """
    a, b = F.col(src), F.col(dst)
    current = scratch.cut(edges.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), f"{name}0")
    before, step = _state(current), 0
    while before[0]:
        step += 1
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _minima(both)
        above: Column = F.col("v") > F.col("u")
        large = both.filter(above).join(low, "u").select(F.col("v").alias("u"), F.least("low", "u").alias("v")).distinct()
        large = scratch.cut(large, f"{name}{step}-large")
        low = _minima(large)
        small = large.join(low, "u").filter(F.col("v") != F.col("low")).select(F.col("v").alias("u"), F.col("low").alias("v"))
        after = scratch.cut(small.union(low.select("u", F.col("low").alias("v"))).distinct(), f"{name}{step}")
        scratch.drop(f"{name}{step - 1}", f"{name}{step}-large")
        current, state = after, _state(after)
        if state == before:
            break
        before = state
    heads = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(heads)
