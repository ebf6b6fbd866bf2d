"""Partitioning, caching and driver-side metrics — X04–X08, S26.

``coalesce`` narrows partitions without a shuffle; a custom "partitioner" is a
bucket-id expression that names the partition; metrics are collected with
``DataFrame.observe`` (filled once by the action that runs the plan, and not
double-counted on task retries the way an accumulator updated inside a
transformation can be).
"""

from __future__ import annotations

from contextlib import contextmanager
from typing import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def letter_bucket(col: Column, upper_bounds: Sequence[str]) -> Column:
    """Bucket by upper-cased first letter: ``<= b0`` → 0, ``<= b1`` → 1, …,
    otherwise ``len(upper_bounds)``."""
    first = F.upper(F.substring(col, 1, 1))
    expr = None
    for i, b in enumerate(upper_bounds):
        expr = F.when(first <= b, F.lit(i)) if expr is None else expr.when(first <= b, F.lit(i))
    return expr.otherwise(F.lit(len(upper_bounds)))


def partition_by_letter(df: DataFrame, col: str, upper_bounds: Sequence[str]) -> DataFrame:
    """Rows placed by a first-letter range rule: bucket b goes to partition b."""
    return df.repartitionById(len(upper_bounds) + 1, letter_bucket(F.col(col), upper_bounds))


def coalesce_share(df: DataFrame, share: float) -> DataFrame:
    """Fewer partitions without a shuffle, as a share of what there are
    (at least one), so that the width still grows with the input."""
    return df.coalesce(max(1, int(df.rdd.getNumPartitions() * share)))


def with_pid(df: DataFrame, out: str = "pid") -> DataFrame:
    return df.withColumn(out, F.spark_partition_id())


def observe_sums(df: DataFrame, sums: Mapping[str, str], name: str = "metrics") -> tuple[DataFrame, Observation]:
    """A two-field (or n-field) accumulator as an observation: sums of
    the given columns plus the row count, available after the first action."""
    obs = Observation(name)
    exprs = [F.sum(c).alias(k) for k, c in sums.items()] + [F.count(F.lit(1)).alias("rows")]
    return df.observe(obs, *exprs), obs


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Cache a reused intermediate for the duration of a block and always
    release it (spills to disk instead of recomputing under memory pressure)."""
    d = df.persist(level)
    try:
        yield d
    finally:
        d.unpersist()


def shuffle_width(spark, partitions: int) -> None:
    """The static shuffle width (AQE still coalesces small partitions)."""
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
