"""Data-quality profile — K07 (null counts, mean, stddev, median, mode per
numeric column) as one distributed job: the columns are unpivoted into
(column, value) rows and profiled with grouped aggregations, so the work is
spread over columns *and* rows.  The median uses the exact distributed
quantile, so a column is never one aggregation buffer."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.operators.aggregate import exact_quantiles
from vireo.operators.project import numeric_columns


def profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols) if cols is not None else numeric_columns(df)
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])).alias("kv")
    ).select("kv.column", "kv.v")
    stats = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"), F.count("v").alias("non_null"),
        F.avg("v").alias("mean"), F.stddev("v").alias("stddev"))
    # one frequency table per (column, value) feeds both the median and the mode
    freq = long.where(F.col("v").isNotNull()).groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    median = exact_quantiles(freq, "v", [0.5], partition_by=["column"], names=["median"], counts="n")
    # most frequent value, smallest on ties: max of (n, -v)
    mode = freq.groupBy("column").agg(F.max(F.struct(F.col("n"), (-F.col("v")).alias("neg"))).alias("m")) \
        .select("column", (-F.col("m.neg")).alias("mode"))
    return stats.join(median, "column", "left").join(mode, "column", "left").select(
        "column", "rows", (F.col("rows") - F.col("non_null")).alias("nulls"), "mean", "stddev", "median", "mode")
