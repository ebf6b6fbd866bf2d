"""Quote statistics — A21, R08, R09 (one function for batch and stream)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.plans.standins import money_total
from vireo.sources.tables import table


def quotes(spark: SparkSession, sf: str) -> DataFrame:
    """Quote stand-in: symbol = brand, close = unit price, qty, value."""
    li = table(spark, sf, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice")
    p = table(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("p_brand").alias("symbol"), F.col("p_retailprice").alias("close"),
        F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("value"))


def quote_stats(df: DataFrame, keys: Sequence[str | Column] = ("symbol",)) -> DataFrame:
    """Per key: avg / sum of quantity and value, min / max close.  Money is
    summed exactly (integer cents)."""
    sumval = money_total("value")
    return df.groupBy(*keys).agg(
        F.avg("qty").alias("avgqty"), (sumval / F.count("value")).alias("avgval"),
        F.sum("qty").alias("totqty"), sumval.alias("sumval"),
        F.min("close").alias("mincls"), F.max("close").alias("maxcls"))
