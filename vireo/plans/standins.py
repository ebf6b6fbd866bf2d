"""Stand-in frames: the reference's data sets mapped onto the given tables.

retail invoice lines  → lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ part
shipments             → lineitem ⋈ supplier ⋈ orders ⋈ customer ⋈ nation ⋈ part
All joins are many-to-one lookups on keys; Spark/AQE chooses the strategy
(the dimension sides are small and get broadcast by AQE's runtime size check).
Retail lines meet their orders and parts, and orders their customers, in
partitions of a bounded number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.operators.window import range_partitions
from vireo.sources.tables import table

#: Retail lines that one task sorts for a join or tells apart, some 400 bytes of memory each.
LINES_A_TASK = 400_000


def money(c) -> "F.Column":
    """Money as an exact decimal so sums do not depend on addition order."""
    return F.col(c).cast("decimal(18,2)") if isinstance(c, str) else c.cast("decimal(18,2)")


def money_total(c: str) -> "F.Column":
    """Exact total of a two-decimal money column, as a double: integer cents
    summed as a long (ANSI raises on overflow rather than wrapping), then one
    correctly rounded division — the same value as casting the exact decimal
    sum to double, at a fraction of the cost of a wide-decimal buffer."""
    return F.sum(F.round(F.col(c) * 100).cast("long")) / 100.0


def line_partitions(spark: SparkSession, sf: str) -> int:
    """Partitions of the lines: the shuffle width, more where a task would get over LINES_A_TASK."""
    # counted from the file's footers; partitions grow with the lines also where the shuffle width is fixed
    return max(range_partitions(spark), -(-table(spark, sf, "lineitem").count() // LINES_A_TASK))


def dealt(df: DataFrame, rows: int, key: str) -> DataFrame:
    """``df`` of ``rows`` rows dealt by ``key`` by number, where a task of a join at the shuffle width would get over LINES_A_TASK."""
    parts = -(-rows // LINES_A_TASK)
    return df.repartition(parts, key) if parts > range_partitions(df.sparkSession) else df


def retail_lines(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    # dealt by number: AQE would join partitions up to its advisory size again, which a join then sorts in one task
    li = li.repartition(line_partitions(spark, sf), "l_orderkey")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    # a country a customer and then an order, before there is a row a line
    c = c.join(n, F.col("c_nationkey") == n.n_nationkey).select("c_custkey", "n_name")
    o = (dealt(o, table(spark, sf, "orders").count(), "o_custkey").join(c, F.col("o_custkey") == c.c_custkey)
         .select("o_orderkey", "o_orderdate", "n_name"))
    sold = dealt(li.join(o, li.l_orderkey == o.o_orderkey), table(spark, sf, "lineitem").count(), "l_partkey")
    return (sold.join(p, F.col("l_partkey") == p.p_partkey)
            .select(F.col("l_orderkey").alias("invoice"),
                    F.col("p_name").alias("description"),
                    F.col("p_type").alias("stockcode"),
                    F.col("l_quantity").alias("quantity"),
                    F.col("p_retailprice").alias("price"),
                    F.col("l_extendedprice").alias("amount"),
                    F.col("o_orderdate").alias("invoicedate"),
                    F.col("n_name").alias("country")))


def revenue_by_item(spark: SparkSession, sf: str) -> DataFrame:
    """Sales and revenue per item: the input of the ABC analysis."""
    li = table(spark, sf, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice")
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    return (li.join(p, li.l_partkey == p.p_partkey)
            .groupBy(F.col("p_name").alias("description"))
            .agg(F.sum("l_quantity").alias("total_sales"),
                 F.sum(money("l_extendedprice")).alias("total_revenue")))
