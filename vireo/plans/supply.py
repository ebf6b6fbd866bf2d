"""Supply-chain analyses — K05 economic order quantity / total logistics cost
and K06 vendor cost roll-up, over the shipments stand-in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.sources.files import parquet_roundtrip, scratch_path
from vireo.sources.tables import table


def shipments(spark: SparkSession, sf: str, with_country: bool = True) -> DataFrame:
    """vendor = supplier, country = customer nation, moleculetesttype = part
    type; weight = quantity, value = extended price, freight = value × tax,
    insurance = value × discount.  ``with_country=False`` leaves out the
    country and the three joins that only it needs.

    Money is exact integers: the value in cents, the freight and insurance
    products in units of 10^-4 (cents × hundredths).  Sums stay exact and
    order-independent in a compact long buffer; each report divides once.
    """
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
                                             "l_extendedprice", "l_tax", "l_discount")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    p = table(spark, sf, "part").select("p_partkey", "p_type")
    j = li
    if with_country:  # an order's country first, so that lines move once for it and without strings
        o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
        c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
        n = table(spark, sf, "nation").select("n_nationkey", "n_name")
        places = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)
        j = j.join(places.select("o_orderkey", "n_name"), F.col("l_orderkey") == F.col("o_orderkey"))
    j = j.join(p, F.col("l_partkey") == p.p_partkey).join(s, F.col("l_suppkey") == s.s_suppkey)
    value = cents("l_extendedprice")
    return j.select(F.col("s_suppkey").alias("vendorkey"), F.col("s_name").alias("vendor"),
                    *([F.col("n_name").alias("country")] if with_country else []), F.col("p_type").alias("moleculetesttype"),
                    F.col("l_quantity").alias("weightkilograms"),
                    F.col("l_quantity").alias("lineitemquantity"),
                    value.alias("lineitemvalue_cents"),
                    (value * cents("l_tax")).alias("freightcost_e4"),
                    (value * cents("l_discount")).alias("insurance_e4"))


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("long")


def vendor_cost(df: DataFrame) -> DataFrame:
    """Per (item, vendor) quantity, value, shipping, insurance and their
    plain sum (units and money added together, as in the reference)."""
    g = df.groupBy("moleculetesttype", "vendor").agg(
        F.sum("lineitemquantity").alias("totqty"),
        (F.sum("lineitemvalue_cents") / 100.0).alias("totvalue"),
        (F.sum("freightcost_e4") / 10000.0).alias("totshippingcost"),
        (F.sum("insurance_e4") / 10000.0).alias("insurcost"))
    return g.withColumn("totalcost", F.col("totqty") + F.col("totvalue") + F.col("totshippingcost") + F.col("insurcost"))


def holding_cost(key: Column) -> Column:
    """Deterministic stand-in for the reference's random 0.1–0.9 holding cost."""
    return (F.lit(1) + F.pmod(key, F.lit(9))) / 10.0


def random_holding_cost(seed: int) -> Column:
    """The reference's random holding cost, one of 0.1, 0.2, …, 0.9 —
    built in (seeded ``rand``), not a Python UDF."""
    return (F.lit(1) + F.floor(F.rand(seed) * 9)) / 10.0


def eoq_tlc(df: DataFrame, formula: str = "reference") -> DataFrame:
    """K05.  demand per (country, item); per (vendor, country, item) order
    count, supply, item cost, freight + insurance over the rows whose four
    numeric fields parse (the reference drops the others); batch size and
    order cost per order; then ``eoq = 2·sqrt(D·S/(h·batch))`` (the reference
    keeps the 2 outside the root; ``formula="textbook"`` gives
    ``sqrt(2·D·S/(h·batch))``) and
    ``tlc = D/eoq·S + eoq/2·h·batch + itemcost/vsupply·D``.

    Demand and costs come from the same per-(vendor, country, item) aggregate
    (conditional sums for the clean rows), which is written once, so that
    ``df`` runs once; demand is summed over vendors from that aggregate and
    joined back.
    """
    wkg = F.col("weightkilograms").try_cast("double")
    clean = (wkg.isNotNull() & F.col("lineitemvalue_cents").isNotNull() & F.col("freightcost_e4").isNotNull()
             & F.col("insurance_e4").isNotNull())

    def when_clean(c):
        return F.when(clean, c)

    per = df.groupBy("vendorkey", "vendor", "country", "moleculetesttype").agg(
        F.sum(wkg).alias("__all_w"),
        F.count(when_clean(F.lit(1))).alias("noorders"), F.sum(when_clean(wkg)).alias("vsupply"),
        (F.sum(when_clean(F.col("lineitemvalue_cents"))) / 100.0).alias("itemcost"),
        ((F.sum(when_clean(F.col("freightcost_e4"))) + F.sum(when_clean(F.col("insurance_e4"))))
         / 10000.0).alias("tordercost"))
    per = parquet_roundtrip(per, scratch_path(df.sparkSession, "eoq"))
    # demand over all vendors: summed before any shuffle, so a hot item is one row per task
    demand = (per.groupBy(F.col("country").alias("__c"), F.col("moleculetesttype").alias("__m"))
              .agg(F.sum("__all_w").alias("demand")))
    per = per.join(demand, F.col("country").eqNullSafe(F.col("__c")) & F.col("moleculetesttype").eqNullSafe(F.col("__m"))).drop("__c", "__m")
    costs = per.where(F.col("noorders") > 0).withColumns({
        "batchsize": F.col("vsupply") / F.col("noorders"),
        "ordercost": F.col("tordercost") / F.col("noorders"),
        "rhc": holding_cost(F.col("vendorkey"))})
    d, s, h, b = F.col("demand"), F.col("ordercost"), F.col("rhc"), F.col("batchsize")
    if formula == "textbook":
        eoq = F.sqrt(F.lit(2) * d * s / (h * b))
    else:
        eoq = F.lit(2) * F.sqrt(d * s / (h * b))
    ds = costs.withColumn("eoq", eoq)
    e = F.col("eoq")
    tlc = F.try_divide(d, e) * s + e / F.lit(2) * h * b + F.try_divide(F.col("itemcost"), F.col("vsupply")) * d
    return ds.withColumn("tlc", tlc).select("vendor", "country", "moleculetesttype", "demand", "ordercost",
                                            "batchsize", "rhc", "eoq", "tlc")
