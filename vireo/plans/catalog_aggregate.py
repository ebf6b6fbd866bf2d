"""Aggregations (A*) and running windows (W*) bound to the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vireo.operators import aggregate as agg
from vireo.operators.window import running_share, running_sum
from vireo.plans.quotes import quote_stats, quotes
from vireo.plans.registry import query
from vireo.plans.standins import money, money_total, retail_lines, revenue_by_item
from vireo.session import checkpoint_dir
from vireo.sources.tables import table


def _l(spark, sf):
    return table(spark, sf, "lineitem")


# ----------------------------------------------------------------- A01–A10
@query("group_by_expr", sql="""
SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'even' ELSE 'odd' END AS key, l_returnflag, count(*) AS n
FROM lineitem GROUP BY 1, 2""")
def group_by_expr(spark, sf):
    key = F.when(F.col("l_linenumber") % 2 == 0, F.lit("even")).otherwise(F.lit("odd"))
    return agg.group_values(_l(spark, sf), key, "l_returnflag")


@query("group_values", sql="""
SELECT l_returnflag AS key, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def group_values(spark, sf):
    return agg.group_values(_l(spark, sf), "l_returnflag", "l_linestatus")


@query("reduce_by_key", sql="SELECT l_suppkey, sum(l_quantity) AS total FROM lineitem GROUP BY l_suppkey")
def reduce_by_key(spark, sf):
    return agg.reduce_by_key(_l(spark, sf), "l_suppkey", "l_quantity")


@query("group_then_sum", sql="SELECT l_suppkey AS key, sum(l_quantity) AS total FROM lineitem GROUP BY l_suppkey")
def group_then_sum(spark, sf):
    grouped = agg.group_values(_l(spark, sf), "l_suppkey", "l_quantity")
    return agg.sum_from_groups(grouped, "key", "l_quantity")


@query("global_sum_count", sql="SELECT sum(l_quantity) AS total, count(*) AS n FROM lineitem")
def global_sum_count(spark, sf):
    return _l(spark, sf).agg(F.sum("l_quantity").alias("total"), F.count(F.lit(1)).alias("n"))


@query("tree_aggregate", sql="SELECT sum(l_quantity) AS total FROM lineitem")
def tree_aggregate(spark, sf):
    return agg.tree_aggregate(_l(spark, sf), "l_quantity", fanout=4)


@query("combine_sum_count", sql="""
SELECT l_suppkey, sum(l_quantity) AS sum_l_quantity, count(*) AS n FROM lineitem GROUP BY l_suppkey""")
def combine_sum_count(spark, sf):
    return agg.combine_by_key(_l(spark, sf), "l_suppkey", ["l_quantity"])


@query("aggregate_by_key", sql="""
SELECT l_returnflag, CAST(sum(l_linenumber) AS BIGINT) AS total FROM lineitem GROUP BY l_returnflag""")
def aggregate_by_key(spark, sf):
    return agg.reduce_by_key(_l(spark, sf), "l_returnflag", "l_linenumber")


@query("combine_multi", sql="""
SELECT l_suppkey, l_returnflag, sum(l_quantity) AS sum_l_quantity,
       CAST(sum(l_linenumber) AS BIGINT) AS sum_l_linenumber, count(*) AS n
FROM lineitem GROUP BY l_suppkey, l_returnflag""")
def combine_multi(spark, sf):
    return agg.combine_by_key(_l(spark, sf), ["l_suppkey", "l_returnflag"], ["l_quantity", "l_linenumber"])


@query("global_reduce", sql="SELECT CAST(sum(l_orderkey) AS BIGINT) AS total FROM lineitem")
def global_reduce(spark, sf):
    return _l(spark, sf).agg(F.sum("l_orderkey").alias("total"))


# ----------------------------------------------------------------- A11–A15
@query("numeric_stats", sql="""
SELECT count(l_quantity) AS count, min(l_quantity) AS min, max(l_quantity) AS max, sum(l_quantity) AS sum,
       avg(l_quantity) AS mean, round(stddev_pop(l_quantity), 6) AS stdev, round(var_pop(l_quantity), 6) AS variance
FROM lineitem""")
def numeric_stats(spark, sf):
    s = agg.numeric_stats(_l(spark, sf), "l_quantity")
    return s.withColumns({"stdev": F.round("stdev", 6), "variance": F.round("variance", 6)})


@query("count_by_key", sql="SELECT l_returnflag, count(*) AS count FROM lineitem GROUP BY l_returnflag")
def count_by_key(spark, sf):
    return agg.count_by(_l(spark, sf), ["l_returnflag"])


@query("count_by_value", sql="""
SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def count_by_value(spark, sf):
    return agg.count_by(_l(spark, sf), ["l_returnflag", "l_linestatus"])


@query("histogram", sql="""
WITH b AS (SELECT min(l_quantity) AS mn, max(l_quantity) AS mx FROM lineitem),
c AS (SELECT CAST(least(floor((l_quantity - mn) / (mx - mn) * 10), 9) AS INTEGER) AS bucket, count(*) AS n
      FROM lineitem, b WHERE l_quantity IS NOT NULL GROUP BY 1),
g AS (SELECT CAST(range AS INTEGER) AS bucket FROM range(10))
SELECT g.bucket, mn + g.bucket * ((mx - mn) / 10) AS lower,
       CASE WHEN g.bucket = 9 THEN mx ELSE mn + (g.bucket + 1) * ((mx - mn) / 10) END AS upper,
       coalesce(n, 0) AS count
FROM g CROSS JOIN b LEFT JOIN c ON g.bucket = c.bucket""")
def histogram(spark, sf):
    return agg.histogram(_l(spark, sf), "l_quantity", 10)


@query("count_approx", sql="SELECT true AS inside FROM (SELECT count(*) FROM lineitem)")
def count_approx(spark, sf):
    """Whether the exact count lies in the interval of the estimate."""
    est = agg.count_approx(_l(spark, sf), fraction=0.1, confidence=0.999)
    exact = _l(spark, sf).agg(F.count(F.lit(1)).alias("n"))  # one row
    return est.join(F.broadcast(exact)).select(((F.col("low") <= F.col("n")) & (F.col("n") <= F.col("high"))).alias("inside"))


@query("approx_distinct", sql="SELECT count(DISTINCT l_partkey) AS n, true AS close FROM lineitem")
def approx_distinct(spark, sf):
    """The exact number, and whether the estimate is within four standard deviations of it."""
    both = _l(spark, sf).agg(F.approx_count_distinct("l_partkey", 0.05).alias("est"), F.count_distinct("l_partkey").alias("n"))
    return both.select("n", (F.abs(F.col("est") - F.col("n")) <= 0.2 * F.col("n")).alias("close"))


# ----------------------------------------------------------------- A16–A21
@query("group_prefix", sql="""
SELECT substring(p_brand, 1, 7) AS prefix, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS total_size
FROM part GROUP BY 1""")
def group_prefix(spark, sf):
    p = table(spark, sf, "part")
    return p.groupBy(F.substring("p_brand", 1, 7).alias("prefix")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("total_size"))


@query("sum_distinct", sql="""
SELECT l_returnflag, sum(l_quantity) AS total, sum(DISTINCT l_quantity) AS distinct_total, count(*) AS n
FROM lineitem GROUP BY l_returnflag""")
def sum_distinct(spark, sf):
    return _l(spark, sf).groupBy("l_returnflag").agg(
        F.sum("l_quantity").alias("total"), F.sum_distinct("l_quantity").alias("distinct_total"),
        F.count(F.lit(1)).alias("n"))


def nested_customers(spark, sf):
    """Struct / array / map columns built from customer ⋈ nation (the movie
    JSON stand-in): cast{Director, LeadActor}, genres[], ratings{imdb, rt}."""
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("title"),
        F.struct(F.col("n_name").alias("Director"), F.col("c_mktsegment").alias("LeadActor"),
                 F.col("c_acctbal").alias("BoxOfficeUSDMn")).alias("cast"),
        F.array(F.col("c_mktsegment"), F.col("n_name")).alias("genres"),
        F.create_map(F.lit("imdb"), money("c_acctbal"),
                     F.lit("rt"), F.col("c_nationkey").cast("decimal(18,2)")).alias("ratings"))


@query("group_nested", sql="""
SELECT c_mktsegment AS LeadActor, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS imdb_total
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY c_mktsegment""")
def group_nested(spark, sf):
    m = nested_customers(spark, sf)
    return m.groupBy(F.col("cast.LeadActor").alias("LeadActor")).agg(
        F.sum(F.col("ratings")["imdb"]).cast("double").alias("imdb_total"))


@query("group_nested_sql", sql="""
SELECT c_mktsegment AS LeadActor, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS imdb_total
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY c_mktsegment""")
def group_nested_sql(spark, sf):
    nested_customers(spark, sf).createOrReplaceTempView("vireo_movies")
    return spark.sql("SELECT cast.LeadActor AS LeadActor, CAST(sum(ratings.imdb) AS DOUBLE) AS imdb_total "
                     "FROM vireo_movies GROUP BY cast.LeadActor")


_RETAIL_SQL = """
WITH r AS (
  SELECT p_name AS description, l_quantity AS quantity, p_retailprice AS price, n_name AS country
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey)
"""


@query("group_mean", sql=_RETAIL_SQL + """
SELECT country, avg(quantity) AS avg_quantity,
       CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(price) AS avg_price
FROM r GROUP BY country""")
def group_mean(spark, sf):
    r = retail_lines(spark, sf)
    return r.groupBy("country").agg(
        F.avg("quantity").alias("avg_quantity"),
        (money_total("price") / F.count("price")).alias("avg_price"))


@query("group_mean_item", sql=_RETAIL_SQL + """
SELECT country, description, avg(quantity) AS avg_quantity,
       CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(price) AS avg_price
FROM r GROUP BY country, description""")
def group_mean_item(spark, sf):
    r = retail_lines(spark, sf)
    return r.groupBy("country", "description").agg(
        F.avg("quantity").alias("avg_quantity"),
        (money_total("price") / F.count("price")).alias("avg_price"))


@query("group_sum_product", sql=_RETAIL_SQL + """
SELECT country, CAST(sum(CAST(quantity AS DECIMAL(18,2)) * CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM r GROUP BY country""")
def group_sum_product(spark, sf):
    r = retail_lines(spark, sf)
    return r.groupBy("country").agg(
        F.sum(money("quantity") * money("price")).cast("double").alias("revenue"))


@query("quote_stats", sql="""
SELECT p_brand AS symbol, avg(l_quantity) AS avgqty,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(l_extendedprice) AS avgval,
       sum(l_quantity) AS totqty, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sumval,
       min(p_retailprice) AS mincls, max(p_retailprice) AS maxcls
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""")
def quote_stats_q(spark, sf):
    return quote_stats(quotes(spark, sf))


# ----------------------------------------------------------------- A22–A24
def _order_dims(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderstatus", "o_orderpriority", F.year("o_orderdate").cast("int").alias("yr"),
                    "o_totalprice")


_DIM_AGGS = """count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total"""
_DIMS_SQL = """
WITH d AS (SELECT o_orderstatus, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS yr, o_totalprice FROM orders)
"""


def _aggs():
    return [F.count(F.lit(1)).alias("n"), money_total("o_totalprice").alias("total")]


@query("cube", sql=_DIMS_SQL + f"""
SELECT o_orderstatus, o_orderpriority, yr, {_DIM_AGGS},
       CAST(grouping(o_orderstatus, o_orderpriority, yr) AS BIGINT) AS gid
FROM d GROUP BY CUBE (o_orderstatus, o_orderpriority, yr)""")
def cube(spark, sf):
    return agg.cube(_order_dims(spark, sf), ["o_orderstatus", "o_orderpriority", "yr"], _aggs())


@query("cube_sql", sql=_DIMS_SQL + f"""
SELECT o_orderstatus, yr, {_DIM_AGGS} FROM d GROUP BY CUBE (o_orderstatus, yr)""")
def cube_sql(spark, sf):
    _order_dims(spark, sf).createOrReplaceTempView("vireo_order_dims")
    return spark.sql("SELECT o_orderstatus, yr, count(*) AS n, "
                     "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total "
                     "FROM vireo_order_dims GROUP BY o_orderstatus, yr WITH CUBE")


@query("rollup", sql=_DIMS_SQL + f"""
SELECT o_orderstatus, o_orderpriority, yr, {_DIM_AGGS},
       CAST(grouping(o_orderstatus, o_orderpriority, yr) AS BIGINT) AS gid
FROM d GROUP BY ROLLUP (o_orderstatus, o_orderpriority, yr)""")
def rollup(spark, sf):
    return agg.rollup(_order_dims(spark, sf), ["o_orderstatus", "o_orderpriority", "yr"], _aggs())


@query("grouping_sets", sql=_DIMS_SQL + f"""
SELECT o_orderstatus, o_orderpriority, yr, {_DIM_AGGS},
       CAST(grouping(o_orderstatus, o_orderpriority, yr) AS BIGINT) AS gid
FROM d GROUP BY GROUPING SETS ((o_orderstatus, yr), (yr, o_orderpriority))""")
def grouping_sets(spark, sf):
    return agg.grouping_sets(_order_dims(spark, sf), [["o_orderstatus", "yr"], ["yr", "o_orderpriority"]],
                             ["o_orderstatus", "o_orderpriority", "yr"], _aggs())


# ----------------------------------------------------------------- A25–A29
@query("quantiles_exact", sql="""
SELECT quantile_cont(l_quantity, 0.1) AS p10, quantile_cont(l_quantity, 0.5) AS p50,
       quantile_cont(l_quantity, 0.9) AS p90 FROM lineitem""")
def quantiles_exact(spark, sf):
    return agg.exact_quantiles(_l(spark, sf), "l_quantity", [0.1, 0.5, 0.9])


@query("quantiles_approx", sql="""
SELECT c AS column, CAST(i AS INTEGER) AS decile, true AS close
FROM (VALUES ('l_quantity'), ('l_discount')) AS t(c), range(1, 10) AS r(i)""")
def quantiles_approx(spark, sf):
    """Per column and decile, whether the value's rank is within the relative error (0.02) of the decile."""
    probs = [i / 10 for i in range(1, 10)]
    li = _l(spark, sf).select("l_quantity", "l_discount")
    est = agg.quantiles(li, ["l_quantity", "l_discount"], probs, exact=False, accuracy=50)  # one row
    checks = [F.struct(F.lit(c).alias("column"), F.lit(i + 1).alias("decile"),
                       (F.sum((F.col(c) < F.col(f"{c}_q")[i]).cast("long")) / F.count(c)).alias("below"),
                       (F.sum((F.col(c) <= F.col(f"{c}_q")[i]).cast("long")) / F.count(c)).alias("upto"))
              for c in li.columns for i in range(9)]
    ranked = li.join(F.broadcast(est.select(*[F.col(c).alias(f"{c}_q") for c in li.columns]))).agg(F.array(*checks).alias("a"))
    p = F.col("decile") / 10
    return ranked.select(F.inline("a")).select("column", "decile", ((F.col("below") <= p + 0.02) & (F.col("upto") >= p - 0.02)).alias("close"))


@query("mean_stddev", sql="""
SELECT avg(p_size) AS mean_size, round(stddev_samp(p_size), 6) AS sd_size FROM part""")
def mean_stddev(spark, sf):
    p = table(spark, sf, "part")
    return p.select(F.mean("p_size").alias("mean_size"), F.round(F.stddev("p_size"), 6).alias("sd_size"))


@query("mode_value", sql="""
SELECT p_size, count(*) AS count FROM part WHERE p_size IS NOT NULL GROUP BY p_size
ORDER BY count DESC, p_size LIMIT 1""")
def mode_value(spark, sf):
    return agg.mode_value(table(spark, sf, "part"), "p_size")


@query("correlation", sql="SELECT round(corr(l_quantity, l_extendedprice), 6) AS corr FROM lineitem")
def correlation(spark, sf):
    c = agg.correlation(_l(spark, sf), "l_quantity", "l_extendedprice")
    return c.select(F.round("corr", 6).alias("corr"))


@query("collect_map", sql="""
SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY o_custkey""")
def collect_map(spark, sf):
    return agg.last_value_per_key(table(spark, sf, "orders"), "o_custkey", "o_orderstatus", "o_orderkey")


# ----------------------------------------------------------------- W01–W03
_ITEMS_SQL = """
WITH agg AS (
  SELECT p.p_name AS description, SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS trev
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY p.p_name)
"""


@query("running_sum", sql=_ITEMS_SQL + """
SELECT description, CAST(trev AS DOUBLE) AS trev,
       CAST(sum(trev) OVER (ORDER BY trev) AS DOUBLE) AS cumrevenue FROM agg""")
def running_sum_q(spark, sf):
    items = revenue_by_item(spark, sf).select("description", F.col("total_revenue").alias("trev"))
    out = running_sum(items, "trev", "trev", "cumrevenue")
    return out.select("description", F.col("trev").cast("double").alias("trev"),
                      F.col("cumrevenue").cast("double").alias("cumrevenue"))


@query("running_share_sql", sql=_ITEMS_SQL + """
SELECT description, CAST(trev AS DOUBLE) AS trev,
       CAST(sum(trev) OVER (ORDER BY trev) AS DOUBLE) / CAST(sum(trev) OVER () AS DOUBLE) AS cumshare FROM agg""")
def running_share_q(spark, sf):
    items = revenue_by_item(spark, sf).select("description", F.col("total_revenue").alias("trev"))
    out = running_share(items, "trev", "trev", "__cum", "cumshare")
    return out.select("description", F.col("trev").cast("double").alias("trev"), "cumshare")


@query("running_sum_partitioned", sql=_RETAIL_SQL.replace("p_retailprice AS price,", "p_retailprice AS price, p_type AS stockcode, l_extendedprice AS amount,") + """
, rev AS (SELECT country, stockcode, sum(CAST(amount AS DECIMAL(18,2))) AS total_revenue FROM r GROUP BY 1, 2)
SELECT country, stockcode, CAST(total_revenue AS DOUBLE) AS total_revenue,
       CAST(sum(total_revenue) OVER (PARTITION BY country ORDER BY total_revenue) AS DOUBLE) AS cumrevenue
FROM rev""")
def running_sum_partitioned(spark, sf):
    r = retail_lines(spark, sf)
    rev = r.groupBy("country", "stockcode").agg(F.sum(money("amount")).alias("total_revenue"))
    checkpoint_dir(spark)
    rev = rev.checkpoint(eager=True)   # read by several branches of the running sum
    out = running_sum(rev, "total_revenue", "total_revenue", "cumrevenue", partition_by=["country"])
    return out.select("country", "stockcode", F.col("total_revenue").cast("double").alias("total_revenue"),
                      F.col("cumrevenue").cast("double").alias("cumrevenue"))
