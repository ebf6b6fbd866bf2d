"""Projection / null handling / reshape (P*), joins (J*), set operations (U*)
and ordering (O*), bound to the given tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from vireo.operators import joins, ordering, project, setops
from vireo.plans.registry import query
from vireo.plans.standins import money_total
from vireo.sources.tables import table


def _t(spark, sf, name):
    return table(spark, sf, name)


# ----------------------------------------------------------------- P01–P07
@query("project_map", sql="""
SELECT l_orderkey, l_linenumber, l_quantity * 2 AS qty2,
       l_extendedprice * (1 - l_discount) AS net, lower(l_returnflag) AS flag
FROM lineitem""")
def project_map(spark, sf):
    li = _t(spark, sf, "lineitem")
    return project.map_rows(li, l_orderkey=F.col("l_orderkey"), l_linenumber=F.col("l_linenumber"),
                            qty2=F.col("l_quantity") * 2,
                            net=F.col("l_extendedprice") * (1 - F.col("l_discount")),
                            flag=F.lower("l_returnflag"))


@query("filter_odd", sql="""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE CAST(l_quantity AS BIGINT) % 2 <> 0""")
def filter_odd(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return project.filter_rows(li, F.col("l_quantity").cast("long") % 2 != 0)


@query("flatmap_array", sql="""
SELECT p_partkey, unnest([p_size, p_size * 10]) AS v FROM part""")
def flatmap_array(spark, sf):
    p = _t(spark, sf, "part")
    return project.flat_map(p, F.array("p_size", F.col("p_size") * 10), "v", keep=["p_partkey"])


@query("flatmap_sequence", sql="""
SELECT p_partkey, unnest(generate_series(p_size, 5)) AS v FROM part""")
def flatmap_sequence(spark, sf):
    # Scala's ``x to 5`` is empty for x > 5; Spark's sequence would count down.
    upto = F.when(F.col("p_size") <= 5, F.sequence("p_size", F.lit(5))).otherwise(F.array().cast("array<int>"))
    return project.flat_map(_t(spark, sf, "part"), upto, "v", keep=["p_partkey"])


def _net_batches(batches):
    for pdf in batches:
        yield pd.DataFrame({"l_orderkey": pdf["l_orderkey"], "l_linenumber": pdf["l_linenumber"],
                            "net": pdf["l_extendedprice"] * (1 - pdf["l_discount"])})


@query("map_partitions", sql="""
SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM lineitem""")
def map_partitions(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    return project.map_partitions(li, _net_batches, "l_orderkey long, l_linenumber int, net double")


@query("partition_index", sql="SELECT l_orderkey, l_linenumber, true AS numbered FROM lineitem")
def partition_index(spark, sf):
    """Every row with whether its partition's number is one of the scan's."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    n = li.rdd.getNumPartitions()
    tagged = project.with_partition_index(li)
    return tagged.select("l_orderkey", "l_linenumber", ((F.col("pid") >= 0) & (F.col("pid") < n)).alias("numbered"))


@query("glom", sql="SELECT o_orderkey FROM orders")
def glom(spark, sf):
    """The partitions' arrays, opened again."""
    return project.glom(_t(spark, sf, "orders"), "o_orderkey").select(F.explode("items").alias("o_orderkey"))


@query("key_by", sql="""
SELECT upper(substring(p_name, 1, 1)) AS key, p_partkey, p_name FROM part""")
def key_by(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey", "p_name")
    return project.key_by(p, F.upper(F.substring("p_name", 1, 1)))


# ----------------------------------------------------------------- P08–P09
@query("zip_positional", sql="""
WITH a AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS idx FROM customer),
     b AS (SELECT c_name, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS idx FROM customer)
SELECT a.idx, a.c_custkey, b.c_name FROM a JOIN b ON a.idx = b.idx""")
def zip_positional(spark, sf):
    c = _t(spark, sf, "customer")
    a = c.select("c_custkey")
    b = c.select("c_name", F.struct("c_acctbal", "c_custkey").alias("ord"))
    return project.zip_positional(a, "c_custkey", b, "ord", ["c_custkey"], ["c_name"])


@query("zip_partitions", sql="SELECT o_orderkey, o_custkey FROM orders")
def zip_partitions(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return project.zip_partitions(o, o, "o_orderkey", "o_custkey").select("o_orderkey", "o_custkey")


# ----------------------------------------------------------------- P10–P17
@query("select_cols", sql="SELECT c_custkey, c_name FROM customer")
def select_cols(spark, sf):
    return _t(spark, sf, "customer").select("c_custkey", "c_name")


@query("select_expr", sql="""
SELECT l_orderkey AS orderkey, l_quantity * 2 AS qty2, upper(l_returnflag) AS flag,
       l_extendedprice * (1 + l_tax) AS gross FROM lineitem""")
def select_expr(spark, sf):
    return _t(spark, sf, "lineitem").selectExpr(
        "l_orderkey as orderkey", "l_quantity * 2 as qty2", "upper(l_returnflag) as flag",
        "l_extendedprice * (1 + l_tax) as gross")


@query("filter_sql", sql="""
SELECT p_partkey, p_name, p_brand, p_size FROM part
WHERE p_size > 40 AND p_name LIKE 'red%' OR p_brand = 'Brand#1' OR p_brand = 'Brand#2'""")
def filter_sql(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    return project.filter_rows(p, "p_size > 40 and p_name like 'red%' or p_brand = 'Brand#1' or p_brand = 'Brand#2'")


@query("filter_column", sql="""
SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
WHERE c_acctbal >= 1000 AND starts_with(c_mktsegment, 'BUILD')""")
def filter_column(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return project.filter_rows(c, (F.col("c_acctbal") >= 1000) & F.col("c_mktsegment").startswith("BUILD"))


@query("computed_column", sql="""
SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net,
       l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross FROM lineitem""")
def computed_column(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    out = project.add_columns(li, {"net": net, "gross": net * (1 + F.col("l_tax"))})
    return out.select("l_orderkey", "l_linenumber", "net", "gross")


@query("rename_all", sql="SELECT n_nationkey AS key, n_name AS name, n_regionkey AS region FROM nation")
def rename_all(spark, sf):
    return project.rename_all(_t(spark, sf, "nation"), ["key", "name", "region"])


@query("rename_bulk", sql="""
SELECT p_partkey AS "Part #", p_name AS "Item Description", p_brand AS brand,
       p_type AS "Product Group", p_size AS size, p_retailprice AS "Unit Price" FROM part""")
def rename_bulk(spark, sf):
    p = _t(spark, sf, "part")
    return project.rename_bulk(p, p.columns, ["Part #", "Item Description", "brand", "Product Group",
                                              "size", "Unit Price"])


_DIRTY_LINES_SQL = """
WITH lines AS (
  SELECT concat_ws(',', CAST(c_custkey AS VARCHAR), c_mktsegment,
                   CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'n/a' ELSE CAST(c_nationkey AS VARCHAR) END) AS line
  FROM customer),
parts AS (SELECT string_split(line, ',') AS f FROM lines)
"""


def _dirty_lines(spark, sf):
    c = _t(spark, sf, "customer")
    nk = F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("n/a")).otherwise(F.col("c_nationkey").cast("string"))
    return c.select(F.concat_ws(",", F.col("c_custkey").cast("string"), "c_mktsegment", nk).alias("line"))


@query("try_cast_cols", sql=_DIRTY_LINES_SQL + """
SELECT TRY_CAST(f[1] AS BIGINT) AS id, f[2] AS segment, TRY_CAST(f[3] AS INTEGER) AS nation FROM parts""")
def try_cast_cols(spark, sf):
    f = F.split(F.col("line"), ",")
    raw = _dirty_lines(spark, sf).select(f.getItem(0).alias("id"), f.getItem(1).alias("segment"),
                                         f.getItem(2).alias("nation"))
    return project.try_cast_columns(project.try_cast_columns(raw, ["id"], "bigint"), ["nation"], "int")


# ----------------------------------------------------------------- P18–P25
_DIRTY_PART_SQL = """
WITH dp AS (
  SELECT p_partkey, p_name, p_brand, nullif(p_size, 1) AS size,
         CASE WHEN p_type = 'SMALL' THEN NULL ELSE CAST(round(p_retailprice * 100) AS BIGINT) END AS cents
  FROM part)
"""


def dirty_part(spark, sf):
    """``part`` with NULLs injected by data predicates (size 1, type SMALL)."""
    p = _t(spark, sf, "part")
    return p.select("p_partkey", "p_name", "p_brand",
                    F.expr("nullif(p_size, 1)").alias("size"),
                    F.when(F.col("p_type") == "SMALL", F.lit(None))
                    .otherwise(F.round(F.col("p_retailprice") * 100).cast("long")).alias("cents"))


@query("null_rows", sql=_DIRTY_PART_SQL + "SELECT p_partkey, p_name FROM dp WHERE size IS NULL")
def null_rows(spark, sf):
    return project.null_rows(dirty_part(spark, sf), "size").select("p_partkey", "p_name")


@query("notnull_rows", sql=_DIRTY_PART_SQL + "SELECT p_partkey, size FROM dp WHERE size IS NOT NULL")
def notnull_rows(spark, sf):
    return project.null_rows(dirty_part(spark, sf), "size", keep_null=False).select("p_partkey", "size")


@query("null_to_zero", sql=_DIRTY_PART_SQL + """
SELECT p_partkey, CASE WHEN size IS NULL THEN 0 ELSE size END AS size,
       CASE WHEN cents IS NULL THEN 0 ELSE cents END AS cents FROM dp""")
def null_to_zero(spark, sf):
    return project.null_to_zero(dirty_part(spark, sf), ["size", "cents"]).select("p_partkey", "size", "cents")


@query("dropna_any", sql=_DIRTY_PART_SQL + "SELECT * FROM dp WHERE size IS NOT NULL AND cents IS NOT NULL")
def dropna_any(spark, sf):
    return project.drop_null_rows(dirty_part(spark, sf))


@query("fillna_const", sql=_DIRTY_PART_SQL + "SELECT p_partkey, coalesce(size, 0) AS size, cents FROM dp")
def fillna_const(spark, sf):
    return project.fill_const(dirty_part(spark, sf), 0, ["size"]).select("p_partkey", "size", "cents")


@query("impute_mean", sql=_DIRTY_PART_SQL + """
, m AS (SELECT avg(size) AS ms, avg(cents) AS mc FROM dp)
SELECT p_partkey, p_name, p_brand, coalesce(size, CAST(trunc(ms) AS INTEGER)) AS size,
       coalesce(cents, CAST(trunc(mc) AS BIGINT)) AS cents FROM dp, m""")
def impute_mean(spark, sf):
    dp = dirty_part(spark, sf)
    return project.impute_mean(dp, project.numeric_columns(dp.drop("p_partkey")))


@query("null_counts", sql=_DIRTY_PART_SQL + """
SELECT CAST(sum(CASE WHEN p_partkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS p_partkey,
       CAST(sum(CASE WHEN p_name IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS p_name,
       CAST(sum(CASE WHEN p_brand IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS p_brand,
       CAST(sum(CASE WHEN size IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS size,
       CAST(sum(CASE WHEN cents IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS cents FROM dp""")
def null_counts(spark, sf):
    return project.null_counts(dirty_part(spark, sf))


@query("null_flag", sql=_DIRTY_PART_SQL + """
SELECT p_partkey, p_name, cents, CAST(cents IS NULL AS INTEGER) AS descnull FROM dp WHERE cents IS NULL""")
def null_flag(spark, sf):
    out = project.null_flag(dirty_part(spark, sf), "cents", "descnull")
    return out.where("descnull = 1").select("p_partkey", "p_name", "cents", "descnull")


@query("null_flag_count", sql=_DIRTY_PART_SQL + """
SELECT count(*) AS nulls FROM dp WHERE cents IS NULL""")
def null_flag_count(spark, sf):
    out = project.null_flag(dirty_part(spark, sf), "cents", "descnull")
    return out.where("descnull = 1").agg(F.count(F.lit(1)).alias("nulls"))


# ----------------------------------------------------------------- P26–P32
@query("dedup_rows", sql="""
SELECT DISTINCT * FROM (
  SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem
  UNION ALL
  SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag = 'R')""")
def dedup_rows(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return project.dedup_rows(li.unionByName(li.where(F.col("l_returnflag") == "R")))


@query("distinct_pairs", sql="SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_pairs(spark, sf):
    return project.distinct_values(_t(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag"])


@query("distinct_count", sql="""
SELECT count(*) AS pairs FROM (SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem)""")
def distinct_count(spark, sf):
    li = _t(spark, sf, "lineitem")
    return project.distinct_values(li, ["l_suppkey", "l_returnflag"]).agg(F.count(F.lit(1)).alias("pairs"))


_PIVOT_SQL = """
WITH pv AS (
  SELECT o_custkey,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS F,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'O') AS DOUBLE) AS O,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'P') AS DOUBLE) AS P
  FROM orders GROUP BY o_custkey)
"""


def _pivoted(spark, sf):
    o = _t(spark, sf, "orders")
    pv = project.pivot(o, ["o_custkey"], "o_orderstatus", ["F", "O", "P"], money_total("o_totalprice"))
    return pv.select("o_custkey", *[F.col(s).cast("double").alias(s) for s in ("F", "O", "P")])


@query("pivot_values", sql=_PIVOT_SQL + "SELECT * FROM pv")
def pivot_values(spark, sf):
    return _pivoted(spark, sf)


@query("unpivot", sql=_PIVOT_SQL + """
SELECT o_custkey, 'F' AS status, F AS total FROM pv UNION ALL
SELECT o_custkey, 'O', O FROM pv UNION ALL
SELECT o_custkey, 'P', P FROM pv""")
def unpivot(spark, sf):
    return project.unpivot(_pivoted(spark, sf), ["o_custkey"], ["F", "O", "P"], "status", "total")


@query("unpivot_stack", sql=_PIVOT_SQL + """
SELECT o_custkey, 'F' AS col0, F AS col1 FROM pv UNION ALL
SELECT o_custkey, 'O', O FROM pv UNION ALL
SELECT o_custkey, 'P', P FROM pv""")
def unpivot_stack(spark, sf):
    return _pivoted(spark, sf).selectExpr("o_custkey", "stack(3, 'F', F, 'O', O, 'P', P)")


@query("sample_fraction", sql="SELECT true AS subset, true AS near FROM (SELECT count(*) FROM lineitem)")
def sample_fraction(spark, sf):
    """Whether the sample's rows are rows of the table, and its size within five standard deviations."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    s = project.sample_fraction(li, 0.4, seed=5)
    whole = li.agg(F.count(F.lit(1)).alias("n"))
    known = s.join(li, ["l_orderkey", "l_linenumber"], "left_semi").agg(F.count(F.lit(1)).alias("known"))
    size = s.agg(F.count(F.lit(1)).alias("s"))
    one = whole.join(F.broadcast(size)).join(F.broadcast(known))   # one row each
    return one.select((F.col("known") == F.col("s")).alias("subset"),
                      (F.abs(F.col("s") - 0.4 * F.col("n")) <= 5 * F.sqrt(0.24 * F.col("n"))).alias("near"))


@query("sample_n", sql="SELECT 2 AS drawn, 3 AS redrawn, true AS subset FROM (SELECT count(*) FROM orders)")
def sample_n(spark, sf):
    """Sizes of a sample without and one with replacement, and whether their rows are the table's."""
    o = _t(spark, sf, "orders").select("o_orderkey")
    a = project.sample_n(o, 2, seed=5).withColumn("with", F.lit(0))
    b = project.sample_n(o, 3, seed=6, with_replacement=True).withColumn("with", F.lit(1))
    both = a.unionByName(b).join(o.withColumn("known", F.lit(1)), "o_orderkey", "left")
    return both.agg(F.sum((F.col("with") == 0).cast("int")).cast("int").alias("drawn"), F.sum("with").cast("int").alias("redrawn"),
                    (F.count("known") == F.count(F.lit(1))).alias("subset"))


@query("row_fields", sql="SELECT c_custkey, c_acctbal FROM customer")
def row_fields(spark, sf):
    return project.fields_by_position(_t(spark, sf, "customer"), [0, 3])


# ----------------------------------------------------------------- joins
def _o(spark, sf):
    return _t(spark, sf, "orders")


def _l(spark, sf):
    return _t(spark, sf, "lineitem")


@query("join_inner", sql="""
SELECT o_orderkey, o_custkey, l_linenumber, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def join_inner(spark, sf):
    o, li = _o(spark, sf), _l(spark, sf)
    return joins.join(o, li, o.o_orderkey == li.l_orderkey).select("o_orderkey", "o_custkey", "l_linenumber", "l_quantity")


def _outer(spark, sf, how):
    """Orders and lines counted per customer and per part: whole tables whose keys match only in part."""
    o = _o(spark, sf).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    li = _l(spark, sf).groupBy("l_partkey").agg(F.count(F.lit(1)).alias("lines"))
    return joins.join(o, li, o.o_custkey == li.l_partkey, how)


_OUTER_SQL = """
SELECT o_custkey, orders, l_partkey, lines
FROM (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1) o
{how} JOIN (SELECT l_partkey, count(*) AS lines FROM lineitem GROUP BY 1) l ON o_custkey = l_partkey"""


@query("join_left", sql=_OUTER_SQL.format(how="LEFT"))
def join_left(spark, sf):
    return _outer(spark, sf, "left")


@query("join_right", sql=_OUTER_SQL.format(how="RIGHT"))
def join_right(spark, sf):
    return _outer(spark, sf, "right")


@query("join_full", sql=_OUTER_SQL.format(how="FULL OUTER"))
def join_full(spark, sf):
    return _outer(spark, sf, "full")


@query("join_cross", sql="SELECT * FROM region CROSS JOIN nation")
def join_cross(spark, sf):
    return joins.cross_join(_t(spark, sf, "region"), _t(spark, sf, "nation"))


@query("join_cross_renamed", sql="""
SELECT r_regionkey AS rkey, r_name AS rname, n_nationkey AS nkey, n_name AS nname, n_regionkey AS nrkey
FROM region CROSS JOIN nation""")
def join_cross_renamed(spark, sf):
    return joins.cross_join(_t(spark, sf, "region"), _t(spark, sf, "nation"),
                            ["rkey", "rname", "nkey", "nname", "nrkey"])


@query("join_using_one", sql="""
SELECT custkey, c_name, o_orderkey FROM
  (SELECT c_custkey AS custkey, c_name FROM customer) c
  JOIN (SELECT o_custkey AS custkey, o_orderkey FROM orders) o USING (custkey)""")
def join_using_one(spark, sf):
    c = _t(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    o = _o(spark, sf).select(F.col("o_custkey").alias("custkey"), "o_orderkey")
    return joins.join(c, o, "custkey").select("custkey", "c_name", "o_orderkey")


@query("join_using_two", sql="""
WITH b AS (SELECT l_partkey AS partkey, l_suppkey AS suppkey, count(*) AS n, sum(l_quantity) AS qty FROM lineitem GROUP BY 1, 2)
SELECT partkey, suppkey, l_orderkey, l_linenumber, n, qty
FROM (SELECT l_partkey AS partkey, l_suppkey AS suppkey, l_orderkey, l_linenumber FROM lineitem) a JOIN b USING (partkey, suppkey)""")
def join_using_two(spark, sf):
    """Every line with the size of its (part, supplier) group: one row on the right of each key."""
    li = _l(spark, sf)
    keys = [F.col("l_partkey").alias("partkey"), F.col("l_suppkey").alias("suppkey")]
    a = li.select(*keys, "l_orderkey", "l_linenumber")
    b = li.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))
    return joins.join(a, b, ["partkey", "suppkey"], "inner").select("partkey", "suppkey", "l_orderkey", "l_linenumber", "n", "qty")


@query("join_on_expr", sql="""
SELECT o_orderkey, l_orderkey, l_linenumber FROM orders JOIN lineitem
ON o_orderkey = l_orderkey AND l_shipdate > o_orderdate + INTERVAL 60 DAY""")
def join_on_expr(spark, sf):
    o = _o(spark, sf).select("o_orderkey", "o_orderdate")
    li = _l(spark, sf).select("l_orderkey", "l_linenumber", "l_shipdate")
    cond = (o.o_orderkey == li.l_orderkey) & (li.l_shipdate > o.o_orderdate + F.expr("INTERVAL 60 DAYS"))
    return joins.join(o, li, cond).select("o_orderkey", "l_orderkey", "l_linenumber")


@query("join_left_multi", sql="""
SELECT o_orderkey, l_orderkey, l_quantity FROM orders LEFT JOIN lineitem
ON o_orderkey = l_orderkey AND l_linenumber = 1""")
def join_left_multi(spark, sf):
    o = _o(spark, sf).select("o_orderkey")
    li = _l(spark, sf).select("l_orderkey", "l_linenumber", "l_quantity")
    return joins.join(o, li, (o.o_orderkey == li.l_orderkey) & (li.l_linenumber == 1), "left_outer") \
        .select("o_orderkey", "l_orderkey", "l_quantity")


@query("join_left_nulls", sql="""
WITH per AS (SELECT l_orderkey AS orderkey, count(*) AS lines, sum(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey)
SELECT orderkey, o_orderstatus, coalesce(lines, 0) AS lines, coalesce(qty, 0) AS qty,
       CAST(lines IS NULL AS INTEGER) AS no_lines
FROM (SELECT o_orderkey AS orderkey, o_orderstatus FROM orders) o LEFT JOIN per USING (orderkey)""")
def join_left_nulls(spark, sf):
    per = _l(spark, sf).groupBy(F.col("l_orderkey").alias("orderkey")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("qty"))
    o = _o(spark, sf).select(F.col("o_orderkey").alias("orderkey"), "o_orderstatus")
    j = joins.join(o, per, "orderkey", "left_outer").withColumn("no_lines", F.col("lines").isNull().cast("int"))
    return project.null_to_zero(j, ["lines", "qty"]).select(
        "orderkey", "o_orderstatus", F.col("lines").cast("long").alias("lines"),
        F.col("qty").cast("double").alias("qty"), "no_lines")


@query("join_right_on", sql="""
SELECT l_orderkey, l_linenumber, o_orderkey, o_orderstatus FROM lineitem RIGHT JOIN orders ON l_orderkey = o_orderkey""")
def join_right_on(spark, sf):
    li = _l(spark, sf).select("l_orderkey", "l_linenumber")
    o = _o(spark, sf).select("o_orderkey", "o_orderstatus")
    return joins.join(li, o, li.l_orderkey == o.o_orderkey, "right_outer")


@query("join_full_on", sql="""
SELECT a_cust, a_status, a_n, b_cust, b_status, b_n
FROM (SELECT o_custkey AS a_cust, o_orderstatus AS a_status, count(*) AS a_n FROM orders GROUP BY 1, 2) a
FULL OUTER JOIN (SELECT l_suppkey AS b_cust, l_linestatus AS b_status, count(*) AS b_n FROM lineitem GROUP BY 1, 2) b
ON a_cust = b_cust AND a_status = b_status""")
def join_full_on(spark, sf):
    a = _o(spark, sf).groupBy(F.col("o_custkey").alias("a_cust"), F.col("o_orderstatus").alias("a_status")).agg(F.count(F.lit(1)).alias("a_n"))
    b = _l(spark, sf).groupBy(F.col("l_suppkey").alias("b_cust"), F.col("l_linestatus").alias("b_status")).agg(F.count(F.lit(1)).alias("b_n"))
    return joins.join(a, b, (F.col("a_cust") == F.col("b_cust")) & (F.col("a_status") == F.col("b_status")), "full_outer")


@query("join_semi", sql="""
SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def join_semi(spark, sf):
    o, li = _o(spark, sf).select("o_orderkey", "o_custkey"), _l(spark, sf)
    return joins.join(o, li, o.o_orderkey == li.l_orderkey, "left_semi")


@query("join_anti", sql="""
SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def join_anti(spark, sf):
    o, li = _o(spark, sf).select("o_orderkey", "o_custkey"), _l(spark, sf)
    return joins.join(o, li, o.o_orderkey == li.l_orderkey, "left_anti")


@query("join_self", sql="""
SELECT a.n_name AS nation, b.n_name AS peer, a.n_regionkey AS region FROM nation a JOIN nation b
ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey""")
def join_self(spark, sf):
    n = _t(spark, sf, "nation")
    out = joins.self_join(n, (F.col("a.n_regionkey") == F.col("b.n_regionkey")) &
                          (F.col("a.n_nationkey") < F.col("b.n_nationkey")))
    return out.select(F.col("a.n_name").alias("nation"), F.col("b.n_name").alias("peer"),
                      F.col("a.n_regionkey").alias("region"))


@query("join_with_structs", sql="""
SELECT c_custkey AS cust, o_orderkey AS ord, c_nationkey AS nation
FROM customer JOIN orders ON c_custkey = o_custkey""")
def join_with_structs(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    o = _o(spark, sf).select("o_orderkey", "o_custkey")
    pairs = joins.join_with(c, o, lambda t, u: t["c_custkey"] == u["o_custkey"])
    return pairs.select(F.col("_1.c_custkey").alias("cust"), F.col("_2.o_orderkey").alias("ord"),
                        F.col("_1.c_nationkey").alias("nation"))


# ----------------------------------------------------------------- U01–U03
@query("union_all", sql="""
SELECT o_custkey AS key, o_orderdate AS day FROM orders UNION ALL SELECT l_suppkey, l_shipdate FROM lineitem""")
def union_all(spark, sf):
    a = _o(spark, sf).select(F.col("o_custkey").alias("key"), F.col("o_orderdate").alias("day"))
    b = _l(spark, sf).select(F.col("l_suppkey").alias("key"), F.col("l_shipdate").alias("day"))
    return setops.union_all(a, b)


@query("union_distinct", sql="SELECT o_custkey AS key FROM orders UNION SELECT l_suppkey FROM lineitem")
def union_distinct(spark, sf):
    return setops.union_distinct(_o(spark, sf).select(F.col("o_custkey").alias("key")), _l(spark, sf).select(F.col("l_suppkey").alias("key")))


@query("split_complement", sql="""
SELECT 'hit' AS side, count(*) AS n FROM lineitem WHERE coalesce(l_returnflag = 'R', false)
UNION ALL SELECT 'rest', count(*) FROM lineitem WHERE NOT coalesce(l_returnflag = 'R', false)
UNION ALL SELECT 'whole', count(*) FROM lineitem""")
def split_complement(spark, sf):
    li = _l(spark, sf).select("l_returnflag")
    hit, rest = setops.split_complement(li, F.col("l_returnflag") == "R")
    def c(df, name):
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("side"), "n")
    return c(hit, "hit").unionByName(c(rest, "rest")).unionByName(c(li, "whole"))


# ----------------------------------------------------------------- O01–O07
@query("sort_simple", sql="SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey")
def sort_simple(spark, sf):
    return ordering.sort_by(_t(spark, sf, "part").select("p_partkey", "p_retailprice"),
                            F.desc("p_retailprice"), F.asc("p_partkey"))


@query("sort_multi", sql="""
SELECT c_name, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment DESC, c_name, c_acctbal""")
def sort_multi(spark, sf):
    return ordering.sort_by(_t(spark, sf, "customer").select("c_name", "c_mktsegment", "c_acctbal"),
                            F.desc("c_mktsegment"), F.asc("c_name"), F.asc("c_acctbal"))


@query("take_ordered", sql="""
SELECT p_name, p_brand, p_partkey FROM part ORDER BY p_name DESC, p_brand, p_partkey LIMIT 2""")
def take_ordered(spark, sf):
    return ordering.top_n(_t(spark, sf, "part").select("p_name", "p_brand", "p_partkey"), 2,
                          F.desc("p_name"), F.asc("p_brand"), F.asc("p_partkey"))


@query("top_n", sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 2")
def top_n(spark, sf):
    return ordering.top_n(_o(spark, sf).select("o_orderkey", "o_totalprice"), 2,
                          F.desc("o_totalprice"), F.asc("o_orderkey"))


@query("sort_df", sql="""
SELECT c_mktsegment, c_name, c_acctbal FROM customer ORDER BY c_mktsegment DESC, c_name, c_acctbal DESC""")
def sort_df(spark, sf):
    return _t(spark, sf, "customer").select("c_mktsegment", "c_name", "c_acctbal").sort(
        F.col("c_mktsegment").desc(), "c_name", F.col("c_acctbal").desc())


@query("take_n", sql="SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderkey LIMIT 2")
def take_n(spark, sf):
    return ordering.top_n(_o(spark, sf).select("o_orderkey", "o_orderdate"), 2, F.asc("o_orderkey"))


@query("topk_groups", sql="""
SELECT l_suppkey, count(*) AS count FROM lineitem GROUP BY l_suppkey ORDER BY count DESC, l_suppkey LIMIT 10""")
def topk_groups(spark, sf):
    return ordering.top_k_groups(_l(spark, sf), "l_suppkey", 10)
