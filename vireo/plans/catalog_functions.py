"""Scalar, nested and JSON functions (F*), UDFs / metrics / partitioning (X*)
and source-side frames (S05, S08, S25, S26) bound to the given tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vireo.functions import dates, nested
from vireo.functions.text import split_tokens
from vireo.operators import partitioning
from vireo.plans.catalog_aggregate import nested_customers
from vireo.plans.registry import query
from vireo.sources import files
from vireo.sources.tables import table


# ----------------------------------------------------------------- F01–F10
@query("split_words", sql=r"""
SELECT doc_id, len(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '')) AS words
FROM documents""")
def split_words(spark, sf):
    d = table(spark, sf, "documents")
    toks = split_tokens(F.col("text"), r"\s+")
    return d.select("doc_id", F.size(F.filter(toks, lambda x: x != "")).cast("long").alias("words"))


@query("date_parts", sql="""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(month(o_orderdate) AS INTEGER) AS mnth,
       CAST(day(o_orderdate) AS INTEGER) AS dy FROM orders""")
def date_parts(spark, sf):
    # dates as non-padded strings (``1995-1-7``), parsed back with try_to_date
    o = table(spark, sf, "orders")
    s = F.concat_ws("-", F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate"))
    return dates.date_parts(o.select("o_orderkey", s.alias("d")), "d").drop("d")


# ----------------------------------------------------------------- F11–F16
@query("array_index", sql="""
SELECT c_custkey AS id, c_mktsegment AS first_genre, n_name AS second_genre, CAST(NULL AS VARCHAR) AS sixth_genre
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def array_index(spark, sf):
    m = nested_customers(spark, sf)
    return m.select("id", nested.element("genres", 0).alias("first_genre"),
                    nested.element("genres", 1).alias("second_genre"),
                    nested.element("genres", 5).alias("sixth_genre"))


@query("struct_fields", sql="""
SELECT c_custkey AS id, n_name AS Director, c_acctbal AS BoxOfficeUSDMn
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment = 'BUILDING'""")
def struct_fields(spark, sf):
    m = nested_customers(spark, sf)
    return m.where("cast.LeadActor = 'BUILDING'").select("id", "cast.Director", "cast.BoxOfficeUSDMn")


@query("map_values", sql="""
SELECT c_custkey AS id, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS imdb,
       CAST(c_nationkey AS DOUBLE) AS rt, CAST(NULL AS DOUBLE) AS metacritic
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def map_values(spark, sf):
    m = nested_customers(spark, sf)
    return m.select("id", F.col("ratings.imdb").cast("double").alias("imdb"),
                    nested.map_value("ratings", "rt").cast("double").alias("rt"),
                    nested.map_value("ratings", "metacritic").cast("double").alias("metacritic"))


@query("explode_array", sql="""
SELECT genre, c_custkey AS id, c_name AS title FROM customer JOIN nation ON c_nationkey = n_nationkey,
  unnest([c_mktsegment, n_name]) AS t(genre)""")
def explode_array(spark, sf):
    m = nested_customers(spark, sf).select("id", "title", "genres")
    return nested.explode_all(m, "genres", "genre").select("genre", "id", "title")


@query("explode_chain", sql="""
SELECT c_custkey AS id, element, key, CAST(value AS DOUBLE) AS value
FROM customer JOIN nation ON c_nationkey = n_nationkey,
  unnest([c_mktsegment, n_name]) AS g(element),
  unnest([{'key': 'imdb', 'value': CAST(c_acctbal AS DECIMAL(18,2))},
          {'key': 'rt', 'value': CAST(c_nationkey AS DECIMAL(18,2))}]) AS r(kv),
  LATERAL (SELECT kv.key AS key, kv.value AS value)""")
def explode_chain(spark, sf):
    m = nested_customers(spark, sf)
    out = nested.explode_chain(m, "genres", "ratings", keep=("id",))
    return out.select("id", "element", "key", F.col("value").cast("double").alias("value"))


@query("explode_sql", sql="""
SELECT n_name AS director, c_mktsegment AS leadactor, genre, c_custkey AS id
FROM customer JOIN nation ON c_nationkey = n_nationkey, unnest([c_mktsegment, n_name]) AS t(genre)""")
def explode_sql(spark, sf):
    nested_customers(spark, sf).createOrReplaceTempView("vireo_movies_x")
    return spark.sql("SELECT cast.director AS director, cast.leadactor AS leadactor, "
                     "explode(genres) AS genre, id FROM vireo_movies_x")


# ----------------------------------------------------------------- F17–F19
@query("json_path", sql="""
SELECT event_id, json_extract_string(props, '$.k') AS k FROM events""")
def json_path(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", nested.json_path("props", "$.k").alias("k"))


@query("json_parse", sql="""
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def json_parse(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", "props")
    return nested.json_parse(e, "props", "k INT")


@query("json_serialize", sql="""
SELECT event_id, event_type, user_id, value FROM events""")
def json_serialize(spark, sf):
    # serialise whole rows, then parse them back: the round trip must be exact
    e = table(spark, sf, "events").select("event_id", "event_type", "user_id", "value")
    js = nested.json_serialize(e)
    return js.select(F.from_json("json", "event_id BIGINT, event_type STRING, user_id BIGINT, value DOUBLE")
                     .alias("r")).select("r.*")


# ----------------------------------------------------------------- X01–X06
@F.pandas_udf(T.LongType())
def _times_ten(s: pd.Series) -> pd.Series:
    return s * 10


@query("udf_sql", sql="SELECT p_partkey, CAST(p_size * 10 AS BIGINT) AS tensize FROM part")
def udf_sql(spark, sf):
    spark.udf.register("tenudf", _times_ten)
    table(spark, sf, "part").createOrReplaceTempView("vireo_part")
    return spark.sql("SELECT p_partkey, tenudf(CAST(p_size AS BIGINT)) AS tensize FROM vireo_part")


@query("udf_df", sql="SELECT p_partkey, CAST(p_size * 10 AS BIGINT) AS tensize FROM part")
def udf_df(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", _times_ten(F.col("p_size").cast("long")).alias("tensize"))


@query("observe_metrics", sql="SELECT sum(l_quantity) AS qty, count(*) AS rows FROM lineitem")
def observe_metrics(spark, sf):
    """The metrics that were observed while the rows went through."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    observed, obs = partitioning.observe_sums(li, {"qty": "l_quantity"})
    observed.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(obs.get["qty"], obs.get["rows"])], "qty double, rows long")


@query("coalesce_parts", sql="SELECT l_orderkey, true AS fewer FROM lineitem")
def coalesce_parts(spark, sf):
    """Half the partitions without a shuffle (one at least); the rows do not change."""
    li = table(spark, sf, "lineitem").select("l_orderkey").repartition(8, "l_orderkey")
    half = partitioning.coalesce_share(li, 0.5)
    return half.withColumn("fewer", F.spark_partition_id() < F.lit(max(1, li.rdd.getNumPartitions() // 2)))


@query("custom_partition", sql="SELECT p_partkey, p_name, true AS placed FROM part")
def custom_partition(spark, sf):
    """Whether every row lies in the partition that its letter names."""
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    at = partitioning.with_pid(partitioning.partition_by_letter(p, "p_name", ["F", "M", "S"]))
    return at.select("p_partkey", "p_name", (F.col("pid") == partitioning.letter_bucket(F.col("p_name"), ["F", "M", "S"])).alias("placed"))


@query("json_infer", sql="""
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       CASE WHEN event_type = 'purchase' THEN event_type END AS extra FROM events""")
def json_infer(spark, sf):
    """A JSON column parsed with the schema of all its values; one field only some of them have."""
    e = table(spark, sf, "events").select("event_id", "event_type", nested.json_path("props", "$.k").cast("long").alias("k"))
    doc = F.to_json(F.struct("k", F.when(F.col("event_type") == "purchase", F.col("event_type")).alias("extra")))
    docs = e.select("event_id", doc.alias("doc"))
    schema = files.json_column_schema(docs, "doc")
    return docs.select("event_id", F.from_json("doc", schema).alias("j")).select("event_id", F.col("j.k").cast("long").alias("k"), "j.extra")


# ----------------------------------------------------------------- sources
@query("parse_delimited", sql="""
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_nationkey AS nation FROM customer""")
def parse_delimited(spark, sf):
    c = table(spark, sf, "customer")
    header = spark.range(1).select(F.lit("id|name|segment|nation").alias("line"))
    body = c.select(F.concat_ws("|", "c_custkey", "c_name", "c_mktsegment", "c_nationkey").alias("line"))
    return files.parse_delimited(header.unionByName(body), "line", "|",
                                 [("id", "bigint"), ("name", "string"), ("segment", "string"), ("nation", "int")],
                                 header="id|name|segment|nation")


@query("parquet_roundtrip", sql="SELECT c_custkey, c_name, c_acctbal FROM customer")
def parquet_roundtrip(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return files.parquet_roundtrip(c, files.scratch_path(spark, "parquet_roundtrip"))


@query("letter_partition", sql="""
SELECT p_partkey, p_name, CASE WHEN upper(substring(p_name, 1, 1)) <= 'L' THEN 0
                               WHEN upper(substring(p_name, 1, 1)) <= 'S' THEN 1 ELSE 2 END AS partition
FROM part""")
def letter_partition(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    return p.withColumn("partition", partitioning.letter_bucket(F.col("p_name"), ["L", "S"]))


@query("keyed_publish_frame", sql=r"""
SELECT split_part(line, ',', 1) AS key, regexp_replace(line, ',$', '') AS value FROM (
  SELECT concat_ws(',', p_brand, CAST(p_partkey AS VARCHAR), p_name, '') AS line FROM part)""")
def keyed_publish_frame(spark, sf):
    p = table(spark, sf, "part")
    lines = p.select(F.concat_ws(",", "p_brand", "p_partkey", "p_name", F.lit("")).alias("line"))
    return files.keyed_records(lines, "line", ",")
