"""File, catalog and sequence-file sources as queries: each writes a table in the format, under the
session's checkpoint directory, and reads it back through the library's reader."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.functions.logs import parse_access_log, parse_access_log_strict
from vireo.operators.partitioning import persisted
from vireo.plans import accesslog
from vireo.plans.catalog_analytics import _LOG_SQL
from vireo.plans.registry import query
from vireo.sources import files
from vireo.sources.tables import table


# ----------------------------------------------------------------- S03 / S04
def _order_cells(spark, sf) -> DataFrame:
    """Orders as text cells, some of them dirty: prices of 'P' orders and dates of urgent ones."""
    o = table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("key"),
                    F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.round(F.col("o_totalprice") * 100).cast("long").cast("string")).alias("cents"),
                    F.when(F.col("o_orderpriority") == "1-URGENT", "someday").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
                    F.col("o_orderstatus").alias("status"))


_CELLS_SQL = """
WITH c AS (SELECT o_orderkey AS key, CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) END AS cents,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'someday' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day, o_orderstatus AS status FROM orders)
"""


@query("csv_schema", sql=_CELLS_SQL + """
SELECT key, TRY_CAST(cents AS BIGINT) AS cents, TRY_CAST(day AS DATE) AS day, status,
  CASE WHEN cents = 'n/a' OR day = 'someday' THEN CAST(key AS VARCHAR) || ',' || cents || ',' || day || ',' || status END AS raw FROM c""")
def csv_schema(spark, sf):
    """An enforced schema; dirty cells are NULL and their raw line is kept."""
    path = files.scratch_path(spark, "csv")
    _order_cells(spark, sf).write.csv(path, header=True)
    return files.read_csv_schema(spark, path, "key long, cents long, day date, status string, raw string", corrupt_col="raw")


@query("csv_inferred", sql=_CELLS_SQL + """
SELECT status, count(*) AS n, sum(TRY_CAST(cents AS BIGINT)) AS cents, 'key:bigint cents:string day:string status:string' AS types FROM c GROUP BY status""")
def csv_inferred(spark, sf):
    """Header and types inferred; a column with one dirty cell is text."""
    path = files.scratch_path(spark, "csv")
    _order_cells(spark, sf).write.csv(path, header=True)
    df = files.read_csv_infer(spark, path)
    types = " ".join(f"{n}:{t}" for n, t in df.dtypes).replace("key:int ", "key:bigint ")  # the narrowest type that holds the keys
    return df.groupBy("status").agg(F.count("*").alias("n"), F.sum(F.col("cents").try_cast("long")).alias("cents")).withColumn("types", F.lit(types))


# ----------------------------------------------------------------- S02 / S09
@query("text_gzip", sql=r"""
SELECT line, count(*) AS n FROM (SELECT unnest(string_split_regex(text, '\r\n|\n|\r')) AS line FROM documents) GROUP BY line""")
def text_gzip(spark, sf):
    """Lines written one gzip file a partition, read back and spread before they are counted."""
    path = files.scratch_path(spark, "text")
    lines = table(spark, sf, "documents").select(F.explode(F.split("text", "\r\n|\n|\r")).alias("line"))
    files.write_text(lines, path, ["line"], compression="gzip")
    back = files.read_text(spark, path, partitions=int(spark.conf.get("spark.sql.shuffle.partitions")))
    return back.groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


# ----------------------------------------------------------------- S06 / S07
def _customer_json(spark, sf) -> str:
    """Customers with nation and tags as JSON lines; small balances lack the field."""
    path = files.scratch_path(spark, "json")
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    rows = c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("id"), F.struct(F.col("c_name").alias("name"), F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name")).alias("nation")).alias("who"),
        F.array("c_mktsegment", "n_name").alias("tags"), F.when(F.col("c_acctbal") >= 1000, F.round(F.col("c_acctbal") * 100).cast("long")).alias("cents"))
    rows.write.json(path)
    return path


_JSON_SQL = """
SELECT c_custkey AS id, c_name AS name, n_name AS nation, c_mktsegment AS segment, CASE WHEN c_acctbal >= 1000 THEN CAST(round(c_acctbal * 100) AS BIGINT) END AS cents
FROM customer JOIN nation ON c_nationkey = n_nationkey"""


def _flat(df: DataFrame) -> DataFrame:
    return df.select("id", F.col("who.name").alias("name"), F.col("who.nation.name").alias("nation"), F.get("tags", F.lit(0)).alias("segment"), "cents")


@query("json_file_inferred", sql=_JSON_SQL)
def json_file_inferred(spark, sf):
    """JSON lines, the schema inferred from the files."""
    return _flat(files.read_json(spark, _customer_json(spark, sf)))


@query("json_file_schema", sql=_JSON_SQL)
def json_file_schema(spark, sf):
    """The same files with an explicit nested schema: one pass, and a field that no row has is NULL."""
    schema = "id long, who struct<name: string, nation: struct<key: int, name: string>, title: string>, tags array<string>, cents long"
    return _flat(files.read_json(spark, _customer_json(spark, sf), schema).where("who.title IS NULL"))


# ----------------------------------------------------------------- S11
@query("kv_file", sql="SELECT o_orderkey AS key, o_orderpriority AS value FROM orders WHERE o_orderpriority IS NOT NULL")
def kv_file(spark, sf):
    """Typed pairs through a Hadoop sequence file."""
    path = files.scratch_path(spark, "kv")
    files.save_kv_file(table(spark, sf, "orders").where("o_orderpriority IS NOT NULL"), "o_orderkey", "o_orderpriority", path)
    return files.load_kv_file(spark, path, schema="key long, value string")


# ----------------------------------------------------------------- S17
@query("catalog_tables", sql="""
SELECT 'managed' AS kind, c_mktsegment AS name, count(*) AS n FROM customer GROUP BY 2
UNION ALL SELECT 'inserted', n_name, 2 * n_nationkey FROM nation
UNION ALL SELECT 'kept', n_name, n_nationkey FROM nation
UNION ALL SELECT 'dropped', 'managed', 0 UNION ALL SELECT 'dropped', 'external', 0""")
def catalog_tables(spark, sf):
    """A managed and an external table in the session's catalog; INSERT; a dropped external table keeps its files."""
    tag, place = uuid.uuid4().hex[:12], files.scratch_path(spark, "external")
    managed, external = f"vireo_managed_{tag}", f"vireo_external_{tag}"
    files.save_table(table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("name")).agg(F.count("*").alias("n")), managed)
    files.create_external_table(spark, external, "name STRING, n BIGINT", place)
    try:
        spark.sql(f"INSERT INTO {external} SELECT n_name, CAST(n_nationkey AS BIGINT) FROM {{nation}}", nation=table(spark, sf, "nation"))
        spark.sql(f"INSERT INTO {managed} SELECT concat('+', name), 2 * n FROM {external}")
        both = files.read_table(spark, managed)
        own = both.select(F.when(F.col("name").startswith("+"), "inserted").otherwise("managed").alias("kind"), F.ltrim("name", F.lit("+")).alias("name"), "n")
        own = files.parquet_roundtrip(own, files.scratch_path(spark, "managed"))
    finally:
        for name in (managed, external):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    kept = spark.read.schema("name string, n long").parquet(place).select(F.lit("kept").alias("kind"), "name", "n")
    left = [("dropped", kind, int(spark.catalog.tableExists(name))) for kind, name in (("managed", managed), ("external", external))]
    return own.union(kept).union(spark.createDataFrame(left, "kind string, name string, n long"))


# ----------------------------------------------------------------- K02 / X07 / F06
@query("log_report", sql=_LOG_SQL + """
SELECT 'size_stats' AS report, 'min' AS key, min(size) AS value FROM ev UNION ALL SELECT 'size_stats', 'max', max(size) FROM ev UNION ALL SELECT 'size_stats', 'avg', CAST(floor(avg(size)) AS BIGINT) FROM ev
UNION ALL SELECT 'status_counts', status, count(*) FROM ev GROUP BY 2
UNION ALL SELECT * FROM (SELECT 'hosts_over', host, count(*) AS n FROM ev GROUP BY 2 HAVING count(*) > 10 ORDER BY n DESC, host LIMIT 20)
UNION ALL SELECT * FROM (SELECT 'top_endpoints', endpoint, count(*) AS n FROM ev GROUP BY 2 ORDER BY n DESC, endpoint LIMIT 10)
UNION ALL SELECT 'unique_hosts', 'all', count(DISTINCT host) FROM ev
UNION ALL SELECT 'daily_hosts', CAST(day AS VARCHAR), count(DISTINCT host) FROM ev GROUP BY 2
UNION ALL SELECT 'daily_requests', CAST(day AS VARCHAR), count(*) FROM ev GROUP BY 2
UNION ALL SELECT 'avg_requests', CAST(day AS VARCHAR), count(*) // count(DISTINCT host) FROM ev GROUP BY 2
UNION ALL SELECT 'bad_count', 'all', count(*) FROM ev WHERE status = '404'
UNION ALL SELECT * FROM (SELECT 'bad_hosts', host, count(*) AS n FROM ev WHERE status = '404' GROUP BY 2 ORDER BY n DESC, host LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'bad_endpoints', endpoint, count(*) AS n FROM ev WHERE status = '404' GROUP BY 2 ORDER BY n DESC, endpoint LIMIT 5)""")
def log_report(spark, sf):
    """Eleven results over one persisted parse, stored as one long table before the parse is released."""
    path = files.scratch_path(spark, "report")
    with persisted(parse_access_log(accesslog.lines_from_events(spark, sf))) as logs:
        parts = accesslog.report(logs)
        stats = parts["size_stats"].select(F.expr("stack(3, 'min', min_size, 'max', max_size, 'avg', CAST(floor(avg_size) AS BIGINT)) AS (key, value)"))
        keyed = {"size_stats": stats}
        for name in ("status_counts", "hosts_over", "top_endpoints", "daily_hosts", "daily_requests", "avg_requests", "bad_hosts", "bad_endpoints"):
            keyed[name] = parts[name].toDF("key", "value")
        for name in ("unique_hosts", "bad_count"):
            keyed[name] = parts[name].select(F.lit("all"), "*").toDF("key", "value")
        rows = [df.select(F.lit(name).alias("report"), F.col("key").cast("string").alias("key"), F.col("value").cast("long").alias("value")) for name, df in keyed.items()]
        whole = rows[0]
        for more in rows[1:]:
            whole = whole.union(more)
        return files.parquet_roundtrip(whole, path)


@query("log_strict", sql=_LOG_SQL + """
SELECT host AS ipAddress, '-' AS clientIdentity, '-' AS userId, datetime AS dateTime, method, endpoint AS endPoint,
       'HTTP/1.0' AS protocol, status AS responseCode, size AS contentSize FROM ev""")
def log_strict(spark, sf):
    """the strict parse of the lines that are requests; one that does not parse would fail the query."""
    lines = accesslog.lines_from_events(spark, sf)
    return parse_access_log_strict(lines.where(~F.col("value").startswith("junk line ")))
