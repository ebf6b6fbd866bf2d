"""Composite analyses registered as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vireo.functions import text as _text
from vireo.functions.logs import parse_access_log, rejected_lines
from vireo.operators import aggregate as _agg
from vireo.plans import abc, accesslog, retail, supply
from vireo.plans import profile as _profile
from vireo.plans.registry import query
from vireo.plans.standins import line_partitions, money, retail_lines, revenue_by_item
from vireo.sources.files import parquet_roundtrip, scratch_path
from vireo.sources.tables import table

_ABC_ITEMS = """
WITH agg AS (
  SELECT p.p_name AS description, SUM(l.l_quantity) AS total_sales,
         SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS total_revenue
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY p.p_name)
"""


@query("abc_revenue", sql=_ABC_ITEMS + """
, cum AS (SELECT *, SUM(total_revenue) OVER (ORDER BY total_revenue) AS cumrevenue,
                 SUM(total_revenue) OVER () AS tot FROM agg)
SELECT description, CAST(total_sales AS DOUBLE) AS sales, CAST(total_revenue AS DOUBLE) AS trev,
       CAST(cumrevenue AS DOUBLE) AS cumrevenue,
       CAST(cumrevenue AS DOUBLE) * 100 / CAST(tot AS DOUBLE) AS cumper,
       CASE WHEN CAST(cumrevenue AS DOUBLE) / CAST(tot AS DOUBLE) < 0.75 THEN 'A'
            WHEN CAST(cumrevenue AS DOUBLE) / CAST(tot AS DOUBLE) >= 0.75
             AND CAST(cumrevenue AS DOUBLE) / CAST(tot AS DOUBLE) <= 0.95 THEN 'B'
            ELSE 'C' END AS category
FROM cum
""")
def abc_revenue(spark, sf):
    items = revenue_by_item(spark, sf)
    out = abc.abc_classify(items, "total_revenue", "cumrevenue", "category")
    return out.select("description", F.col("total_sales").cast("double").alias("sales"),
                      F.col("total_revenue").cast("double").alias("trev"),
                      F.col("cumrevenue").cast("double").alias("cumrevenue"), "cumper", "category")


@query("abc_sales", sql=_ABC_ITEMS + """
, cum AS (SELECT *, SUM(total_sales) OVER (ORDER BY total_sales) AS cumsales,
                 SUM(total_sales) OVER () AS tot FROM agg)
SELECT description, CAST(total_sales AS DOUBLE) AS sales, CAST(total_revenue AS DOUBLE) AS trev,
       CAST(cumsales AS DOUBLE) AS cumsales,
       CAST(cumsales AS DOUBLE) * 100 / CAST(tot AS DOUBLE) AS cumper,
       CASE WHEN CAST(cumsales AS DOUBLE) / CAST(tot AS DOUBLE) < 0.75 THEN 'A'
            WHEN CAST(cumsales AS DOUBLE) / CAST(tot AS DOUBLE) >= 0.75
             AND CAST(cumsales AS DOUBLE) / CAST(tot AS DOUBLE) <= 0.95 THEN 'B'
            ELSE 'C' END AS categorysales
FROM cum
""")
def abc_sales(spark, sf):
    items = revenue_by_item(spark, sf)
    out = abc.abc_classify(items, "total_sales", "cumsales", "categorysales")
    return out.select("description", F.col("total_sales").cast("double").alias("sales"),
                      F.col("total_revenue").cast("double").alias("trev"),
                      F.col("cumsales").cast("double").alias("cumsales"), "cumper", "categorysales")


@query("abc_summary", sql=_ABC_ITEMS + """
, cum AS (SELECT *, SUM(total_revenue) OVER (ORDER BY total_revenue) AS cumrevenue,
                 SUM(total_revenue) OVER () AS tot, COUNT(*) OVER () AS n FROM agg)
, cat AS (SELECT *, CASE WHEN CAST(cumrevenue AS DOUBLE) / CAST(tot AS DOUBLE) < 0.75 THEN 'A'
            WHEN CAST(cumrevenue AS DOUBLE) / CAST(tot AS DOUBLE) >= 0.75
             AND CAST(cumrevenue AS DOUBLE) / CAST(tot AS DOUBLE) <= 0.95 THEN 'B'
            ELSE 'C' END AS category FROM cum)
SELECT category, COUNT(*) AS catcount, CAST(SUM(total_revenue) AS DOUBLE) AS catrev,
       COUNT(*) / MAX(n) * 100 AS countper,
       CAST(SUM(total_revenue) AS DOUBLE) / CAST(MAX(tot) AS DOUBLE) * 100 AS revenueper
FROM cat GROUP BY category
""")
def abc_summary_q(spark, sf):
    items = revenue_by_item(spark, sf)
    classified = abc.abc_classify(items, "total_revenue", "cumrevenue", "category")
    return abc.abc_summary(classified, "total_revenue", "category")


# ----------------------------------------------------------------- K01 / J16

_WORDS_SQL = r"""
WITH w AS (SELECT unnest(regexp_split_to_array(lower(text), '\s+')) AS word FROM documents)
"""


@query("wordcount", sql=_WORDS_SQL + "SELECT word, count(*) AS count FROM w WHERE word <> '' GROUP BY word")
def wordcount(spark, sf):
    return _text.token_counts(table(spark, sf, "documents"), "text")


@query("wordcount_top20", sql=_WORDS_SQL + """
SELECT word, count(*) AS count FROM w WHERE word <> '' GROUP BY word ORDER BY count DESC, word LIMIT 20""")
def wordcount_top20(spark, sf):
    return _text.top_tokens(table(spark, sf, "documents"), "text", 20)


@query("charcount", sql="""
WITH c AS (SELECT unnest(string_split(text, '')) AS ch FROM documents)
SELECT ch, count(*) AS count FROM c WHERE ch <> '' GROUP BY ch""")
def charcount(spark, sf):
    return _text.token_counts(table(spark, sf, "documents"), "text", unit="char", lower=False, out="ch")


def word_freq(spark, sf):
    """Static side of the stream–static join: word frequencies of ``benchmark``."""
    return _text.token_counts(table(spark, sf, "benchmark"), "text").withColumnRenamed("count", "freq")


def weighted_counts(words, freq):
    """Words ⟕ static frequencies, missing freq → 0, count per
    (word, freq), weighted by freq.

    ``freq`` has one row per word, so counting words first and joining the
    counts is the same result; the partial aggregate collapses a very common
    word before any shuffle, and the join then moves one row per distinct
    word instead of one per occurrence.  On a stream it runs in complete mode.
    """
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    j = counted.join(freq, "word", "left_outer").fillna(0, subset=["freq"])
    return j.select("word", "freq", "count", (F.col("freq") * F.col("count")).alias("wtdfreq"))


@query("static_join_batch", sql=r"""
WITH w AS (SELECT unnest(regexp_split_to_array(lower(text), '\s+')) AS word FROM documents),
b AS (SELECT unnest(regexp_split_to_array(lower(text), '\s+')) AS word FROM benchmark),
f AS (SELECT word, count(*) AS freq FROM b WHERE word <> '' GROUP BY word),
j AS (SELECT w.word, coalesce(f.freq, 0) AS freq FROM w LEFT JOIN f ON w.word = f.word WHERE w.word <> '')
SELECT word, freq, count(*) AS count, freq * count(*) AS wtdfreq FROM j GROUP BY word, freq""")
def static_join_batch(spark, sf):
    words = _text.tokens(table(spark, sf, "documents"), "text")
    return weighted_counts(words, word_freq(spark, sf))


# ----------------------------------------------------------------- K02
_LOG_SQL = """
WITH ev AS (
  SELECT 'host' || CAST(user_id AS VARCHAR) AS host,
         '/' || event_type || '/item' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS endpoint,
         CASE WHEN event_type = 'error' THEN '404' ELSE '200' END AS status,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method,
         strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000' AS datetime,
         CASE WHEN event_type = 'signup' THEN 0 ELSE CAST(round(value * 100) AS BIGINT) END AS size,
         CAST(day(ts) AS INTEGER) AS day
  FROM events WHERE NOT (event_type = 'view' AND value < 2))
"""


def _logs(spark, sf):
    return parse_access_log(accesslog.lines_from_events(spark, sf))


@query("parse_access_log", sql=_LOG_SQL + """
SELECT host AS ipAddress, '-' AS clientIdentity, '-' AS userId, datetime AS dateTime, method, endpoint AS endPoint,
       'HTTP/1.0' AS protocol, status AS responseCode, size AS contentSize FROM ev""")
def parse_access_log_q(spark, sf):
    return _logs(spark, sf)


@query("log_rejected", sql="SELECT count(*) AS rejected FROM events WHERE event_type = 'view' AND value < 2")
def log_rejected(spark, sf):
    return rejected_lines(accesslog.lines_from_events(spark, sf)).agg(F.count(F.lit(1)).alias("rejected"))


@query("log_bad_records", sql=_LOG_SQL + """
SELECT host AS ipAddress, datetime AS dateTime, method, endpoint AS endPoint, status AS responseCode, size AS contentSize
FROM ev WHERE status = '404'""")
def log_bad_records(spark, sf):
    """The 404 lines, saved and read back."""
    bad = accesslog.report(_logs(spark, sf))["bad_records"].select("ipAddress", "dateTime", "method", "endPoint", "responseCode", "contentSize")
    return parquet_roundtrip(bad, scratch_path(spark, "log_bad_records"))


@query("log_size_stats", sql=_LOG_SQL + """
SELECT avg(size) AS avg_size, min(size) AS min_size, max(size) AS max_size FROM ev""")
def log_size_stats(spark, sf):
    return accesslog.size_stats(_logs(spark, sf))


@query("log_status_counts", sql=_LOG_SQL + "SELECT status AS responseCode, count(*) AS count FROM ev GROUP BY 1")
def log_status_counts(spark, sf):
    return accesslog.status_counts(_logs(spark, sf))


@query("log_hosts_over", sql=_LOG_SQL + """
SELECT host AS ipAddress, count(*) AS count FROM ev GROUP BY 1 HAVING count(*) > 10
ORDER BY count DESC, ipAddress LIMIT 20""")
def log_hosts_over(spark, sf):
    return accesslog.hosts_over(_logs(spark, sf), 10, 20)


@query("log_top_endpoints", sql=_LOG_SQL + """
SELECT endpoint AS endPoint, count(*) AS count FROM ev GROUP BY 1 ORDER BY count DESC, endPoint LIMIT 10""")
def log_top_endpoints(spark, sf):
    return accesslog.top_endpoints(_logs(spark, sf), 10)


@query("log_unique_hosts", sql=_LOG_SQL + "SELECT count(DISTINCT host) AS hosts FROM ev")
def log_unique_hosts(spark, sf):
    return accesslog.unique_hosts(_logs(spark, sf))


@query("log_daily_hosts", sql=_LOG_SQL + "SELECT day, count(DISTINCT host) AS hosts FROM ev GROUP BY day")
def log_daily_hosts(spark, sf):
    return accesslog.daily_hosts(_logs(spark, sf))


@query("log_daily_requests", sql=_LOG_SQL + "SELECT day, count(*) AS requests FROM ev GROUP BY day")
def log_daily_requests(spark, sf):
    return accesslog.daily_requests(_logs(spark, sf))


@query("log_avg_requests", sql=_LOG_SQL + """
SELECT day, CAST(count(*) // count(DISTINCT host) AS BIGINT) AS avg_requests FROM ev GROUP BY day""")
def log_avg_requests(spark, sf):
    return accesslog.avg_requests_per_host(_logs(spark, sf))


@query("log_bad_count", sql=_LOG_SQL + "SELECT count(*) AS bad FROM ev WHERE status = '404'")
def log_bad_count(spark, sf):
    return accesslog.bad_count(_logs(spark, sf))


@query("log_bad_hosts", sql=_LOG_SQL + """
SELECT host AS ipAddress, count(*) AS count FROM ev WHERE status = '404' GROUP BY 1
ORDER BY count DESC, ipAddress LIMIT 5""")
def log_bad_hosts(spark, sf):
    return accesslog.bad_hosts(_logs(spark, sf))


@query("log_bad_endpoints", sql=_LOG_SQL + """
SELECT endpoint AS endPoint, count(*) AS count FROM ev WHERE status = '404' GROUP BY 1
ORDER BY count DESC, endPoint LIMIT 5""")
def log_bad_endpoints(spark, sf):
    return accesslog.bad_endpoints(_logs(spark, sf))


# ----------------------------------------------------------------- K03
@query("salted_sum", sql="""
SELECT CASE WHEN l_returnflag = 'N' THEN 0 ELSE l_suppkey END AS key, sum(l_quantity) AS total
FROM lineitem GROUP BY 1""")
def salted_sum(spark, sf):
    # one key (returnflag N → supplier 0) holds about a third of all rows
    li = table(spark, sf, "lineitem")
    skewed = li.select(F.when(F.col("l_returnflag") == "N", F.lit(0).cast("long"))
                       .otherwise(F.col("l_suppkey")).alias("key"),
                       "l_quantity", "l_orderkey", "l_linenumber", "l_partkey")
    return _agg.salted_sum(skewed, "key", "l_quantity", salts=10,
                           salt_by=["l_orderkey", "l_linenumber", "l_partkey"])


# ----------------------------------------------------------------- K05 / K06 / J15
_SHIP_SQL = """
WITH sh AS (
  SELECT s_suppkey AS vendorkey, s_name AS vendor, n_name AS country, p_type AS moleculetesttype,
         l_quantity AS wkg, CAST(l_extendedprice AS DECIMAL(18,2)) AS litemval,
         CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)) AS frtcost,
         CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)) AS inscost
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey)
"""


@query("vendor_cost", sql=_SHIP_SQL + """
, g AS (SELECT moleculetesttype, vendor, sum(wkg) AS totqty, CAST(sum(litemval) AS DOUBLE) AS totvalue,
               CAST(sum(frtcost) AS DOUBLE) AS totshippingcost, CAST(sum(inscost) AS DOUBLE) AS insurcost
        FROM sh GROUP BY 1, 2)
SELECT *, totqty + totvalue + totshippingcost + insurcost AS totalcost FROM g""")
def vendor_cost(spark, sf):
    return supply.vendor_cost(supply.shipments(spark, sf, with_country=False))


@query("join_aggregates", sql=_SHIP_SQL + """
, d AS (SELECT country, moleculetesttype, sum(wkg) AS demand FROM sh GROUP BY 1, 2)
, c AS (SELECT country, moleculetesttype, vendor, count(*) AS noorders FROM sh GROUP BY 1, 2, 3)
SELECT country, moleculetesttype, demand, vendor, noorders FROM d JOIN c USING (country, moleculetesttype)""")
def join_aggregates(spark, sf):
    # one aggregate over the shipments; demand is summed from it
    per = supply.shipments(spark, sf).groupBy("country", "moleculetesttype", "vendor").agg(
        F.count(F.lit(1)).alias("noorders"), F.sum("weightkilograms").alias("w"))
    d = per.groupBy("country", "moleculetesttype").agg(F.sum("w").alias("demand"))
    return d.join(per, ["country", "moleculetesttype"]).select(
        "country", "moleculetesttype", "demand", "vendor", "noorders")


@query("eoq_tlc", sql=_SHIP_SQL + """
, d AS (SELECT country, moleculetesttype, sum(wkg) AS demand FROM sh GROUP BY 1, 2)
, c AS (SELECT vendorkey, vendor, country, moleculetesttype, count(*) AS noorders, sum(wkg) AS vsupply,
               CAST(sum(litemval) AS DOUBLE) AS itemcost, CAST(sum(frtcost) + sum(inscost) AS DOUBLE) AS tordercost
        FROM sh GROUP BY 1, 2, 3, 4)
, x AS (SELECT *, vsupply / noorders AS batchsize, tordercost / noorders AS ordercost,
               (1 + vendorkey % 9) / 10.0 AS rhc FROM c)
, e AS (SELECT x.*, demand, 2 * sqrt(demand * ordercost / (rhc * batchsize)) AS eoq FROM d JOIN x USING (country, moleculetesttype))
SELECT vendor, country, moleculetesttype, demand, ordercost, batchsize, rhc, eoq,
       (CASE WHEN eoq = 0 THEN NULL ELSE demand / eoq END) * ordercost + eoq / 2 * rhc * batchsize
       + (CASE WHEN vsupply = 0 THEN NULL ELSE itemcost / vsupply END) * demand AS tlc
FROM e""")
def eoq_tlc(spark, sf):
    return supply.eoq_tlc(supply.shipments(spark, sf))


# ----------------------------------------------------------------- K07
_PROFILE_SQL = """
WITH dp AS (
  SELECT p_partkey, nullif(p_size, 1) AS size,
         CASE WHEN p_type = 'SMALL' THEN NULL ELSE CAST(round(p_retailprice * 100) AS BIGINT) END AS cents
  FROM part),
long AS (SELECT 'p_partkey' AS "column", CAST(p_partkey AS DOUBLE) AS v FROM dp
         UNION ALL SELECT 'size', CAST(size AS DOUBLE) FROM dp
         UNION ALL SELECT 'cents', CAST(cents AS DOUBLE) FROM dp),
freq AS (SELECT "column", v, count(*) AS n FROM long WHERE v IS NOT NULL GROUP BY 1, 2),
mode AS (SELECT "column", first(v ORDER BY n DESC, v ASC) AS mode FROM freq GROUP BY 1)
SELECT l."column", count(*) AS rows, count(*) - count(v) AS nulls, avg(v) AS mean,
       round(stddev_samp(v), 6) AS stddev, quantile_cont(v, 0.5) AS median, max(mode) AS mode
FROM long l JOIN mode m ON l."column" = m."column" GROUP BY l."column"
"""


@query("profile_table", sql=_PROFILE_SQL)
def profile_table(spark, sf):
    from vireo.plans.catalog_relational import dirty_part
    dp = dirty_part(spark, sf).select("p_partkey", "size", "cents")
    return _profile.profile(dp).withColumn("stddev", F.round("stddev", 6))


# ----------------------------------------------------------------- R05 / R16 batch twins
@query("window_sliding", sql="""
WITH s AS (
  SELECT event_type, ts, time_bucket(INTERVAL '10 minutes', ts) - i * INTERVAL '10 minutes' AS start
  FROM events, unnest(generate_series(0, 1)) AS g(i))
SELECT start AS window_start, start + INTERVAL '20 minutes' AS window_end, event_type, count(*) AS count
FROM s WHERE start <= ts AND ts < start + INTERVAL '20 minutes' GROUP BY 1, 2, 3""")
def window_sliding(spark, sf):
    from vireo.streaming.windows import sliding_counts
    e = table(spark, sf, "events")
    return sliding_counts(e, "ts", "20 minutes", "10 minutes", ["event_type"])


@query("session_summary", sql="""
WITH o AS (SELECT user_id, ts, value, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
f AS (SELECT *, CASE WHEN prev IS NULL OR ts - prev > INTERVAL '30 minutes' THEN 1 ELSE 0 END AS brk FROM o),
s AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM f)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '30 minutes' AS session_end,
       count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM s GROUP BY user_id, sid""")
def session_summary(spark, sf):
    from vireo.operators.sessions import sessions
    e = table(spark, sf, "events").select("user_id", "ts", money("value").alias("value"))
    return sessions(e, "ts", "30 minutes", ["user_id"], "value").withColumn("total", F.col("total").cast("double"))


# ----------------------------------------------------------------- K08
_YEARS = tuple(range(1992, 1999))
_RETAIL_SQL = """
WITH r AS (
  SELECT DISTINCT l_orderkey AS invoice, p_name AS description, p_type AS stockcode, l_quantity AS quantity, p_retailprice AS price,
         l_extendedprice AS amount, o_orderdate AS invoicedate, n_name AS country
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey),
d AS (SELECT *, CAST(year(invoicedate) AS INTEGER) AS yr, CAST(month(invoicedate) AS INTEGER) AS mnth,
             CAST(quantity AS DECIMAL(18,2)) * CAST(price AS DECIMAL(18,2)) AS rev FROM r)
"""


def _retail(spark, sf, name):
    return retail.explore(retail_lines(spark, sf), _YEARS, line_partitions(spark, sf))[name]


def _as_double(df):
    return df.withColumn("revenue", F.col("revenue").cast("double"))


@query("retail_nulls", sql=_RETAIL_SQL + "SELECT count(*) AS nulls FROM d WHERE description IS NULL")
def retail_nulls(spark, sf):
    return _retail(spark, sf, "description_nulls")


@query("retail_country_revenue", sql=_RETAIL_SQL + "SELECT country, CAST(sum(rev) AS DOUBLE) AS revenue FROM d GROUP BY 1")
def retail_country_revenue(spark, sf):
    return _as_double(_retail(spark, sf, "country_revenue"))


@query("retail_country_means", sql=_RETAIL_SQL + """
SELECT country, avg(quantity) AS avg_quantity, round(avg(price), 6) AS avg_price FROM d GROUP BY 1""")
def retail_country_means(spark, sf):
    return _retail(spark, sf, "country_means").withColumn("avg_price", F.round("avg_price", 6))


@query("retail_country_items", sql=_RETAIL_SQL + "SELECT count(*) AS pairs FROM (SELECT DISTINCT country, description FROM d)")
def retail_country_items(spark, sf):
    return _retail(spark, sf, "country_item_pairs")


_PIVOT = ", ".join(f'sum(quantity) FILTER (WHERE yr = {y}) AS "{y}"' for y in _YEARS)


@query("retail_pivot", sql=_RETAIL_SQL + f"SELECT country, {_PIVOT} FROM d GROUP BY 1")
def retail_pivot(spark, sf):
    return _retail(spark, sf, "pivot_year_quantity")


@query("retail_unpivot", sql=_RETAIL_SQL + f"""
SELECT country, CAST(y AS VARCHAR) AS yr, (SELECT sum(quantity) FROM d WHERE d.country = c.country AND d.yr = y) AS quantity
FROM (SELECT DISTINCT country FROM d) c, range({_YEARS[0]}, {_YEARS[-1] + 1}) AS t(y)""")
def retail_unpivot(spark, sf):
    return _retail(spark, sf, "unpivot_year_quantity")


_BY_TIME = "CAST(sum(rev) AS DOUBLE) AS revenue, CAST(grouping(country, yr, mnth) AS BIGINT) AS gid FROM d GROUP BY"


@query("retail_cube", sql=_RETAIL_SQL + f"SELECT country, yr, mnth, {_BY_TIME} CUBE (country, yr, mnth)")
def retail_cube(spark, sf):
    return _as_double(_retail(spark, sf, "cube"))


@query("retail_rollup", sql=_RETAIL_SQL + f"SELECT country, yr, mnth, {_BY_TIME} ROLLUP (country, yr, mnth)")
def retail_rollup(spark, sf):
    return _as_double(_retail(spark, sf, "rollup"))


@query("retail_grouping_sets", sql=_RETAIL_SQL + f"SELECT country, yr, mnth, {_BY_TIME} GROUPING SETS ((country, yr), (yr, mnth))")
def retail_grouping_sets(spark, sf):
    return _as_double(_retail(spark, sf, "grouping_sets"))


@query("retail_running", sql=_RETAIL_SQL + """
, g AS (SELECT country, description, sum(rev) AS revenue FROM d GROUP BY 1, 2)
SELECT country, description, CAST(revenue AS DOUBLE) AS revenue,
       CAST(sum(revenue) OVER (PARTITION BY country ORDER BY revenue) AS DOUBLE) AS cumrevenue FROM g""")
def retail_running(spark, sf):
    return _as_double(_retail(spark, sf, "running_by_country")).withColumn("cumrevenue", F.col("cumrevenue").cast("double"))
