"""Access-log report — K02 (eleven sub-reports over parsed log lines).

Every sub-report is its own lazy DataFrame over the parsed lines; callers
that run several of them should ``persist`` the parsed lines once (see
``vireo.operators.partitioning.persisted``).  Top-k reports break count ties
by key so they are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.functions.logs import day_of_month
from vireo.sources.tables import table


def lines_from_events(spark: SparkSession, sf: str) -> DataFrame:
    """Log-line stand-in: one common-log-format line per event.

    host = ``host<user_id>``; endpoint = ``/<event_type>/item<floor(value)>``;
    status 404 for ``error`` events, else 200; size ``-`` for ``signup``
    events, else ``round(value*100)``; ``view`` events with value < 2 become
    junk lines that the parser must drop.
    """
    e = table(spark, sf, "events")
    method = F.when(F.col("event_type").isin("purchase", "signup"), F.lit("POST")).otherwise(F.lit("GET"))
    endpoint = F.concat(F.lit("/"), F.col("event_type"), F.lit("/item"),
                        F.floor("value").cast("long").cast("string"))
    status = F.when(F.col("event_type") == "error", F.lit("404")).otherwise(F.lit("200"))
    size = F.when(F.col("event_type") == "signup", F.lit("-")).otherwise(
        F.round(F.col("value") * 100).cast("long").cast("string"))
    when = F.concat(F.lit("["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000]"))
    request = F.concat(F.lit('"'), method, F.lit(" "), endpoint, F.lit(' HTTP/1.0"'))
    line = F.concat_ws(" ", F.concat(F.lit("host"), F.col("user_id").cast("string")), F.lit("-"), F.lit("-"),
                       when, request, status, size)
    junk = (F.col("event_type") == "view") & (F.col("value") < 2)
    return e.select(F.when(junk, F.concat(F.lit("junk line "), F.col("event_id").cast("string")))
                    .otherwise(line).alias("value"))


def size_stats(logs: DataFrame) -> DataFrame:
    return logs.agg(F.avg("contentSize").alias("avg_size"), F.min("contentSize").alias("min_size"),
                    F.max("contentSize").alias("max_size"))


def status_counts(logs: DataFrame) -> DataFrame:
    return logs.groupBy("responseCode").agg(F.count(F.lit(1)).alias("count"))


def _counts(logs: DataFrame, key: str) -> DataFrame:
    return logs.groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def hosts_over(logs: DataFrame, threshold: int = 10, k: int = 20) -> DataFrame:
    """Up to ``k`` hosts with more than ``threshold`` requests, busiest first."""
    c = _counts(logs, "ipAddress").where(F.col("count") > threshold)
    return c.orderBy(F.desc("count"), F.asc("ipAddress")).limit(k)


def top_endpoints(logs: DataFrame, k: int = 10) -> DataFrame:
    return _counts(logs, "endPoint").orderBy(F.desc("count"), F.asc("endPoint")).limit(k)


def unique_hosts(logs: DataFrame) -> DataFrame:
    return logs.select("ipAddress").distinct().agg(F.count(F.lit(1)).alias("hosts"))


def _with_day(logs: DataFrame) -> DataFrame:
    return logs.withColumn("day", day_of_month(F.col("dateTime")))


def daily_hosts(logs: DataFrame) -> DataFrame:
    """Distinct hosts per day (distinct pairs first: a two-stage count)."""
    pairs = _with_day(logs).select("day", "ipAddress").distinct()
    return pairs.groupBy("day").agg(F.count(F.lit(1)).alias("hosts"))


def daily_requests(logs: DataFrame) -> DataFrame:
    return _with_day(logs).groupBy("day").agg(F.count(F.lit(1)).alias("requests"))


def avg_requests_per_host(logs: DataFrame) -> DataFrame:
    """Integer requests-per-host per day (integer division, as the reference):
    requests counted per (day, host) once, then both numbers per day."""
    per = _with_day(logs).groupBy("day", "ipAddress").agg(F.count(F.lit(1)).alias("n"))
    both = per.groupBy("day").agg(F.sum("n").alias("requests"),
                                  F.count(F.lit(1)).alias("hosts"))
    # a null host is one of a day's distinct hosts, as in daily_hosts
    return both.select("day", F.expr("requests div hosts").cast("long").alias("avg_requests"))


def bad_records(logs: DataFrame, code: str = "404") -> DataFrame:
    return logs.where(F.col("responseCode") == code)


def bad_count(logs: DataFrame, code: str = "404") -> DataFrame:
    return bad_records(logs, code).agg(F.count(F.lit(1)).alias("bad"))


def bad_hosts(logs: DataFrame, k: int = 5, code: str = "404") -> DataFrame:
    return _counts(bad_records(logs, code), "ipAddress").orderBy(F.desc("count"), F.asc("ipAddress")).limit(k)


def bad_endpoints(logs: DataFrame, k: int = 5, code: str = "404") -> DataFrame:
    return _counts(bad_records(logs, code), "endPoint").orderBy(F.desc("count"), F.asc("endPoint")).limit(k)


def report(lines: DataFrame, threshold: int = 10) -> dict[str, DataFrame]:
    """All twelve sub-reports (``bad_records`` is what the reference saves) over one parse of the lines.  Wrap the call in
    ``vireo.operators.partitioning.persisted(parse_access_log(lines))`` to
    scan and parse once for all of them, as the reference's cached job does."""
    from vireo.functions.logs import parse_access_log
    logs = parse_access_log(lines) if "contentSize" not in lines.columns else lines
    return {
        "size_stats": size_stats(logs), "status_counts": status_counts(logs),
        "hosts_over": hosts_over(logs, threshold), "top_endpoints": top_endpoints(logs),
        "unique_hosts": unique_hosts(logs), "daily_hosts": daily_hosts(logs),
        "daily_requests": daily_requests(logs), "avg_requests": avg_requests_per_host(logs),
        "bad_records": bad_records(logs), "bad_count": bad_count(logs), "bad_hosts": bad_hosts(logs), "bad_endpoints": bad_endpoints(logs),
    }
