"""Streaming operators as queries: each reads a table as a file stream until
its data is used up (``availableNow``), writes every micro-batch to a folder
under the session's checkpoint directory, and returns what is stored there."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.plans import catalog_aggregate  # noqa: F401 - registers the oracle of quote_stats
from vireo.plans.catalog_analytics import _WORDS_SQL, word_freq
from vireo.plans.registry import ORACLES, query
from vireo.sources.files import scratch_path
from vireo.sources.tables import table
from vireo.streaming import queries as q
from vireo.streaming.listener import ProgressRecorder
from vireo.streaming.sinks import parquet_append
from vireo.streaming.sources import file_table_stream
from vireo.streaming.stateful import session_updates
from vireo.streaming.windows import sliding_counts


def stream(spark, sf, name) -> DataFrame:
    # a pattern, because the file source takes a plain path for a folder and a table may be one file
    return file_table_stream(spark, f"{sf.rstrip('/')}/{name}.parque[t]", table(spark, sf, name).schema)


def _events(spark, sf) -> DataFrame:
    """Event time must be a TIMESTAMP for a watermark."""
    return stream(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _naive(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def _folder(spark) -> str:
    return scratch_path(spark, f"stream-{uuid.uuid4().hex}")


def finished(df: DataFrame, mode: str, batch_column: str | None = None) -> DataFrame:
    """Rows that the stream wrote: those of all batches (append, update) or the last full result (complete).
    ``batch_column`` adds the id of the batch that wrote a row."""
    spark, folder = df.sparkSession, _folder(df.sparkSession)

    def store(batch: DataFrame, batch_id: int) -> None:
        # complete: one folder that each batch replaces; else one folder a batch, replaced by a replay
        name = "all" if mode == "complete" else f"batch={int(batch_id)}"
        out = batch.withColumn(batch_column, F.lit(int(batch_id)).cast("long")) if batch_column else batch
        out.write.mode("overwrite").parquet(f"{folder}/data/{name}")

    run = (df.writeStream.foreachBatch(store).outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint")
           .trigger(availableNow=True).start())
    q.await_all(spark, [run])
    schema = df.withColumn(batch_column, F.lit(0).cast("long")).schema if batch_column else df.schema
    return spark.read.schema(schema).parquet(f"{folder}/data/*")


def last_values(out: DataFrame, keys: list[str], batch_column: str) -> DataFrame:
    """The row that the last batch wrote for each key: running values may fall, so the largest need not be the last."""
    values = [c for c in out.columns if c not in (*keys, batch_column)]
    last = out.groupBy(*keys).agg(F.max_by(F.struct(*values), batch_column).alias("_last"))
    return last.select(*keys, *[F.col("_last")[c].alias(c) for c in values])


# ----------------------------------------------------------------- R01 / R02
def _per_batch(df: DataFrame, fn, schema: str) -> DataFrame:
    spark, folder = df.sparkSession, _folder(df.sparkSession)
    q.await_all(spark, [q.per_batch(df, fn, f"{folder}/data", f"{folder}/checkpoint", {"availableNow": True})])
    return spark.read.schema(schema).parquet(f"{folder}/data/*")


@query("stream_batch_words", sql=_WORDS_SQL + "SELECT word, count(*) AS count FROM w WHERE word <> '' GROUP BY word")
def stream_batch_words(spark, sf):
    """Counts per micro-batch, added up over the batches."""
    out = _per_batch(stream(spark, sf, "documents"), lambda b: q.batch_word_counts(b, "text"), "word string, count long")
    return out.groupBy("word").agg(F.sum("count").alias("count"))


@query("stream_batch_sums", sql="SELECT l_suppkey, sum(l_quantity) AS qty, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM lineitem GROUP BY 1")
def stream_batch_sums(spark, sf):
    """R02."""
    out = _per_batch(stream(spark, sf, "lineitem"), lambda b: q.batch_sums(b, "l_suppkey", ["l_quantity", "l_linenumber"]),
                     "l_suppkey long, sum_l_quantity double, sum_l_linenumber long")
    return out.groupBy("l_suppkey").agg(F.sum("sum_l_quantity").alias("qty"), F.sum("sum_l_linenumber").alias("lines"))


# ----------------------------------------------------------------- R04–R07
@query("stream_word_count", sql=_WORDS_SQL + "SELECT word, count(*) AS count FROM w WHERE word <> '' GROUP BY word")
def stream_word_count(spark, sf):
    """Running counts, complete mode."""
    return finished(q.running_word_count(stream(spark, sf, "documents"), "text"), "complete")


_SLIDING_SQL = """
WITH s AS (
  SELECT event_type, ts, time_bucket(INTERVAL '10 minutes', ts) - i * INTERVAL '10 minutes' AS start
  FROM events, unnest(generate_series(0, 1)) AS g(i)),
c AS (SELECT start AS window_start, start + INTERVAL '20 minutes' AS window_end, event_type, count(*) AS count
      FROM s WHERE start <= ts AND ts < start + INTERVAL '20 minutes' GROUP BY 1, 2, 3)
"""


@query("stream_window_counts", sql=_SLIDING_SQL + "SELECT * FROM c")
def stream_window_counts(spark, sf):
    """Sliding windows, update mode: the last count of each window stands."""
    e = _events(spark, sf).withWatermark("ts", "30 days")
    out = finished(sliding_counts(e, "ts", "20 minutes", "10 minutes", ["event_type"]), "update")
    out = out.groupBy("window_start", "window_end", "event_type").agg(F.max("count").alias("count"))
    return _naive(out, "window_start", "window_end")


@query("stream_window_closed", sql=_SLIDING_SQL + """
SELECT * FROM c WHERE window_end <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL '5 minutes' FROM events)""")
def stream_window_closed(spark, sf):
    """Append mode: only windows that the watermark has passed."""
    e = _events(spark, sf).withWatermark("ts", "5 minutes")
    return _naive(finished(sliding_counts(e, "ts", "20 minutes", "10 minutes", ["event_type"]), "append"), "window_start", "window_end")


# ----------------------------------------------------------------- R08–R11
def _quotes(spark, sf) -> DataFrame:
    li = stream(spark, sf, "lineitem")
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice")
    return li.join(part, li.l_partkey == part.p_partkey).select(
        F.col("p_brand").alias("symbol"), F.col("l_quantity").alias("qty"), F.col("l_shipdate").cast("timestamp").alias("ts"))


def _full_quotes(spark, sf) -> DataFrame:
    """The frame of ``plans.quotes.quotes`` over a stream of lineitem, with its time."""
    li = stream(spark, sf, "lineitem")
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice")
    return li.join(part, li.l_partkey == part.p_partkey).select(
        F.col("p_brand").alias("symbol"), F.col("p_retailprice").alias("close"), F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").alias("value"), F.col("l_shipdate").cast("timestamp").alias("ts"))


@query("stream_quote_stats", sql=ORACLES["quote_stats"])
def stream_quote_stats(spark, sf):
    """Quote statistics, complete mode."""
    return finished(q.quote_stats_stream(_full_quotes(spark, sf)), "complete")


@query("stream_quote_stats_watermark", sql=ORACLES["quote_stats"])
def stream_quote_stats_watermark(spark, sf):
    """With a watermark, update mode; the key has no event time, so no row is late."""
    out = finished(q.quote_stats_stream(_full_quotes(spark, sf), ts="ts", watermark="30 seconds"), "update", "_batch")
    return last_values(out, ["symbol"], "_batch")


@query("stream_keyed_sums", sql="""
SELECT p_brand AS symbol, sum(l_quantity) AS sum_qty FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def stream_keyed_sums(spark, sf):
    """Keyed sums, update mode; the key has no event time, so its state is one row per symbol."""
    return last_values(finished(q.keyed_sums(_quotes(spark, sf), "symbol", ["qty"]), "update", "_batch"), ["symbol"], "_batch")


@query("stream_symbol_filter", sql="""
SELECT p_brand AS symbol, sum(l_quantity) AS sum_qty FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#11', 'Brand#12') GROUP BY 1""")
def stream_symbol_filter(spark, sf):
    """A key list before the state, in one output partition (at most as many rows as keys)."""
    picked = _quotes(spark, sf).where(F.col("symbol").isin("Brand#1", "Brand#2", "Brand#11", "Brand#12"))
    return finished(q.keyed_sums(picked, "symbol", ["qty"]), "complete").coalesce(1)


# ----------------------------------------------------------------- R16 / J16 / S23
@query("stream_sessions", sql="""
WITH o AS (SELECT user_id, ts, value, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
f AS (SELECT *, CASE WHEN prev IS NULL OR ts - prev > INTERVAL '30 minutes' THEN 1 ELSE 0 END AS brk FROM o),
s AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM f)
SELECT CAST(user_id AS VARCHAR) AS key, min(ts) AS session_start, max(ts) + INTERVAL '30 minutes' AS session_end,
       count(*) AS events, CAST(round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE), 2) AS DOUBLE) AS total
FROM s GROUP BY user_id, sid""")
def stream_sessions(spark, sf):
    """The stateful records; the last one of each session."""
    e = _events(spark, sf).select("user_id", "ts", "value")
    out = finished(session_updates(e, "user_id", "ts", 30 * 60 * 1000, "1 hour", "value"), "append", "_batch")
    last = last_values(out.select("key", "session_start", "session_end", "events", "total", "_batch"), ["key", "session_start"], "_batch")
    return _naive(last, "session_start", "session_end").withColumn("total", F.round("total", 2))


@query("stream_static_join", sql=r"""
WITH w AS (SELECT unnest(regexp_split_to_array(lower(text), '\s+')) AS word FROM documents),
b AS (SELECT unnest(regexp_split_to_array(lower(text), '\s+')) AS word FROM benchmark),
f AS (SELECT word, count(*) AS freq FROM b WHERE word <> '' GROUP BY word)
SELECT w.word, coalesce(max(f.freq), 0) AS freq, count(*) AS count, coalesce(max(f.freq), 0) * count(*) AS wtdfreq
FROM w LEFT JOIN f ON w.word = f.word WHERE w.word <> '' GROUP BY 1""")
def stream_static_join(spark, sf):
    """J16 on a stream, complete mode."""
    return finished(q.stream_static_weighted(stream(spark, sf, "documents"), word_freq(spark, sf), "text"), "complete")


@query("stream_file_sink", sql="SELECT event_id, event_type, user_id FROM events")
def stream_file_sink(spark, sf):
    """The exactly-once file sink, read back through its log."""
    folder = _folder(spark)
    e = stream(spark, sf, "events").select("event_id", "event_type", "user_id")
    q.await_all(spark, [parquet_append(e, f"{folder}/data", f"{folder}/checkpoint", {"availableNow": True})])
    return spark.read.schema(e.schema).parquet(f"{folder}/data")


# ----------------------------------------------------------------- R03 / R13 / R14 / R16
def _rows_read(run) -> int:
    return sum(p["numInputRows"] for p in run.recentProgress)


@query("stream_resume", sql="""
SELECT o_orderpriority AS priority, sum(o_orderkey) AS keys, count(*) AS orders,
  (SELECT count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01') AS read_after_restart FROM orders GROUP BY 1""")
def stream_resume(spark, sf):
    """A stateful stream that stops, and goes on from its checkpoint when more files have come.

    The second run finds the offsets and the state of the first, so it reads the new files alone."""
    folder, orders = _folder(spark), table(spark, sf, "orders")
    late = F.col("o_orderdate") >= F.lit("1996-01-01").cast(orders.schema["o_orderdate"].dataType)

    def go_on():
        lines = spark.readStream.schema(orders.schema).parquet(f"{folder}/in")
        sums = lines.groupBy(F.col("o_orderpriority").alias("priority")).agg(F.sum("o_orderkey").alias("keys"), F.count("*").alias("orders"))
        run = (sums.writeStream.foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{folder}/out/batch={int(i)}"))
               .outputMode("complete").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start())
        q.await_all(spark, [run])
        return run

    orders.where(~late).write.parquet(f"{folder}/in")
    first = go_on()
    orders.where(late).write.mode("append").parquet(f"{folder}/in")
    second = go_on()
    last = max(p["batchId"] for run in (first, second) for p in run.recentProgress)
    out = spark.read.parquet(f"{folder}/out/batch={last}")
    return out.withColumn("read_after_restart", F.lit(_rows_read(second)).cast("long"))


@query("stream_progress", sql="""
SELECT CAST(row_number() OVER (ORDER BY event_type) - 1 AS BIGINT) AS batch_id, count(*) AS rows, count(*) AS written FROM events GROUP BY event_type""")
def stream_progress(spark, sf):
    """The listener's rows of a stream that is started again for each event type's files.

    The progress table itself says where to go on: the number of the next batch names the type that is written next."""
    folder, events = _folder(spark), table(spark, sf, "events").select("event_id", "event_type")
    kinds = [r[0] for r in events.select("event_type").distinct().orderBy("event_type").collect()]  # a handful of type names
    recorder = ProgressRecorder()
    spark.streams.addListener(recorder)
    try:
        progress = recorder.drain(spark)
        while (at := 1 + (progress.agg(F.max("batch_id")).first()[0] if progress.head(1) else -1)) < len(kinds):
            events.where(F.col("event_type").eqNullSafe(kinds[at])).write.mode("append").parquet(f"{folder}/in")
            run = parquet_append(spark.readStream.schema(events.schema).parquet(f"{folder}/in"), f"{folder}/out", f"{folder}/checkpoint", {"availableNow": True})
            q.await_all(spark, [run])
            recorder.wait_terminated(str(run.runId))
            progress = progress.union(recorder.drain(spark).where("event = 'progress'"))
    finally:
        spark.streams.removeListener(recorder)
    rows = progress.where("event = 'progress' and rows > 0").groupBy("batch_id").agg(F.sum("rows").alias("rows"))
    # what the file sink's log shows of the same batches
    names = spark.createDataFrame(list(enumerate(kinds)), "batch_id long, event_type string")
    written = spark.read.schema(events.schema).parquet(f"{folder}/out").groupBy("event_type").agg(F.count("*").alias("written"))
    return rows.join(names, "batch_id").join(written, "event_type").select("batch_id", "rows", "written")


@query("stream_several", sql="""
SELECT 'type' AS kind, event_type AS key, count(*) AS n FROM events GROUP BY 2
UNION ALL SELECT 'user', CAST(user_id AS VARCHAR), count(*) FROM events GROUP BY 2""")
def stream_several(spark, sf):
    """Two queries on one source side by side, each with its own checkpoint, awaited together."""
    folder, e = _folder(spark), stream(spark, sf, "events")

    def counts(kind, column):
        out = e.groupBy(F.lit(kind).alias("kind"), F.col(column).cast("string").alias("key")).agg(F.count("*").alias("n"))
        return (out.writeStream.foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{folder}/{kind}")).outputMode("complete")
                .option("checkpointLocation", f"{folder}/checkpoint-{kind}").trigger(availableNow=True).start())

    q.await_all(spark, [counts("type", "event_type"), counts("user", "user_id")])
    return spark.read.parquet(f"{folder}/type").union(spark.read.parquet(f"{folder}/user"))


@query("stream_session_window", sql="""
WITH o AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
f AS (SELECT *, CASE WHEN prev IS NULL OR ts - prev > INTERVAL '30 minutes' THEN 1 ELSE 0 END AS brk FROM o),
s AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM f),
g AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '30 minutes' AS session_end, count(*) AS events FROM s GROUP BY user_id, sid)
SELECT * FROM g WHERE session_end <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL '5 minutes' FROM events)""")
def stream_session_window(spark, sf):
    """Event-time sessions in append mode: a session comes out once the watermark has passed its end.

    A task merges the sessions of its rows before they are shuffled to the state, so a hot user is a few rows a task."""
    conf = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "true")
    try:
        out = finished(q.sessions_stream(_events(spark, sf).select("user_id", "ts"), "ts", "30 minutes", ["user_id"], "5 minutes"), "append")
    finally:
        spark.conf.set(conf, before)
    return _naive(out, "session_start", "session_end")
