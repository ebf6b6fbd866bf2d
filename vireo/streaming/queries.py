"""Streaming queries — R01–R13, R16, J16, S22–S24.

Each function takes a streaming DataFrame and returns either a streaming
DataFrame (for the caller's ``writeStream``) or a started query.  The
aggregation code is the same function the batch twins use.
"""

from __future__ import annotations

import time
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vireo.functions.text import tokens
from vireo.plans.quotes import quote_stats
from vireo.streaming.windows import session_summary, sliding_counts


def start(df: DataFrame, mode: str, sink: str = "memory", name: str | None = None,
          checkpoint: str | None = None, trigger: dict | None = None, path: str | None = None,
          options: dict | None = None) -> StreamingQuery:
    """Start a query (R12 triggers: ``{"processingTime": "5 seconds"}`` or
    ``{"availableNow": True}``).  The handle is returned, never dropped."""
    w = df.writeStream.outputMode(mode).format(sink)
    if name:
        w = w.queryName(name)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if path:
        w = w.option("path", path)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


# Per-micro-batch results, no state across batches -------------
def per_batch(df: DataFrame, fn: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
              trigger: dict | None = None) -> StreamingQuery:
    """Apply a batch function to every micro-batch and append its result,
    tagged with the batch id, to a parquet folder.  Replays of a batch id
    overwrite that batch's partition, so the output is idempotent."""
    w = df.writeStream.foreachBatch(batch_writer(fn, path)).option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def batch_writer(fn: Callable[[DataFrame], DataFrame], path: str):
    """The ``foreachBatch`` body of :func:`per_batch`: the batch's result goes
    to the ``batch_id=<id>`` folder, replacing what a replay left there, also
    when the replay has no rows."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        fn(batch).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={int(batch_id)}")
    return sink


def batch_word_counts(batch: DataFrame, text_col: str = "value") -> DataFrame:
    return tokens(batch, text_col).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def batch_sums(batch: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    return batch.groupBy(key).agg(*[F.sum(m).alias(f"sum_{m}") for m in measures])


# Running word count (stateful, complete) ---------------------------------
def running_word_count(lines: DataFrame, text_col: str = "value") -> DataFrame:
    return tokens(lines, text_col).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


# Windowed word counts --------------------------------------
def windowed_word_count(lines: DataFrame, ts: str, duration: str, slide: str,
                        text_col: str = "value", watermark: str | None = None) -> DataFrame:
    """Sliding-window word counts.  With ``watermark`` the query can run in
    append mode: a window is emitted once the watermark passes its end and
    later rows for it are dropped, so state stays bounded."""
    w = tokens(lines, text_col, keep=(ts,))
    if watermark:
        w = w.withWatermark(ts, watermark)
    return sliding_counts(w, ts, duration, slide, ["word"])


# Quote statistics --------------------------------------
def quote_stats_stream(quotes: DataFrame, ts: str | None = None, watermark: str | None = None,
                       symbols: Sequence[str] | None = None, window: str | None = None) -> DataFrame:
    """Per-symbol quote statistics on a stream (same aggregates as the batch
    twin).  A watermark without a window keeps state forever (the key has no
    event time); pass ``window`` for bounded state."""
    q = quotes
    if symbols:
        q = q.where(F.col("symbol").isin(list(symbols)))  # R11 filter, before the state
    if watermark and ts:
        q = q.withWatermark(ts, watermark)
    if window and ts:
        return quote_stats(q, [F.window(ts, window).alias("w"), "symbol"])
    return quote_stats(q)


# Stateful keyed sums -----------------------------------------------------
def keyed_sums(records: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    return records.groupBy(key).agg(*[F.sum(m).alias(f"sum_{m}") for m in measures])


# Sessions on a stream ------------------------------------------------
def sessions_stream(events: DataFrame, ts: str, gap: str, keys: Sequence[str], watermark: str,
                    value: str | None = None) -> DataFrame:
    return session_summary(events.withWatermark(ts, watermark), ts, gap, keys, value)


# stream–static join ------------------------------------------------
def stream_static_weighted(lines: DataFrame, freq: DataFrame, text_col: str = "value") -> DataFrame:
    from vireo.plans.catalog_analytics import weighted_counts
    return weighted_counts(tokens(lines, text_col), freq)


# Several queries on one source ---------------------------------------
def await_all(spark: SparkSession, queries: Sequence[StreamingQuery], timeout: float | None = None) -> bool:
    """Wait until every query has ended; False if the timeout (seconds) passes
    first.  All were started before, so none blocks another.  When one fails,
    the others are stopped and its error is raised."""
    until = None if timeout is None else time.monotonic() + timeout
    while any(q.isActive for q in queries):
        failed = next((q for q in queries if not q.isActive and q.exception() is not None), None)
        if failed is not None:
            for q in queries:
                q.stop()
            break
        if until is not None and time.monotonic() >= until:
            return False
        live = next((q for q in queries if q.isActive), None)
        if live is not None:
            live.awaitTermination(0.2)
    for q in queries:
        if (error := q.exception()) is not None:
            raise error
    return True
