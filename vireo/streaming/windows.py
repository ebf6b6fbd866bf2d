"""Event-time windows shared by batch twins and streaming queries — R04–R07,
R16.  The same function runs on a batch DataFrame and on a ``readStream``
one; a stream adds a watermark in front (see ``vireo.streaming.queries``)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.plans.standins import money


def sliding_counts(df: DataFrame, ts: str, duration: str, slide: str | None,
                   keys: Sequence[str]) -> DataFrame:
    """Count per (window, keys); tumbling when ``slide`` is None."""
    w = F.window(ts, duration, slide) if slide else F.window(ts, duration)
    g = df.groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("count"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "count")


def session_summary(df: DataFrame, ts: str, gap: str, keys: Sequence[str], value: str | None = None) -> DataFrame:
    """Per key and gap-separated session: first event, end (last event + gap),
    event count and value total — the reference's session record."""
    aggs = [F.count(F.lit(1)).alias("events")]
    if value:
        aggs.append(F.sum(money(value)).cast("double").alias("total"))
    g = df.groupBy(*keys, F.session_window(ts, gap).alias("s")).agg(*aggs)
    return g.select(*keys, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                    *[a for a in ["events", "total"] if a in g.columns])
