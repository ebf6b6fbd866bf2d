"""Gap-based sessions without one task per key — R16 batch path.

``groupBy(key, session_window(ts, gap))`` hash-partitions by key and merges
sessions inside one task per key, so a key holding a third of the events is a
third of the job in one task.  Here the events are range-partitioned on
``(key, ts)`` instead, so a hot key spreads over many partitions:

1. identical ``(key, ts)`` events are pre-aggregated (they always share a
   session);
2. range partition + sort on ``(key, ts)``; a vectorised scan per partition
   marks session breaks (``ts - prev_ts > gap`` or a new key) and each row's
   local session start;
3. only the first session of a partition can continue from the previous
   partition.  A per-partition summary (exactly ``n`` rows, so broadcast)
   resolves those continuations with a last-non-null fill over partition ids;
4. sessions are aggregated per ``(key, session_start)`` — algebraic, with a
   partial aggregate before the shuffle.

Semantics equal Spark's ``session_window``: an event joins the current
session when it is at most ``gap`` after the previous event (windows that
touch merge); the session ends ``gap`` after its last event.
"""

from __future__ import annotations

from typing import Iterable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vireo.operators.window import materialize, range_partitions

_PID = "__s_pid"


def _gap_seconds(gap: str) -> float:
    n, unit = gap.split()
    mult = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600,
            "day": 86400, "days": 86400}[unit.lower()]
    return float(n) * mult


def _scan(keys: list[str], ts: str, gap_s: float):
    """mapInPandas body over (key, ts)-sorted rows: each row's local session
    start and whether it belongs to the partition's first session."""
    gap = pd.Timedelta(seconds=gap_s)

    def run(batches: Iterable[pd.DataFrame]):
        last = None            # (key tuple, ts, start) of the previous row, across batches
        breaks_so_far = 0      # breaks seen in this partition (the first row counts as one)
        for pdf in batches:
            if pdf.empty:
                yield pdf.assign(__lstart=pdf[ts], __first=pd.Series([], dtype=bool))
                continue
            t = pdf[ts]
            new_key = pd.Series(False, index=pdf.index)
            for k in keys:
                a, b = pdf[k], pdf[k].shift()
                new_key |= (a != b) & ~(a.isna() & b.isna())
            brk = new_key | (t - t.shift() > gap)
            first_key = tuple(None if pd.isna(pdf[k].iloc[0]) else pdf[k].iloc[0] for k in keys)
            if last is None:
                brk.iloc[0] = True
            else:
                brk.iloc[0] = first_key != last[0] or (t.iloc[0] - last[1]) > gap
            start = t.where(brk)
            if not brk.iloc[0]:
                start.iloc[0] = last[2]
            start = start.ffill()
            nbrk = brk.astype("int64").cumsum() + breaks_so_far
            breaks_so_far = int(nbrk.iloc[-1])
            last = (tuple(None if pd.isna(pdf[k].iloc[-1]) else pdf[k].iloc[-1] for k in keys),
                    t.iloc[-1], start.iloc[-1])
            yield pdf.assign(__lstart=start.astype(t.dtype), __first=(nbrk == 1))

    return run


def sessions(df: DataFrame, ts: str, gap: str, keys: Sequence[str], value: str | None = None,
             num_partitions: int | None = None) -> DataFrame:
    """Per key and gap-separated session: start, end (last event + gap),
    event count and the sum of ``value`` in that column's own sum type (pass a
    decimal or integer column for a total that does not depend on the order of addition)."""
    spark = df.sparkSession
    keys = list(keys)
    n = range_partitions(spark, num_partitions)
    aggs = [F.count(F.lit(1)).alias("__n")]
    if value:
        aggs.append(F.sum(value).alias("__v"))
    ties = df.where(F.col(ts).isNotNull()).groupBy(*keys, ts).agg(*aggs)
    order = [F.col(k).asc_nulls_first() for k in keys] + [F.col(ts).asc()]
    ranged = (ties.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn(_PID, F.spark_partition_id()))
    ts_type = ranged.schema[ts].dataType
    schema = T.StructType(list(ranged.schema.fields) + [T.StructField("__lstart", ts_type),
                                                         T.StructField("__first", T.BooleanType())])
    # checkpointed once: the summary and the rows must see the same partition
    # ids, and range boundaries are sampled per exchange
    local = materialize(ranged.mapInPandas(_scan(keys, ts, _gap_seconds(gap)), schema))

    # per-partition summary: first row, last row (rows are unique per (key, ts))
    kstruct = [F.col(k) for k in keys]
    summary = local.groupBy(_PID).agg(
        F.min(F.struct(*kstruct, F.col(ts))).alias("__f"),
        F.max(F.struct(*kstruct, F.col(ts), F.col("__lstart"), F.col("__first"))).alias("__l"))
    w = Window.orderBy(_PID)
    first_key = F.struct(*[F.col(f"__f.{k}") for k in keys]) if keys else F.lit(0)
    last_key = F.struct(*[F.col(f"__l.{k}") for k in keys]) if keys else F.lit(0)
    gap_expr = F.expr(f"INTERVAL {gap}")
    prev_last_key, prev_last_ts = F.lag(last_key).over(w), F.lag(F.col(f"__l.{ts}")).over(w)
    cont = prev_last_key.eqNullSafe(first_key) & (F.col(f"__f.{ts}") <= prev_last_ts + gap_expr)
    s1 = summary.withColumn("__cont", F.coalesce(cont, F.lit(False)))
    defined = (F.when(~F.col("__l.__first"), F.col("__l.__lstart"))
               .when(~F.col("__cont"), F.col(f"__f.{ts}")))
    s2 = s1.withColumn("__S", F.last(defined, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    carries = s2.select(F.col(_PID).alias("__cpid"),
                        F.when(F.col("__cont"), F.lag("__S").over(w)).alias("__carry"))
    # exactly n rows: a proven bound, so broadcasting is safe
    joined = local.join(F.broadcast(carries), F.col(_PID) == F.col("__cpid"))
    start = F.when(F.col("__first") & F.col("__carry").isNotNull(), F.col("__carry")).otherwise(F.col("__lstart"))
    out_aggs = [F.max(ts).alias("__last"), F.sum("__n").alias("events")]
    if value:
        out_aggs.append(F.sum("__v").alias("total"))
    g = joined.withColumn("session_start", start).groupBy(*keys, "session_start").agg(*out_aggs)
    return g.select(*keys, "session_start", (F.col("__last") + gap_expr).alias("session_end"), "events",
                    *(["total"] if value else []))
