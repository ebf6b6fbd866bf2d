"""Session updates with an expired flag — R16 stateful form.

The reference declares per-key session records (id, first / last event,
duration, event count, expired) without an operator that fills them.
``session_window`` only reports a session once it closes; this operator
reports every trigger's state of each key's open session (``expired =
False``) and the final record once event time has passed the gap
(``expired = True``), with ``applyInPandasWithState`` and an event-time
timeout.  State is one small row per key (the open session), removed when
the session expires, so it stays bounded by the number of active keys.

Events may arrive out of order within the watermark: a key's state is the
list of its open sessions (a late event may start one before the last, or
join two), and a session is final only when the watermark has passed its end.
``totals`` adds sums of two measures, as the reference's records carry.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

OUTPUT = ("key STRING, session_start TIMESTAMP, session_end TIMESTAMP, duration_ms LONG, "
          "events LONG, total DOUBLE, expired BOOLEAN")
STATE = "starts ARRAY<TIMESTAMP>, lasts ARRAY<TIMESTAMP>, events ARRAY<LONG>, totals ARRAY<DOUBLE>"


def _merged(start: np.ndarray, last: np.ndarray, n: np.ndarray, total: np.ndarray, gap: np.timedelta64) -> tuple:
    """The intervals joined that are at most ``gap`` apart, by start; one without a time is of the last session."""
    if not len(start):
        return start, last, n, total
    order = np.argsort(start, kind="stable")
    start, last, n, total = start[order], last[order], n[order], np.nan_to_num(total[order], nan=0.0, posinf=np.inf, neginf=-np.inf)
    reach = np.fmax.accumulate(last)
    at = np.flatnonzero(np.concatenate(([True], start[1:] - reach[:-1] > gap)))
    return start[at], np.fmax.reduceat(last, at), np.add.reduceat(n, at), np.add.reduceat(total, at)


def merge_sessions(frame: pd.DataFrame, gap: pd.Timedelta) -> pd.DataFrame:
    """Sessions (start, last, n, total) that intervals of the same columns make:
    those at most ``gap`` apart are one.  Intervals in any order."""
    columns = ("start", "last", "n", "total")
    return pd.DataFrame(dict(zip(columns, _merged(*(frame[c].to_numpy() for c in columns), gap.to_timedelta64()))))


def _updater(gap_ms: int, tz: str):
    gap = np.timedelta64(gap_ms, "ms")

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # plain arrays: a key has few rows, for which each step on a data frame costs a hundred times the work
        starts, lasts, n, total = state.get if state.exists else ([], [], [], [])
        held = np.array(starts, "datetime64[us]"), np.array(lasts, "datetime64[us]"), np.array(n, "int64"), np.array(total, "float64")
        for batch in batches:  # merged batch by batch: only open sessions are held
            ts = batch["ts"].to_numpy().astype("datetime64[us]")
            new = ts, ts, np.ones(len(ts), "int64"), batch["value"].to_numpy()
            held = _merged(*map(np.concatenate, zip(held, new)), gap)
        start, last, n, total = held
        now = state.getCurrentWatermarkMs()
        watermark = pd.Timestamp(now, unit="ms", tz="UTC").tz_convert(tz).tz_localize(None).to_datetime64()
        expired = last + gap < watermark
        still = ~expired
        if still.any():
            state.update(tuple(x[still].tolist() for x in held))
            # pandas sees session-local wall time; the timeout is epoch milliseconds, at least past the watermark
            first = int(pd.Timestamp(np.fmin.reduce(last[still]) + gap).tz_localize(tz).timestamp() * 1000)
            state.setTimeoutTimestamp(max(first, now + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame({"key": [key[0]] * len(start), "session_start": start, "session_end": last + gap,
                            "duration_ms": (last - start) // np.timedelta64(1, "ms"),
                            "events": n, "total": total, "expired": expired})

    return update


def session_updates(events: DataFrame, key: str, ts: str, gap_ms: int, watermark: str, value: str | None = None) -> DataFrame:
    """Per key, its open sessions' running records on each trigger and the
    final record (``expired``) once the watermark passes a session's end.
    ``ts`` must be a TIMESTAMP column; ``watermark`` bounds how late events may
    be; ``total`` sums ``value`` (0 without one)."""
    measure = F.coalesce(events[value].cast("double"), F.lit(0.0)) if value else F.lit(0.0)
    src = events.select(events[key].cast("string").alias("key"), events[ts].alias("ts"), measure.alias("value")) \
        .withWatermark("ts", watermark)
    tz = events.sparkSession.conf.get("spark.sql.session.timeZone")
    return src.groupBy("key").applyInPandasWithState(
        _updater(gap_ms, tz), OUTPUT, STATE, "append", "EventTimeTimeout")
