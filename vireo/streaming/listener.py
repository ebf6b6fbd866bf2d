"""A query listener recording start / progress / termination events,
with per-source start and end offsets (the input for R15's restart JSON)."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class ProgressRecorder(StreamingQueryListener):
    """Keeps one small row per event: bounded by the number of micro-batches
    observed, not by data volume.  Nothing is dropped: a long-running job
    takes the rows away with :meth:`drain` (say once an hour) and appends them
    to a table, from which R15 restarts."""

    def __init__(self):
        self.events: list[dict] = []
        self._lock = threading.Lock()
        self._ended: set[str] = set()
        self._news = threading.Condition()

    def _add(self, row: dict) -> None:
        with self._lock:
            self.events.append(row)

    def drain(self, spark: SparkSession) -> DataFrame:
        """The rows so far as a frame; they are no longer kept here."""
        with self._lock:
            rows, self.events = self.events, []
        return _frame(spark, rows)

    def wait_terminated(self, run_id: str, timeout: float = 60) -> None:
        """Events come after the query's end: wait until those of a run are all here."""
        with self._news:
            if not self._news.wait_for(lambda: run_id in self._ended, timeout):
                raise TimeoutError(f"no termination event of run {run_id} in {timeout} s")

    def onQueryStarted(self, event):
        self._add({"event": "started", "id": str(event.id), "name": event.name, "batch_id": None,
                   "source": None, "start_offset": None, "end_offset": None, "rows": None})

    def onQueryProgress(self, event):
        p = event.progress
        for s in p.sources:
            self._add({"event": "progress", "id": str(p.id), "name": p.name, "batch_id": p.batchId,
                       "source": s.description, "start_offset": s.startOffset, "end_offset": s.endOffset,
                       "rows": s.numInputRows})

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self._add({"event": "terminated", "id": str(event.id), "name": None, "batch_id": None,
                   "source": None, "start_offset": None, "end_offset": event.exception, "rows": None})
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def as_dataframe(self, spark: SparkSession) -> DataFrame:
        with self._lock:
            rows = list(self.events)
        return _frame(spark, rows)


def _frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    rows = [dict(r, start_offset=_s(r["start_offset"]), end_offset=_s(r["end_offset"])) for r in rows]
    return spark.createDataFrame(rows, "event string, id string, name string, batch_id long, source string, "
                                       "start_offset string, end_offset string, rows long")


def _s(v):
    if v is None or isinstance(v, str):
        return v
    return json.dumps(v)
