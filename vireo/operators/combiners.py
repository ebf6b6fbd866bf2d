"""A05–A09 with caller-given functions: a state that Spark has no aggregate for.

The caller gives ``zero`` (a new state), ``add(state, rows)`` (a state and the
rows of one key as an Arrow batch), ``merge(state, state)`` and
``finish(state)`` (the values of the result).  States are any picklable
objects and travel as binary rows.  Rows are sorted by key and folded where
they are read, so ``add`` is called with all rows that a key has in an Arrow
batch at once, and a key moves as one state a task however many rows it has,
however many keys the task has; states are merged
level by level, one after another in sorted order, so no task holds a key's
rows or more than one state of a key.  Sums, counts and extremes need none of
this: ``groupBy().agg()`` stays in the JVM.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keys whose states one task keeps at a time; beyond that all are passed on.
OPEN_KEYS = 20_000
_STATE, _TASK = "__vireo_state", "__vireo_task"


class Combiner:
    """The four functions and the schema (DDL or StructType) of what ``finish`` returns."""

    def __init__(self, zero: Callable[[], Any], add: Callable[[Any, pa.RecordBatch], Any], merge: Callable[[Any, Any], Any],
                 finish: Callable[[Any], Sequence], schema: str | T.StructType):
        self.zero, self.add, self.merge, self.finish = zero, add, merge, finish
        self.schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _key(row: tuple) -> tuple:
    """NaNs are one key, as in SQL."""
    return tuple("NaN" if v != v else v for v in row)


def _columns(keys: list[tuple], width: int, schema: pa.Schema, names: Sequence[str]) -> list[pa.Array]:
    return [pa.array([k[i] for k in keys], schema.field(names[i]).type) for i in range(width)]


def _starts(batch: pa.RecordBatch, keys: Sequence[str]) -> list[int]:
    """Where runs of rows of one key begin, and the number of rows."""
    n = batch.num_rows
    differs = np.zeros(max(n - 1, 0), dtype=bool)
    for k in keys:
        column = batch.column(k)
        a, b = column.slice(0, n - 1), column.slice(1)
        other = pc.not_equal(a, b)
        if pa.types.is_floating(column.type):
            other = pc.and_not(other, pc.and_(pc.is_nan(a), pc.is_nan(b)))
        other = pc.if_else(pc.is_valid(other), other, pc.not_equal(pc.is_null(a), pc.is_null(b)))
        differs |= other.to_numpy(zero_copy_only=False)
    return [0, *(np.flatnonzero(differs) + 1).tolist(), n]


def _partial(c: Combiner, keys: Sequence[str], columns: Sequence[str]):
    """Task body: a state per run of rows of one key, so one per key where rows are sorted."""
    def states(schema: pa.Schema, done: list[tuple[tuple, Any]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*_columns([k for k, _ in done], len(keys), schema, keys), pa.array([pickle.dumps(s) for _, s in done], pa.binary())], [*keys, _STATE])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, done, schema = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            schema, values = batch.schema, batch.select(list(columns))
            starts = _starts(batch, keys)
            first = pa.array(starts[:-1])
            rows = zip(*(batch.column(k).take(first).to_pylist() for k in keys)) if keys else [()]
            for row, start, end in zip(rows, starts, starts[1:]):
                if current is None or _key(current[0]) != _key(row):
                    if current is not None:
                        done.append(current)
                    current = row, c.zero()
                current = current[0], c.add(current[1], values.slice(start, end - start))
            if len(done) > OPEN_KEYS:
                yield states(schema, done)
                done = []
        if current is not None:
            yield states(schema, [*done, current])
    return run


def _merged(c: Combiner, keys: Sequence[str], last: bool):
    """Task body over states sorted by key: equal neighbours merged, and finished at the ``last`` level."""
    def rows(schema: pa.Schema, done: list[tuple[tuple, Any]]) -> pa.RecordBatch:
        head = _columns([k for k, _ in done], len(keys), schema, keys)
        if not last:
            return pa.RecordBatch.from_arrays([*head, pa.array([pickle.dumps(s) for _, s in done], pa.binary())], [*keys, _STATE])
        results = [tuple(c.finish(s)) for _, s in done]
        from pyspark.sql.pandas.types import to_arrow_schema
        fields = to_arrow_schema(c.schema)
        return pa.RecordBatch.from_arrays([*head, *[pa.array([r[i] for r in results], f.type) for i, f in enumerate(fields)]], [*keys, *fields.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, done, schema = None, [], None
        for batch in batches:
            schema = batch.schema
            states = batch.column(schema.get_field_index(_STATE)).to_pylist()
            found = zip(*(batch.column(k).to_pylist() for k in keys)) if keys else [()] * batch.num_rows
            for row, packed in zip(found, states):
                state = pickle.loads(packed)
                if current is not None and _key(current[0]) == _key(row):
                    current = current[0], c.merge(current[1], state)
                else:
                    if current is not None:
                        done.append(current)
                    current = row, state
                if len(done) >= 1000:
                    yield rows(schema, done)
                    done = []
        if current is not None:
            done.append(current)
        if done:
            yield rows(schema, done)
    return run


def combine_general(df: DataFrame, keys: str | Sequence[str], columns: Sequence[str], combiner: Combiner, fanout: int = 64) -> DataFrame:
    """Per key, the folded ``columns`` (A07–A09): (keys, the fields of ``combiner.schema``).

    Null keys are one key, and NaNs; an empty frame has no key.  The states of
    a key are merged in ``fanout`` groups of tasks first, then once more.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    head = [T.StructField(k, df.schema[k].dataType) for k in keys]
    states = T.StructType([*head, T.StructField(_STATE, T.BinaryType())])
    folded = df.select(*dict.fromkeys([*keys, *columns])).sortWithinPartitions(*keys).mapInArrow(_partial(combiner, keys, columns), states)
    # the task that read a row, not its key, says in which group of tasks its state is merged first
    dealt = folded.withColumn(_TASK, F.pmod(F.spark_partition_id(), F.lit(fanout)))
    first = dealt.repartition(*keys, _TASK).sortWithinPartitions(*keys).select(*keys, _STATE).mapInArrow(_merged(combiner, keys, False), states)
    return first.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_merged(combiner, keys, True), T.StructType([*head, *combiner.schema.fields]))


def tree_general(df: DataFrame, columns: Sequence[str], combiner: Combiner, fanout: int = 64) -> DataFrame:
    """The whole frame folded to one row (A05, A06): a state a task, then ``fanout`` states a task, until one is left.

    An empty frame gives ``finish(zero())``.
    """
    states = T.StructType([T.StructField(_STATE, T.BinaryType())])
    parts = df.rdd.getNumPartitions()
    level = df.select(*columns).mapInArrow(_partial(combiner, [], columns), states)
    while parts > fanout:
        parts = -(-parts // fanout)
        level = level.repartition(parts, F.pmod(F.spark_partition_id(), F.lit(parts))).mapInArrow(_merged(combiner, [], False), states)
    nothing = df.sparkSession.createDataFrame([(bytearray(pickle.dumps(combiner.zero())),)], states)
    # a shuffle, as coalesce(1) would make one task of the scan and the fold as well
    return level.union(nothing).repartition(1).mapInArrow(_merged(combiner, [], True), combiner.schema)
