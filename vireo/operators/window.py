"""Running (cumulative) sums — W01–W03.

Semantics are those of ``sum(v) OVER ([PARTITION BY k] ORDER BY o)`` with the
default frame ``RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW``: rows with
equal order values (peers) share one cumulative value.

The built-in window runs in a single task without a partition key, and with a
hot key one task gets that key's rows.  ``running_sum`` is one path for inputs
of every size:

1. pre-aggregate peers: ``groupBy(keys, order).sum(v)`` (map-side combine, so a
   hot tie value collapses to one row before any shuffle);
2. range-partition the peer table on ``(keys, order)`` into ``n`` partitions
   and sort within partitions — a hot key is spread over several partitions;
3. per partition, a vectorised prefix sum per key (``mapInArrow``; the only
   imperative step, a per-partition scan Spark has no operator for), whose
   result is checkpointed once so every later branch sees the same
   partition ids (range boundaries are sampled per exchange);
4. per ``(partition id, key)`` totals, turned into offsets by a window over
   that small table (at most ``n + #keys`` rows; without keys exactly ``n``
   rows, so it is broadcast);
5. cumulative = local prefix + offset; joined back to the input rows on
   ``(keys, order)`` (null-safe).  With a unique order key steps 1 and 5's
   join are skipped: the rows themselves are range-partitioned.

As in SQL, a key's sum is NULL until its first non-NULL value (a running
non-NULL count travels with the sum) and a NaN propagates.
"""

from __future__ import annotations

from typing import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PID = "__vireo_pid"
_TIE = "__vireo_tie"
_LOC = "__vireo_local"
_OFF = "__vireo_offset"

def range_partitions(spark, num_partitions: int | None = None) -> int:
    """Partitions of a range exchange: the caller's number or the shuffle width, which grows with the input."""
    return max(1, num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))


def materialize(df: DataFrame) -> DataFrame:
    """Eager reliable checkpoint into the session's checkpoint directory."""
    from vireo.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def running_sum_window(df: DataFrame, value: str, order: str, out: str,
                       partition_by: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """The built-in window form (single task when ``partition_by`` is empty)."""
    o = F.col(order).desc() if descending else F.col(order).asc()
    w = Window.orderBy(o)
    if partition_by:
        w = Window.partitionBy(*partition_by).orderBy(o)
    return df.withColumn(out, F.sum(value).over(w))


_NN = "__vireo_nn"      # non-NULL values among the peers
_LNN = "__vireo_lnn"    # running count of non-NULL values
_OFFNN = "__vireo_offnn"
_ALL = "__vireo_all"


def _values(column):
    """The column's numbers; decimals as four 32-bit limbs in int64, lowest first, the top one signed."""
    import numpy as np
    import pyarrow as pa
    if not pa.types.is_decimal(column.type):
        return column.to_numpy(zero_copy_only=False)
    raw = np.frombuffer(column.buffers()[1], "<u4")[4 * column.offset:4 * (column.offset + len(column))].reshape(-1, 4)
    limbs = raw.astype("int64")
    limbs[:, 3] = raw[:, 3].astype("int32")
    return limbs


def _cumulate(vals, gid):
    """Prefix sums, restarting where ``gid`` (1, 2, …; None: one group) changes; limbs are summed one by one."""
    import numpy as np
    if vals.ndim == 1:
        return np.cumsum(vals) if gid is None else pd.Series(vals).groupby(gid).cumsum(skipna=False).to_numpy()
    sums = np.cumsum(vals, axis=0)
    if gid is None:
        return sums
    starts = np.flatnonzero(np.diff(gid, prepend=0))
    return sums - (sums[starts] - vals[starts])[gid - 1]


def _carried(local):
    """Limb sums with every limb but the top one below 2^32 again; an error beyond 38 digits."""
    import numpy as np
    if local.ndim == 1:
        return local
    for i in range(3):
        local[:, i + 1] += local[:, i] >> 32
        local[:, i] &= 0xFFFFFFFF
    size = np.abs(local[:, 3] * 2.0**96 + local[:, 2] * 2.0**64)
    for r in np.flatnonzero(size > 0.99e38):
        if abs(sum(int(x) << 32 * i for i, x in enumerate(local[r]))) >= 10**38:
            raise ArithmeticError("a running sum passes 38 digits")
    return local


def _to_arrow(local, kind):
    import pyarrow as pa
    if local.ndim == 1:
        return pa.array(local, type=kind)
    return pa.Decimal128Array.from_buffers(kind, len(local), [None, pa.py_buffer(local.astype("uint32").tobytes())])


def _local_prefix(keys: list[str]):
    """mapInArrow body: per key, prefix sums of ``_TIE`` and ``_NN`` over
    (keys, order)-sorted batches, carrying across batch boundaries.  Arrow
    in and out, so a NaN value stays NaN (it propagates, as in SQL) and is
    never mistaken for NULL."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        carry = None          # (sum, count) of the group that ended the last batch
        last_key = None       # that group's key tuple (None-safe)
        for rb in batches:
            if rb.num_rows == 0:
                yield pa.RecordBatch.from_arrays(
                    rb.columns + [rb.column(_TIE), rb.column(_NN)], rb.schema.names + [_LOC, _LNN])
                continue
            vals = _values(rb.column(_TIE))
            nns = rb.column(_NN).to_numpy(zero_copy_only=False).astype("int64")
            if keys:
                kdf = pa.Table.from_batches([rb.select(keys)]).to_pandas()
                change = pd.Series(False, index=kdf.index)
                for k in keys:
                    x, y = kdf[k], kdf[k].shift()
                    change |= (x != y) & ~(x.isna() & y.isna())
                change.iloc[0] = True
                gid = change.cumsum().to_numpy()
                local = _cumulate(vals, gid)
                lnn = pd.Series(nns).groupby(gid).cumsum().to_numpy()
                first = tuple(None if pd.isna(kdf[k].iloc[0]) else kdf[k].iloc[0] for k in keys)
                if carry is not None and first == last_key:
                    head = gid == 1
                    local[head] = local[head] + carry[0]
                    lnn = np.where(head, lnn + carry[1], lnn)
                last_key = tuple(None if pd.isna(kdf[k].iloc[-1]) else kdf[k].iloc[-1] for k in keys)
            else:
                gid = None
                local, lnn = _cumulate(vals, None), np.cumsum(nns)      # NaN propagates
                if carry is not None:
                    local, lnn = local + carry[0], lnn + carry[1]
            local = _carried(local)
            carry = (local[-1].copy(), lnn[-1])
            yield pa.RecordBatch.from_arrays(
                rb.columns + [_to_arrow(local, rb.schema.field(_TIE).type), pa.array(lnn, type=pa.int64())],
                rb.schema.names + [_LOC, _LNN])

    return run


def running_sum(df: DataFrame, value: str, order: str, out: str,
                partition_by: Sequence[str] = (), descending: bool = False,
                num_partitions: int | None = None, unique_order: bool = False,
                total: str | None = None) -> DataFrame:
    """Scalable RANGE-frame running sum (see module docstring).  Like SQL,
    the result is NULL until the first non-NULL value of the key.

    ``unique_order=True`` declares that (keys, order) is unique (no peers):
    the rows themselves then go through the range partition with their
    columns, and both the peer pre-aggregation and the join back are skipped.
    ``total`` names a column for the key's whole sum, taken from the same scan.
    The scan is checkpointed, so jobs run when it is called.
    """
    spark = df.sparkSession
    keys = list(partition_by)
    n = range_partitions(spark, num_partitions)
    vtype = df.schema[value].dataType

    # 1. peers pre-aggregated; decimals stay decimals of 38 digits.
    if isinstance(vtype, T.DecimalType):
        loc_type = T.DecimalType(38, vtype.scale)
    elif isinstance(vtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        loc_type = T.LongType()
    else:
        loc_type = T.DoubleType()
    zero = F.lit(0).cast(loc_type)
    if unique_order:
        ties = df.select("*", F.coalesce(F.col(value).cast(loc_type), zero).alias(_TIE),
                         F.col(value).isNotNull().cast("long").alias(_NN))
    else:
        ties = df.groupBy(*keys, order).agg(F.coalesce(F.sum(F.col(value).cast(loc_type)), zero).alias(_TIE),
                                            F.count(value).alias(_NN))

    # 2. range partition on (keys, order); explicit n keeps AQE from
    #    coalescing it, so partition ids are stable between the two branches.
    o = F.col(order).desc_nulls_last() if descending else F.col(order).asc_nulls_first()
    sort_cols = [F.col(k).asc_nulls_first() for k in keys] + [o]
    ranged = (ties.repartitionByRange(n, *sort_cols)
              .sortWithinPartitions(*sort_cols)
              .withColumn(_PID, F.spark_partition_id()))

    # 3. local prefix sums.
    schema = T.StructType(list(ranged.schema.fields) + [T.StructField(_LOC, loc_type),
                                                         T.StructField(_LNN, T.LongType())])
    # The range partitioner samples with a seed derived from its RDD id, so
    # two separately planned exchanges may cut different boundaries.  Both
    # consumers below (totals and rows) must see the same partition ids:
    # the scanned result is checkpointed once (reliable storage, lineage cut)
    # instead of trusting exchange reuse.
    local = materialize(ranged.mapInArrow(_local_prefix(keys), schema))

    # 4. offsets from per-(partition, key) totals.  Derived sides get fresh
    #    column names so the joins are never ambiguous self-joins.
    totals = local.groupBy(_PID, *keys).agg(F.sum(_TIE).alias("__t"), F.sum(_NN).alias("__tn"))
    w = (Window.partitionBy(*keys) if keys else Window).orderBy(_PID).rowsBetween(
        Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy()
    kalias = {k: f"__k{i}" for i, k in enumerate(keys)}
    offsets = totals.select(
        F.col(_PID).alias("__opid"), *[F.col(k).alias(a) for k, a in kalias.items()],
        F.coalesce(F.sum("__t").over(w), F.lit(0)).cast(loc_type).alias(_OFF),
        F.coalesce(F.sum("__tn").over(w), F.lit(0)).cast("long").alias(_OFFNN),
        F.when(F.sum("__tn").over(whole) > 0, F.sum("__t").over(whole)).cast(loc_type).alias(_ALL))
    if not keys:
        # exactly n rows: a proven bound, so broadcasting is safe.
        offsets = F.broadcast(offsets)
    cond = [F.col(_PID) == F.col("__opid")] + [F.col(k).eqNullSafe(F.col(a)) for k, a in kalias.items()]
    cum = local.join(offsets, cond, "inner")

    # 5. back to the value type, then to the input rows.
    if isinstance(vtype, T.DecimalType):
        # 37 + 37 digits add up to 38 without giving up scale
        part, res_type = T.DecimalType(37, vtype.scale), T.DecimalType(min(38, vtype.precision + 10), vtype.scale)
        cumulated = (F.col(_LOC).cast(part) + F.col(_OFF).cast(part)).cast(res_type)
    else:
        cumulated, res_type = F.col(_LOC) + F.col(_OFF), loc_type
    cumulated = F.when(F.col(_LNN) + F.col(_OFFNN) > 0, cumulated).alias(out)
    outs = [cumulated] + ([F.col(_ALL).cast(res_type).alias(total)] if total else [])
    if unique_order:
        return cum.select(*df.columns, *outs)
    jalias = {c: f"__j{i}" for i, c in enumerate(keys + [order])}
    cum = cum.select(*[F.col(c).alias(a) for c, a in jalias.items()], *outs)
    join_cond = [F.col(c).eqNullSafe(F.col(a)) for c, a in jalias.items()]
    return df.join(cum, join_cond, "inner").drop(*jalias.values())


def running_share(df: DataFrame, value: str, order: str, cum_col: str, share_col: str,
                  partition_by: Sequence[str] = (), descending: bool = False,
                  total_col: str | None = None) -> DataFrame:
    """Running sum and its share of the (per-key) total — W02.

    The total comes from the running sum's own scan.  ``total_col`` keeps it
    as a column.
    """
    tname = total_col or "__total"
    out = running_sum(df, value, order, cum_col, partition_by, descending, total=tname)
    out = out.withColumn(share_col, F.col(cum_col).cast("double") / F.col(tname).cast("double"))
    return out if total_col else out.drop(tname)


def band(share: Column, levels: Sequence[float], labels: Sequence[str] = ("A", "B", "C")) -> Column:
    """``share < l0`` → A, ``l0 <= share <= l1`` → B, else C (reference boundaries)."""
    lo, hi = levels
    return (F.when(share < lo, F.lit(labels[0]))
            .when((share >= lo) & (share <= hi), F.lit(labels[1]))
            .otherwise(F.lit(labels[2])))
