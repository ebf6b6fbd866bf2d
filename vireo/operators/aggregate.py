"""Aggregations — A01–A29 and the skew-salted aggregate.

Algebraic aggregates are always expressed as ``groupBy().agg()`` so Spark
plans a partial (map-side) HashAggregate before the shuffle: a hot key is
reduced to one row per task before it moves.  The reference's
``groupByKey``-then-fold patterns are re-aimed accordingly: a key's values
are never gathered into one array (a hot key could hold a third of the
table); "the values of a key" is returned as a multiset of rows
``(key, value, n)`` instead.
"""

from __future__ import annotations

from statistics import NormalDist
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# A01 / A02 / A04 -----------------------------------------------------------
def group_values(df: DataFrame, key: Column | str, value: str, key_name: str = "key",
                 count_col: str = "n") -> DataFrame:
    """``groupByKey`` as a multiset: one row per (key, distinct value) with its
    multiplicity.  Rows, not arrays, so a hot key never lands in one cell."""
    k = F.col(key) if isinstance(key, str) else key
    return df.groupBy(k.alias(key_name), F.col(value)).agg(F.count(F.lit(1)).alias(count_col))


def sum_from_groups(grouped: DataFrame, key: str, value: str, count_col: str = "n",
                    out: str = "total") -> DataFrame:
    """Fold the grouped multiset back to a per-key sum (must equal A03)."""
    return grouped.groupBy(key).agg(F.sum(F.col(value) * F.col(count_col)).alias(out))


# A03 / A07 / A08 / A09 -----------------------------------------------------
def reduce_by_key(df: DataFrame, keys: str | Sequence[str], value: str, out: str = "total") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.sum(value).alias(out))


def combine_by_key(df: DataFrame, keys: str | Sequence[str], measures: Sequence[str],
                   count_col: str = "n") -> DataFrame:
    """(sum of each measure, count) per key — the combiners of A07/A09."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(*[F.sum(m).alias(f"sum_{m}") for m in measures],
                                 F.count(F.lit(1)).alias(count_col))


# A05 / A10 / A11 -----------------------------------------------------------
def numeric_stats(df: DataFrame, col: str) -> DataFrame:
    """count, min, max, sum, mean, population stdev / variance (RDD ``stats``)."""
    c = F.col(col)
    return df.agg(F.count(c).alias("count"), F.min(c).alias("min"), F.max(c).alias("max"),
                  F.sum(c).alias("sum"), F.avg(c).alias("mean"),
                  F.stddev_pop(c).alias("stdev"), F.var_pop(c).alias("variance"))


# A06 -------------------------------------------------------------------------
def tree_aggregate(df: DataFrame, value: str, fanout: int = 4, out: str = "total") -> DataFrame:
    """Multi-level fold: partitions are combined in ``fanout`` groups first,
    then the partial results once more."""
    level1 = (df.groupBy(F.pmod(F.spark_partition_id(), F.lit(fanout)).alias("__g"))
              .agg(F.sum(value).alias("__p")))
    return level1.agg(F.sum("__p").alias(out))


# A12 -------------------------------------------------------------------------
def count_by(df: DataFrame, cols: Sequence[str], out: str = "count") -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(out))


# A13 -------------------------------------------------------------------------
def histogram(df: DataFrame, col: str, buckets: int) -> DataFrame:
    """Equal-width histogram over [min, max]; the last bucket is closed.
    Every bucket is present (zero-filled).  min/max are a one-row aggregate
    joined lazily."""
    spark = df.sparkSession
    v = F.col(col).cast("double")
    bounds = df.agg(F.min(v).alias("__mn"), F.max(v).alias("__mx"))
    width = F.col("__mx") - F.col("__mn")
    idx = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((v - F.col("__mn")) / width * buckets), F.lit(buckets - 1)))
    counts = (df.where(F.col(col).isNotNull()).crossJoin(F.broadcast(bounds))
              .groupBy(idx.cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("__c")))
    grid = spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).crossJoin(F.broadcast(bounds))
    step = width / buckets                  # edges min + i·step, as RDD.histogram reports them
    lo = F.col("__mn") + F.col("bucket") * step
    hi = F.when(F.col("bucket") == buckets - 1, F.col("__mx")).otherwise(
        F.col("__mn") + (F.col("bucket") + 1) * step)
    return (grid.join(counts, "bucket", "left")
            .select("bucket", lo.alias("lower"), hi.alias("upper"),
                    F.coalesce(F.col("__c"), F.lit(0)).cast("long").alias("count")))


# A14 / A15 -----------------------------------------------------------------
def count_approx(df: DataFrame, fraction: float, confidence: float, seed: int = 7) -> DataFrame:
    """Count estimated from a Bernoulli sample, with a normal-approximation
    interval at ``confidence``."""
    z = NormalDist().inv_cdf(0.5 + confidence / 2)
    s = df.sample(False, fraction, seed).agg(F.count(F.lit(1)).alias("__s"))
    est = F.col("__s") / fraction
    sd = F.sqrt(F.col("__s") * (1 - fraction)) / fraction
    return s.select(est.alias("mean"), (est - z * sd).alias("low"), (est + z * sd).alias("high"))


def count_within(df: DataFrame, timeout_ms: int, confidence: float) -> tuple[float, float, float]:
    """A14 as the reference calls it: the count available after
    ``timeout_ms`` at ``confidence`` — (mean, low, high), exact if the job
    finished in time.  Runs on the JVM RDD (rows never reach Python); the
    result is three numbers."""
    r = df._jdf.rdd().countApprox(int(timeout_ms), float(confidence)).initialValue()
    return r.mean(), r.low(), r.high()


def approx_distinct(df: DataFrame, col: str, rsd: float = 0.05, out: str = "approx_distinct") -> DataFrame:
    return df.agg(F.approx_count_distinct(col, rsd).alias(out))


# A22–A24 -------------------------------------------------------------------
def cube(df: DataFrame, dims: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    return df.cube(*dims).agg(*aggs, F.grouping_id().alias("gid"))


def rollup(df: DataFrame, dims: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    return df.rollup(*dims).agg(*aggs, F.grouping_id().alias("gid"))


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], dims: Sequence[str],
                  aggs: Sequence[Column]) -> DataFrame:
    """Arbitrary grouping sets; ``gid`` tells subtotal NULLs from data NULLs."""
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *dims).agg(
        *aggs, F.grouping_id().alias("gid"))


# A25–A28 -------------------------------------------------------------------
def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], exact: bool = False,
              accuracy: int = 10000) -> DataFrame:
    """Per column, an array of quantiles (approximate by default)."""
    out = []
    for c in cols:
        if exact:
            out.append(F.percentile(F.col(c), list(probs)).alias(c))
        else:
            out.append(F.percentile_approx(F.col(c), list(probs), accuracy).alias(c))
    return df.agg(*out)


def mode_value(df: DataFrame, col: str) -> DataFrame:
    """Most frequent non-NULL value (smallest value on ties) and its count."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), F.asc(col)).limit(1)


def correlation(df: DataFrame, a: str, b: str, out: str = "corr") -> DataFrame:
    return df.agg(F.corr(a, b).alias(out))


# A29 -------------------------------------------------------------------------
def last_value_per_key(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """``collectAsMap``: one value per key, the last under ``order`` winning —
    a distributed (key, value) table rather than a map on the driver."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


# K03 -------------------------------------------------------------------------
def hot_keys(df: DataFrame, key: str, share: float = 0.01, fraction: float = 0.01,
             seed: int = 17) -> DataFrame:
    """Keys holding more than ``share`` of a Bernoulli sample.  At most
    ``1/share`` keys can pass, so the result has a proven size bound and may
    be broadcast."""
    s = df.select(key).sample(False, fraction, seed)
    counts = s.groupBy(key).agg(F.count(F.lit(1)).alias("__c"))
    total = s.agg(F.count(F.lit(1)).alias("__t"))
    return (counts.crossJoin(F.broadcast(total))
            .where(F.col("__c") > F.col("__t") * share).select(key))


def salted_sum(df: DataFrame, key: str, value: str, salts: int = 10, out: str = "total",
               hot: DataFrame | None = None, salt_by: Sequence[str] | None = None) -> DataFrame:
    """Two-stage sum for skewed keys.

    Rows of hot keys get a deterministic salt ``pmod(xxhash64(row), salts)``
    (others salt 0); stage 1 sums per (key, salt) — the hot key is spread
    over ``salts`` reducers — and stage 2 sums the partials per key.
    ``hot`` defaults to :func:`hot_keys`.
    """
    found = hot if hot is not None else hot_keys(df, key)
    hot_flag = found.select(F.col(key).alias("__hk"), F.lit(True).alias("__hot")).distinct()
    if hot is None:
        hot_flag = F.broadcast(hot_flag)     # at most 1/share keys; a caller's list has no such bound
    cols = list(salt_by) if salt_by else df.columns
    salted = (df.join(hot_flag, F.col(key).eqNullSafe(F.col("__hk")), "left")
              .withColumn("__salt", F.when(F.col("__hot"), F.pmod(F.xxhash64(*cols), F.lit(salts)))
                          .otherwise(F.lit(0))))
    stage1 = salted.groupBy(key, "__salt").agg(F.sum(value).alias("__part"))
    return stage1.groupBy(key).agg(F.sum("__part").alias(out))


# A25 (exact, scalable) -------------------------------------------------------
def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                    partition_by: Sequence[str] = (), names: Sequence[str] | None = None,
                    counts: str | None = None) -> DataFrame:
    """``percentile_cont`` per group, exact, without a per-group value buffer.

    ``F.percentile`` keeps every distinct value of a group in one aggregation
    buffer — a hot group would sit in one task.  Here the values are counted
    per (group, value), a distributed running count gives each value's rank,
    and the values at the two ranks around ``(n-1)·p`` are picked with
    algebraic ``min`` aggregates, then interpolated linearly.  With
    ``counts``, ``df`` is already one row per (group, value) with its count
    in that column (e.g. a frequency table shared with a mode).
    """
    from vireo.operators.window import running_sum

    keys = list(partition_by)
    names = list(names) if names else [f"p{int(round(p * 100))}" for p in probs]
    # A NULL value keeps its row with count 0: a group whose values are all
    # NULL still yields a (NULL) result, and such a row never moves a rank.
    if counts:
        freq = df.select(*keys, value, F.when(F.col(value).isNotNull(), F.col(counts))
                         .otherwise(F.lit(0)).cast("long").alias("__n"))
    else:
        freq = df.groupBy(*keys, value).agg(F.count(value).alias("__n"))
    # one row per (group, value): the rows themselves travel, and the scan gives the group's total
    j = running_sum(freq, "__n", value, "__cum", partition_by=keys, unique_order=True, total="__total_n")
    aggs, finals = [], []
    v = F.col(value).cast("double")
    for i, p in enumerate(probs):
        pos = (F.col("__total_n") - 1) * F.lit(float(p))
        lo, hi = F.floor(pos), F.ceil(pos)
        aggs += [F.min(F.when(F.col("__cum") > lo, v)).alias(f"__lo{i}"),
                 F.min(F.when(F.col("__cum") > hi, v)).alias(f"__hi{i}"),
                 F.max(pos - lo).alias(f"__fr{i}")]
        a, b, fr = F.col(f"__lo{i}"), F.col(f"__hi{i}"), F.col(f"__fr{i}")
        finals.append(F.when(a == b, a).otherwise(a + (b - a) * fr).alias(names[i]))
    return j.groupBy(*keys).agg(*aggs).select(*keys, *finals)
