"""Projection, filtering, reshaping and null handling — P01–P32.

Most of these are one Spark call; they exist so that every operation of the
reference has a named, tested entry point and so that the few with a scale
trap (positional zip, mean imputation) are written the distributed way.
"""

from __future__ import annotations

from typing import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vireo.operators.window import materialize, running_sum


# P01 / P14 -----------------------------------------------------------------
def map_rows(df: DataFrame, **exprs: Column) -> DataFrame:
    """Row-wise map: one output column per named expression."""
    return df.select(*[e.alias(n) for n, e in exprs.items()])


def add_columns(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Computed columns (``withColumns`` keeps one projection)."""
    return df.withColumns(dict(exprs))


# P02 / P12 / P13 -----------------------------------------------------------
def filter_rows(df: DataFrame, predicate: str | Column) -> DataFrame:
    """Filter by a Column or a SQL predicate string (pushed to the scan)."""
    return df.where(predicate)


# P03 -------------------------------------------------------------------------
def flat_map(df: DataFrame, array_expr: Column, out: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row → many: explode an array expression, keeping ``keep`` columns."""
    return df.select(*keep, F.explode(array_expr).alias(out))


# P04 / P05 / P06 -----------------------------------------------------------
def map_partitions(df: DataFrame, fn: Callable, schema: T.StructType | str) -> DataFrame:
    """Per-partition transform on Arrow batches (``mapInPandas``)."""
    return df.mapInPandas(fn, schema)


def with_partition_index(df: DataFrame, out: str = "pid") -> DataFrame:
    """Tag each row with the id of the partition holding it."""
    return df.withColumn(out, F.spark_partition_id())


def glom(df: DataFrame, value: str, out: str = "items") -> DataFrame:
    """One row per partition with that partition's values as an array.

    An array per partition is the operator's meaning; it is bounded by the
    partition size (``spark.sql.files.maxPartitionBytes``), never the table.
    """
    return (df.withColumn("pid", F.spark_partition_id())
            .groupBy("pid").agg(F.collect_list(value).alias(out)))


# P07 -------------------------------------------------------------------------
def key_by(df: DataFrame, key: Column, name: str = "key") -> DataFrame:
    """Derived key column in front of the row."""
    return df.select(key.alias(name), *df.columns)


# P08 / P09 -----------------------------------------------------------------
def dense_index(df: DataFrame, order: str, out: str = "idx") -> DataFrame:
    """1-based position of each row under a unique ordering column.

    A running count on the distributed prefix-sum path: no single-partition
    ``row_number()`` window.
    """
    one = df.withColumn("__one", F.lit(1).cast("long"))
    return running_sum(one, "__one", order, out, unique_order=True).drop("__one")


def zip_positional(a: DataFrame, a_order: str, b: DataFrame, b_order: str,
                   a_cols: Sequence[str], b_cols: Sequence[str]) -> DataFrame:
    """Pair the i-th row of ``a`` with the i-th row of ``b``.

    Rows have no order in a DataFrame, so each side names a unique ordering
    column.  Like the reference, unequal lengths are an error, raised lazily
    by ``raise_error`` inside the plan.
    """
    def cols(c, order):
        return list(dict.fromkeys([*c, order]))
    ia = dense_index(a.select(*cols(a_cols, a_order)), a_order, "__ia")
    ib = dense_index(b.select(*cols(b_cols, b_order)), b_order, "__ib")
    joined = ia.join(ib, F.col("__ia") == F.col("__ib"), "full_outer")
    ok = F.when(F.col("__ia").isNull() | F.col("__ib").isNull(),
                F.raise_error(F.lit("zip: datasets have different lengths"))).otherwise(F.lit(True))
    return joined.where(ok).select(F.coalesce("__ia", "__ib").alias("idx"), *a_cols, *b_cols)


def zip_partitions(a: DataFrame, b: DataFrame, a_col: str, b_col: str) -> DataFrame:
    """Per partition, pair rows by their position inside the partition;
    pairs stop at the shorter partition (inner join on (pid, position)).
    Unequal numbers of partitions are an error."""
    if a.rdd.getNumPartitions() != b.rdd.getNumPartitions():
        raise ValueError("zip_partitions: datasets have different numbers of partitions")

    def pos(df, c):
        # monotonically_increasing_id = (partition id << 33) + row number in
        # the partition, so the position needs no window.
        pid = F.spark_partition_id()
        return df.select(pid.alias("pid"), F.col(c),
                         (F.monotonically_increasing_id() - pid.cast("long") * (1 << 33)).alias("pos"))
    return pos(a, a_col).join(pos(b, b_col), ["pid", "pos"], "inner")


# P15 / P16 -----------------------------------------------------------------
def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Positional rename of every column (disambiguates join output)."""
    if len(names) != len(df.columns):
        raise ValueError(f"rename_all: {len(df.columns)} columns, {len(names)} names")
    return df.toDF(*names)


def rename_bulk(df: DataFrame, old: Sequence[str], new: Sequence[str]) -> DataFrame:
    """Zip old and new names (names may contain spaces or '#')."""
    return df.withColumnsRenamed(dict(zip(old, new)))


# P17 -------------------------------------------------------------------------
def try_cast_columns(df: DataFrame, cols: Iterable[str], to: str) -> DataFrame:
    """Cast with invalid values → NULL (ANSI-safe ``try_cast``)."""
    return df.withColumns({c: F.col(c).try_cast(to) for c in cols})


# P18–P21 -----------------------------------------------------------------
def null_rows(df: DataFrame, col: str, keep_null: bool = True) -> DataFrame:
    return df.where(F.col(col).isNull() if keep_null else F.col(col).isNotNull())


def null_to_zero(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.when(F.col(c).isNull(), F.lit(0)).otherwise(F.col(c)) for c in cols})


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna("any", subset=subset)


def fill_const(df: DataFrame, value, subset: Sequence[str]) -> DataFrame:
    return df.fillna(value, subset=list(subset))


# P22–P25 -----------------------------------------------------------------
def numeric_columns(df: DataFrame) -> list[str]:
    """P25: names of the numeric columns, from the schema."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def impute_mean(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Replace NULLs by the column mean.

    One aggregate pass; the one-row means are broadcast-joined so the result
    stays lazy.  Like ``na.fill``, the mean is cast to the column type
    (integral columns truncate: 4.5 → 4).
    """
    cols = list(cols) if cols is not None else numeric_columns(df)
    means = df.agg(*[F.avg(c).alias(f"__mean_{i}") for i, c in enumerate(cols)])
    types = {f.name: f.dataType for f in df.schema.fields}
    joined = df.crossJoin(F.broadcast(means))  # exactly one row
    filled = {c: F.coalesce(F.col(c), F.col(f"__mean_{i}").cast(types[c])) for i, c in enumerate(cols)}
    return joined.withColumns(filled).select(*df.columns)


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row, per column the number of NULLs."""
    cols = list(cols) if cols is not None else df.columns
    return df.select(*[F.sum(F.col(c).isNull().cast("int")).cast("long").alias(c) for c in cols])


def null_flag(df: DataFrame, col: str, flag: str) -> DataFrame:
    """0/1 flag for NULL in ``col``."""
    return df.withColumn(flag, F.col(col).isNull().cast("int"))


# P26 / P27 -----------------------------------------------------------------
def dedup_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(subset) if subset else None)


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


# P28 / P29 -----------------------------------------------------------------
def pivot(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence, agg: Column) -> DataFrame:
    """Pivot with an explicit value list (no extra distinct job)."""
    return df.groupBy(*keys).pivot(pivot_col, list(values)).agg(agg)


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], var: str, val: str) -> DataFrame:
    """Melt (keeps NULL values, like ``stack``)."""
    return df.unpivot(list(ids), list(values), var, val)


# P30 / P31 -----------------------------------------------------------------
def sample_fraction(df: DataFrame, fraction: float, seed: int, with_replacement: bool = False) -> DataFrame:
    return df.sample(withReplacement=with_replacement, fraction=fraction, seed=seed)


def sample_n(df: DataFrame, n: int, seed: int, with_replacement: bool = False) -> DataFrame:
    """Fixed-size sample of ``n`` rows.

    Without replacement: the n smallest seeded random keys
    (TakeOrderedAndProject keeps only n rows per task); fewer than n rows are
    all taken.  With replacement: exactly n draws (none from an empty frame),
    each the row at a seeded random position; the positions are a frame of n
    rows, joined to the rows' dense positions.
    """
    if not with_replacement:
        return df.orderBy(F.rand(seed)).limit(n)
    spark = df.sparkSession
    keyed = materialize(df.withColumn("__key", F.monotonically_increasing_id()))
    indexed = dense_index(keyed, "__key", "__at").drop("__key")
    total = indexed.count()
    if total == 0:
        return df.limit(0)
    draws = materialize(spark.range(n).select((F.floor(F.rand(seed) * total) + 1).alias("__draw")))
    return indexed.join(draws, F.col("__at") == F.col("__draw")).select(*df.columns)


# P32 -------------------------------------------------------------------------
def fields_by_position(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    return df.select(*[df.columns[i] for i in positions])
