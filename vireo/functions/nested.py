"""Nested data and JSON — F11–F19."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def element(arr: str | Column, i: int) -> Column:
    """0-based array element, NULL when out of range (ANSI-safe)."""
    return F.get(F.col(arr) if isinstance(arr, str) else arr, i)


def map_value(m: str | Column, key: str) -> Column:
    return (F.col(m) if isinstance(m, str) else m).getItem(key)


def explode_all(df: DataFrame, array_col: str, out: str = "value", outer: bool = False) -> DataFrame:
    """Each array element as a row next to all the other columns."""
    fn = F.explode_outer if outer else F.explode
    return df.select(fn(array_col).alias(out), "*")


def explode_chain(df: DataFrame, array_col: str, map_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Explode an array, then a map into (key, value): the cross product of both."""
    step = df.select(*keep, F.explode(array_col).alias("element"), map_col)
    return step.select(*keep, "element", F.explode(map_col).alias("key", "value"))


def json_path(col: str | Column, path: str) -> Column:
    return F.get_json_object(F.col(col) if isinstance(col, str) else col, path)


def json_parse(df: DataFrame, col: str, schema: T.StructType | str, flatten: bool = True) -> DataFrame:
    parsed = df.withColumn("__m", F.from_json(F.col(col), schema))
    return parsed.select(*[c for c in df.columns if c != col], "__m.*") if flatten else parsed


def json_serialize(df: DataFrame, out: str = "json") -> DataFrame:
    """Whole row as a JSON string (NULL fields are omitted)."""
    return df.select(F.to_json(F.struct("*")).alias(out))
