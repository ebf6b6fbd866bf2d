"""Text splitting and counting — F01, F04, K01."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_tokens(text: Column, pattern: str = r"\s+", lower: bool = True) -> Column:
    """Array of tokens; ``pattern=""`` splits into single characters."""
    t = F.lower(text) if lower else text
    return F.split(t, pattern)


def tokens(df: DataFrame, text_col: str, unit: str = "word", pattern: str = r"\s+",
           lower: bool = True, out: str = "word", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per non-empty token of every text (whole texts, no prefix)."""
    pat = "" if unit == "char" else pattern
    ex = df.select(*keep, F.explode(split_tokens(F.col(text_col), pat, lower)).alias(out))
    return ex.where(F.col(out) != "")


def token_counts(df: DataFrame, text_col: str, unit: str = "word", pattern: str = r"\s+",
                 lower: bool = True, out: str = "word") -> DataFrame:
    """Token frequencies.  The partial aggregate runs before the shuffle, so a
    very frequent token costs one row per task, not one row per occurrence."""
    t = tokens(df, text_col, unit, pattern, lower, out)
    return t.groupBy(out).agg(F.count(F.lit(1)).alias("count"))


def top_tokens(df: DataFrame, text_col: str, k: int = 20, **kw) -> DataFrame:
    """The ``k`` most frequent tokens (ties broken by the token)."""
    out = kw.get("out", "word")
    return token_counts(df, text_col, **kw).orderBy(F.desc("count"), F.asc(out)).limit(k)
