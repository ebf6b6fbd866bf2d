"""Date parsing and parts — F07, F10."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_parts(df: DataFrame, col: str, fmt: str | None = None, prefix: str = "") -> DataFrame:
    """Add year / month / day-of-month of a date string (junk → NULL, and
    non-padded forms such as ``2017-5-02`` parse)."""
    d = F.try_to_date(F.col(col), F.lit(fmt)) if fmt else F.try_to_date(F.col(col))
    return df.withColumns({f"{prefix}yr": F.year(d), f"{prefix}mnth": F.month(d),
                           f"{prefix}dy": F.dayofmonth(d)})


def with_arrival_time(df: DataFrame, out: str = "timestamp") -> DataFrame:
    return df.withColumn(out, F.current_timestamp())


def to_ts(col: str | Column) -> Column:
    """Event time as a session-zone TIMESTAMP (watermarks reject TIMESTAMP_NTZ)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("timestamp")
