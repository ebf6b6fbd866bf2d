"""Access-log parsing — F05, F06 and the formatting used by the log stand-in.

The pattern extracts nine fields from a common-log-format line.  A line that
does not match is dropped (lenient) or raises (strict); the size field is a
number or ``-`` (meaning 0) — anything else drops the line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the access-log line pattern (host, identity, user,
# [timestamp zone], "method endpoint protocol", status, size).
ACCESS_LOG_PATTERN = r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*)\s*" (\d{3}) (\S+)'

FIELDS = ("ipAddress", "clientIdentity", "userId", "dateTime", "method", "endPoint",
          "protocol", "responseCode")


def _size(raw: Column) -> Column:
    return F.when(raw == "-", F.lit(0).cast("long")).otherwise(raw.try_cast("long"))


_SEP = "\u0001"


def _fields(line: Column) -> Column:
    """All nine groups from one regex evaluation: the matched prefix is
    rewritten to the groups joined by a control character (a line that does
    not match is left unchanged and so has no separator)."""
    joined = F.regexp_replace(line, ACCESS_LOG_PATTERN + ".*$",
                              _SEP.join(f"${i}" for i in range(1, 10)))
    return F.when(~line.contains(_SEP), F.split(joined, _SEP))


def parse_access_log(df: DataFrame, line_col: str = "value") -> DataFrame:
    """Lenient parse: non-matching lines and non-numeric sizes are dropped."""
    # explode of a one-element array is a Generate node: the optimizer cannot
    # inline the regex (or an expensive upstream line expression) into each
    # of the ten field references and the pushed-down filter.
    parts = df.select(F.explode(F.array(_fields(F.col(line_col)))).alias("__f"))
    ok = parts.where(F.size("__f") == 9)
    cols = [F.col("__f")[i].alias(n) for i, n in enumerate(FIELDS)]
    parsed = ok.select(*cols, _size(F.col("__f")[8]).alias("contentSize"))
    return parsed.where(F.col("contentSize").isNotNull())


def parse_access_log_strict(df: DataFrame, line_col: str = "value") -> DataFrame:
    """Strict parse: the first malformed line fails the job (``raise_error``)."""
    line = F.col(line_col)
    f = _fields(line)
    bad = F.coalesce(F.size(f) != 9, F.lit(True)) | _size(F.get(f, 8)).isNull()
    checked = df.withColumn("__ok", F.when(bad, F.raise_error(F.concat(F.lit("cannot parse log line: "), line)))
                            .otherwise(F.lit(True)))
    return parse_access_log(checked.where("__ok"), line_col)


def rejected_lines(df: DataFrame, line_col: str = "value") -> DataFrame:
    """The lines the lenient parser drops (for a reject count)."""
    f = _fields(F.col(line_col))
    return df.where(F.coalesce(F.size(f) != 9, F.lit(True)) | _size(F.get(f, 8)).isNull())


def day_of_month(date_time: Column) -> Column:
    """Day key of the report: the first two characters of ``dd/Mon/yyyy:…``."""
    return F.substring(date_time, 1, 2).cast("int")
