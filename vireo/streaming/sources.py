"""Streaming sources — S19–S21, R15.

Kafka is the reference's source; its connector jar is not on this
classpath, so the Kafka path is an option builder plus one ``parse``
function shared with a file source (which is what the tests drive).  A
socket source is only an option: no port is opened by the library.
"""

from __future__ import annotations

import json
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def kafka_options(bootstrap: str, topics: Sequence[str] | str, starting_offsets: str = "earliest",
                  fail_on_data_loss: bool = False, group_id: str | None = None,
                  max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Options for ``readStream.format("kafka")`` (S19, and S20's consumer
    group / offset-reset settings; offsets live in the checkpoint)."""
    opts = {"kafka.bootstrap.servers": bootstrap,
            "subscribe": topics if isinstance(topics, str) else ",".join(topics),
            "startingOffsets": starting_offsets,
            "failOnDataLoss": str(fail_on_data_loss).lower()}
    if group_id:
        opts["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def read_kafka(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def kafka_lines(df: DataFrame) -> DataFrame:
    """Binary key/value → strings, with the broker timestamp."""
    return df.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                     F.col("timestamp"))


def starting_offsets_json(offsets: Mapping[str, Mapping[int, int]]) -> str:
    """``{"topic": {"0": 42}}`` for ``startingOffsets`` (from offsets
    recorded by the progress listener)."""
    return json.dumps({t: {str(p): int(o) for p, o in parts.items()} for t, parts in offsets.items()})


def restart_offsets(progress: DataFrame, query_id: str | None = None) -> str:
    """The JSON for ``startingOffsets`` from the recorder's rows: the end
    offsets of the last batch of every Kafka source (of one query if named)."""
    rows = progress.where((F.col("event") == "progress") & F.col("end_offset").startswith("{"))
    if query_id:
        rows = rows.where(F.col("id") == query_id)
    last = rows.groupBy("id", "source").agg(F.max_by("end_offset", "batch_id").alias("end")).collect()  # one per source
    merged: dict[str, dict[int, int]] = {}
    for row in last:
        for topic, parts in json.loads(row["end"]).items():
            at = merged.setdefault(topic, {})
            for part, offset in parts.items():
                at[int(part)] = min(int(offset), at.get(int(part), int(offset)))
    return starting_offsets_json(merged)


def file_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
               arrival_col: str | None = "timestamp") -> DataFrame:
    """A line stream from files landing in ``path``, stamped with the
    arrival time (``current_timestamp``)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.load(path)
    return df.withColumn(arrival_col, F.current_timestamp()) if arrival_col else df


def file_table_stream(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def socket_options(host: str, port: int) -> dict[str, str]:
    """Options for ``readStream.format("socket")`` (debug only)."""
    return {"host": host, "port": str(port)}


def parse_csv_record(df: DataFrame, col: str, fields: Sequence[tuple[int, str, str]], sep: str = ",") -> DataFrame:
    """Pick typed fields out of a delimited record by position — the quote /
    key-value records of the streaming programs.  ``fields`` are
    (position, name, type); bad values become NULL."""
    parts = F.split(F.col(col), sep)
    return df.select(*[F.get(parts, i).try_cast(t).alias(n) for i, n, t in fields],
                     *[c for c in df.columns if c != col])
