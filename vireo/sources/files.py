"""File, JDBC, object-store and catalog sources and sinks — S02–S18, S25.

Credentials come from options or the environment and are never logged.
"""

from __future__ import annotations

import os
import re
import uuid
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vireo.session import checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/vireo-scratch/{name}-{uuid.uuid4().hex[:12]}"


# S02 / S09 ---------------------------------------------------------------
def read_text(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Lines as a ``value`` column.  A gzip file is one split; pass
    ``partitions`` to spread the lines before heavy per-line work."""
    df = spark.read.text(path)
    return df.repartition(partitions) if partitions else df


def write_text(df: DataFrame, path: str, cols: Sequence[str], sep: str = ",", mode: str = "overwrite",
               compression: str | None = None) -> None:
    """One text file per partition, fields joined by ``sep``; ``compression`` is a codec's name, such as gzip."""
    df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in cols]).alias("value")) \
        .write.mode(mode).text(path, compression=compression)


# S03 / S04 / S05 ---------------------------------------------------------
def read_csv_infer(spark: SparkSession, path: str) -> DataFrame:
    """Header + inferred types (runs an inference pass; prefer a schema)."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_csv_schema(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True,
                    corrupt_col: str | None = None) -> DataFrame:
    """Enforced schema; a cell that does not fit becomes NULL (PERMISSIVE).
    With ``corrupt_col`` (a string field in ``schema``) the raw line of a
    malformed record is kept there."""
    r = spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
    if corrupt_col:
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    return r.csv(path)


def parse_delimited(lines: DataFrame, col: str, sep: str, fields: Sequence[tuple[str, str]],
                    header: str | None = None) -> DataFrame:
    """Split delimited lines into typed columns (``try_cast``: junk → NULL);
    the header line, if given, is dropped."""
    src = lines.where(F.col(col) != header) if header is not None else lines
    parts = F.split(F.col(col), re.escape(sep))
    return src.select(*[F.get(parts, i).try_cast(t).alias(n) for i, (n, t) in enumerate(fields)])


# S06 / S07 -----------------------------------------------------------------
def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def json_column_schema(df: DataFrame, col: str) -> str:
    """DDL of a JSON string column: the fields of all its values, merged.

    Values are grouped first (equal documents are read once) and written as
    lines, from which the JSON source infers the schema: no row leaves the JVM.
    A line break inside a value can only stand between its tokens.
    """
    path = scratch_path(df.sparkSession, "json-values")
    values = df.select(F.regexp_replace(F.col(col).cast("string"), "[\r\n]+", " ").alias("value")).where(F.col(col).isNotNull()).distinct()
    values.write.text(path)
    schema = df.sparkSession.read.json(path).schema
    if not schema.fields:
        raise ValueError("no JSON value to infer a schema from")
    return schema.toDDL()


# S08 / S10 -----------------------------------------------------------------
def parquet_roundtrip(df: DataFrame, path: str) -> DataFrame:
    """Write then read back (the typed-object save/load is re-aimed here too)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


# S11 ---------------------------------------------------------------------
def save_kv_file(df: DataFrame, key: str, value: str, path: str) -> None:
    """(key, value) pairs as a Hadoop sequence file (only the RDD API writes that format)."""
    pairs = df.select(key, value).rdd.map(tuple)
    if df.isEmpty():                # the writer takes the types from the first pair: name them
        pairs.saveAsHadoopFile(path, "org.apache.hadoop.mapred.SequenceFileOutputFormat",
                               keyClass="org.apache.hadoop.io.Text", valueClass="org.apache.hadoop.io.Text")
    else:
        pairs.saveAsSequenceFile(path)


def load_kv_file(spark: SparkSession, path: str, key: str = "key", value: str = "value",
                 schema: T.StructType | str | None = None) -> DataFrame:
    """``schema`` names and types the two columns; without it they are strings
    (no sampling, so an empty file reads as an empty frame)."""
    rows = spark.sparkContext.sequenceFile(path)
    if schema is None:
        return spark.createDataFrame(rows.map(lambda kv: (str(kv[0]), str(kv[1]))), f"`{key}` string, `{value}` string")
    return spark.createDataFrame(rows, schema)


# S12–S15 -----------------------------------------------------------------
def jdbc_read(spark: SparkSession, url: str, table: str, props: Mapping[str, str] | None = None) -> DataFrame:
    return spark.read.jdbc(url, table, properties=dict(props or {}))


def jdbc_read_partitioned(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int,
                          partitions: int, props: Mapping[str, str] | None = None) -> DataFrame:
    """Parallel read: ``partitions`` range queries on ``column``.  Bounds only
    set the stride; rows outside them are still read (first/last range)."""
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=dict(props or {}))


def jdbc_append(df: DataFrame, url: str, table: str, props: Mapping[str, str] | None = None) -> None:
    df.write.mode("append").jdbc(url, table, properties=dict(props or {}))


# S16 ---------------------------------------------------------------------
def s3a_settings(endpoint: str | None = None, access_key_env: str = "AWS_ACCESS_KEY_ID",
                 secret_key_env: str = "AWS_SECRET_ACCESS_KEY", path_style: bool = False) -> dict[str, str]:
    """Object-store settings with credentials read from the environment.
    The returned mapping holds secrets: apply it, never print it."""
    conf = {"fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
            "fs.s3a.path.style.access": str(path_style).lower()}
    if endpoint:
        conf["fs.s3a.endpoint"] = endpoint
    ak, sk = os.environ.get(access_key_env), os.environ.get(secret_key_env)
    if ak and sk:
        conf["fs.s3a.access.key"] = ak
        conf["fs.s3a.secret.key"] = sk
    # otherwise the connector's own default provider chain applies
    return conf


def apply_hadoop_settings(spark: SparkSession, conf: Mapping[str, str]) -> None:
    hc = spark.sparkContext._jsc.hadoopConfiguration()
    for k, v in conf.items():
        hc.set(k, v)


# S17 / S18 -----------------------------------------------------------------
def save_table(df: DataFrame, name: str, fmt: str = "parquet", mode: str = "overwrite",
               path: str | None = None) -> None:
    """Managed table, or external when ``path`` is given (dropping an external
    table keeps its files)."""
    w = df.write.mode(mode).format(fmt)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def create_external_table(spark: SparkSession, name: str, ddl: str, path: str, fmt: str = "parquet") -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING {fmt} LOCATION '{path}'")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


# S25 ---------------------------------------------------------------------
def keyed_records(lines: DataFrame, col: str, sep: str = ",") -> DataFrame:
    """Topic records from delimited lines: key = first field, value = the line
    with one trailing separator trimmed."""
    key = F.split(F.col(col), re.escape(sep)).getItem(0)
    value = F.regexp_replace(F.col(col), re.escape(sep) + "$", "")
    return lines.select(key.alias("key"), value.alias("value"))
