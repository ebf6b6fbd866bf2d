"""Streaming sinks — S23, S24."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def parquet_append(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Exactly-once file sink (the ``_spark_metadata`` log)."""
    w = df.writeStream.format("parquet").outputMode("append").option("path", path) \
        .option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def jdbc_append_batches(df: DataFrame, url: str, table: str, checkpoint: str, mode: str = "update",
                        props: Mapping[str, str] | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Each micro-batch appended to a JDBC table with its batch id, once,
    also when a batch is replayed after a failure half-way (see
    :func:`jdbc_batch_writer`).  Columns are written by name."""
    w = df.writeStream.outputMode(mode).foreachBatch(jdbc_batch_writer(url, table, props)) \
        .option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def batch_writer(is_done, undo, append, done):
    """Idempotent ``foreachBatch`` body for a store whose writes commit piece by piece.

    A batch counts as written only once ``done(batch_id)`` has recorded it
    after a full append.  A replay of a batch that is not recorded first takes
    away what a failed attempt left (``undo``) and appends again.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        if is_done(batch, batch_id):
            return
        undo(batch, batch_id)
        append(batch.withColumn("batch_id", F.lit(int(batch_id)).cast("long")), batch_id)
        done(batch, batch_id)

    return write


def jdbc_batch_writer(url: str, table: str, props: Mapping[str, str] | None = None, marker: str | None = None):
    """The ``foreachBatch`` body of :func:`jdbc_append_batches`.

    Finished batches are rows of the ``marker`` table (``<table>_batches`` if
    not named; created on first use).  Rows of an unfinished batch are deleted
    over the driver's JDBC connection before it is appended again.
    """
    props, marker = dict(props or {}), marker or f"{table}_batches"

    def connection(batch: DataFrame):
        jvm = batch.sparkSession._jvm
        info = jvm.java.util.Properties()
        for k, v in props.items():
            info.setProperty(k, v)
        if "driver" in props:
            jvm.java.lang.Class.forName(props["driver"])
        return jvm.java.sql.DriverManager.getConnection(url, info)

    def column(conn, name: str) -> str:
        """``batch_id`` as the table spells it, quoted: Spark's writer quotes names."""
        names, quote = conn.getMetaData().getColumns(None, None, None, None), conn.getMetaData().getIdentifierQuoteString().strip()
        while names.next():
            if names.getString("TABLE_NAME").lower() == name.rsplit(".", 1)[-1].lower() and names.getString("COLUMN_NAME").lower() == "batch_id":
                return f"{quote}{names.getString('COLUMN_NAME')}{quote}"
        raise ValueError(f"{name} has no column batch_id")

    def has_table(conn, name: str) -> bool:
        names = conn.getMetaData().getTables(None, None, "%", None)
        while names.next():
            if names.getString("TABLE_NAME").lower() == name.rsplit(".", 1)[-1].lower():
                return True
        return False

    def is_done(batch: DataFrame, batch_id: int) -> bool:
        conn = connection(batch)
        try:
            if not has_table(conn, marker):
                conn.createStatement().executeUpdate(f"CREATE TABLE {marker} (batch_id BIGINT)")
                return False
            return conn.createStatement().executeQuery(f"SELECT batch_id FROM {marker} WHERE batch_id = {int(batch_id)}").next()
        finally:
            conn.close()

    def undo(batch: DataFrame, batch_id: int) -> None:
        conn = connection(batch)
        try:
            if has_table(conn, table):
                conn.createStatement().executeUpdate(f"DELETE FROM {table} WHERE {column(conn, table)} = {int(batch_id)}")
        finally:
            conn.close()

    def append(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("append").jdbc(url, table, properties=props)

    def done(batch: DataFrame, batch_id: int) -> None:
        conn = connection(batch)
        try:
            conn.createStatement().executeUpdate(f"INSERT INTO {marker} VALUES ({int(batch_id)})")
        finally:
            conn.close()

    return batch_writer(is_done, undo, append, done)


def kafka_write_options(bootstrap: str, topic: str, checkpoint: str | None = None) -> dict[str, str]:
    """S25 sink side: options for ``write``/``writeStream.format("kafka")``.
    The frame must carry ``key`` and ``value`` (and optionally ``partition``,
    e.g. from :func:`vireo.operators.partitioning.letter_bucket` — S26)."""
    opts = {"kafka.bootstrap.servers": bootstrap, "topic": topic}
    if checkpoint:
        opts["checkpointLocation"] = checkpoint
    return opts


def publish(df: DataFrame, options: Mapping[str, str], trigger: dict | None = None):
    """Write keyed records to a topic: a batch write for a batch frame, a
    started query for a streaming one (throttled upstream with
    ``maxFilesPerTrigger``).  Needs the Kafka connector on the classpath."""
    cols = [c for c in ("key", "value", "partition") if c in df.columns]
    out = df.select(*cols)
    if not df.isStreaming:
        out.write.format("kafka").options(**options).save()
        return None
    w = out.writeStream.format("kafka").options(**options)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
