"""Scratch tables, row keys and Arrow slices shared by the operators."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.session import checkpoint_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Scratch:
    """Written tables under the cluster's shared ``spark.checkpoint.dir``.

    ``cut`` writes a frame and reads it back, so later steps neither recompute
    it nor lose it with an executor.  ``drop`` removes the tables that the
    returned frame no longer reads; the rest goes when the driver's JVM ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.deleteOnExit(self._path(self.root))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def cut(self, df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
        df.write.option("compression", compression).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            self._fs.delete(self._path(self.path(name)), True)

    def release(self) -> None:
        """Collect finished plans, so that Spark removes the shuffle files of steps that were cut."""
        for _ in range(2):  # what one collection finds may hold plans until the next
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(1)


def row_key() -> Column:
    """Unique per row of one written table: call it only in a frame that ``cut`` writes."""
    return F.monotonically_increasing_id()


def fresh(base: str, taken: list[str]) -> str:
    """A column name like ``base`` that no input column uses (case-insensitively)."""
    low = {c.lower() for c in taken}
    name = base
    while name.lower() in low:
        name = f"_{name}"
    return name


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch so that each part holds about ``limit`` bytes of ``column`` (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    start = total = 0
    for i, n in enumerate(sizes.to_numpy(zero_copy_only=False)):
        if total and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    if start < batch.num_rows:
        yield batch.slice(start, batch.num_rows - start)
