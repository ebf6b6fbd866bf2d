"""Session construction and the few settings the operators rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library needs regardless of deployment.  Sizing knobs
# (shuffle partitions, file split size) are only defaults: a cluster
# submit overrides them with --conf.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a checkpoint's files go when nothing refers to it any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "vireo",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Return (or create) a session configured for the operators.

    ``master`` is only meant for tests and local benches; on a cluster the
    submit command chooses it.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage.

    A cluster names it in ``spark.checkpoint.dir``; we read it from the
    session.  Only a local master (tests, a laptop) may fall back to a
    scratch folder of its own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions manage the folder server-side
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(a machine-local folder cannot hold checkpoints)")
        d = tempfile.mkdtemp(prefix="vireo-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def sizing(input_bytes: int, partition_bytes: int = 256 << 20) -> dict:
    """Shuffle and scan settings for an input of ``input_bytes``.

    Partitions are sized to ``partition_bytes`` (they must fit an executor
    core's share of memory with room to sort and spill); AQE starts from that
    many shuffle partitions and coalesces the small ones.  Pass the result as
    ``extra`` to :func:`build_session` or as ``--conf`` on submit.
    """
    n = max(1, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        # coalesce to the advisory size, not to the default parallelism
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
    }
