"""Session helpers: a tuned local session for tests/bench, and the shared
scratch area derived from ``spark.checkpoint.dir``.

On a cluster the checkpoint directory is a shared folder named by the
cluster configuration; we only read it.  We set one ourselves only when the
session has none (local tests), and then under a fresh ``mktemp`` folder.
"""

from __future__ import annotations

import tempfile
from contextlib import contextmanager
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "kestrel") -> SparkSession:
    """Session for tests and the local bench (the cluster brings its own)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def size_for_input(spark: SparkSession, input_bytes: int,
                   scan_partition_bytes: int = 256 << 20,
                   shuffle_partition_bytes: int = 512 << 20,
                   max_shuffle_partitions: int = 1_000_000) -> dict[str, str]:
    """Size scans and shuffles for an input of ``input_bytes`` (for example
    ``operators.sampling.estimated_bytes(df)`` of the job's source) and
    return the settings made.

    Scan splits of ``scan_partition_bytes``; an initial shuffle width of one
    partition per ``shuffle_partition_bytes`` of input (at least the cluster's
    default parallelism, at most ``max_shuffle_partitions`` so the map x
    reduce block count stays manageable), which AQE then coalesces towards
    half of that per partition, or splits where a key is skewed.  Call once
    per job, before building the plans.
    """
    parallelism = spark.sparkContext.defaultParallelism
    width = -(-int(input_bytes) // shuffle_partition_bytes)
    width = max(parallelism, min(max_shuffle_partitions, width))
    settings = {
        "spark.sql.files.maxPartitionBytes": str(scan_partition_bytes),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    return settings


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, stream checkpoints and written tables.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset
    AND the master is local (tests, the local bench) is a fresh temporary
    folder created and registered; on a cluster an unset value is an error.
    """
    root = spark.conf.get(_CKPT_KEY, None)
    if not root:
        sc_dir = spark.sparkContext.getCheckpointDir()
        if sc_dir:
            return sc_dir.rstrip("/")
        if not spark.sparkContext.master.startswith("local"):
            # a machine-local folder would vanish with the executor that wrote it
            raise RuntimeError(f"set {_CKPT_KEY} to a shared folder (HDFS/object store) "
                               "for checkpoints, stream state and scratch tables")
        root = tempfile.mkdtemp(prefix="kestrel-ckpt-")
        spark.conf.set(_CKPT_KEY, root)
    spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_made: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint area."""
    path = f"{checkpoint_root(spark)}/kestrel/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders that this driver handed out, through Hadoop's
    file system (they may be on HDFS or an object store), and return how many.
    Call it when the results that read them have been written; DataFrames that
    are not yet executed may still need them."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str):
    """One of the driver's parquet tables (columnar scan, pushdown, pruning)."""
    return spark.read.parquet(table_path(sf_dir, name))


@contextmanager
def cached(df, level=None):
    """Persist ``df`` for the block and release it afterwards (the surveyed
    jobs cached intermediates and never unpersisted them).  Default level
    MEMORY_AND_DISK: a lost block is recomputed from lineage."""
    from pyspark import StorageLevel
    kept = df.persist(level or StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def clear_caches(spark: SparkSession) -> None:
    """Drop every cached table and frame of the session."""
    spark.catalog.clearCache()
