"""Session helpers: shared scratch space, size estimates, durable cut points."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

_local_dirs: dict[str, str] = {}
_scratch: list[str] = []


def local_session(cores: int | str = "*", app: str = "tidemark", memory: str = "12g") -> SparkSession:
    """A session for tests and benchmarks on one machine; a cluster brings its own."""
    parts = os.cpu_count() if cores == "*" else int(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_settings(shuffle_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """SQL settings for a job that shuffles about this much: partitions of a size that fits a task.

    AQE merges partitions that turn out small and splits skewed ones, so the
    number may be generous.
    """
    return {
        "spark.sql.shuffle.partitions": str(max(200, -(-shuffle_bytes // partition_bytes))),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.session.timeZone": "UTC",
    }


def _setting(spark: SparkSession, key: str) -> str | None:
    value = spark.conf.get(key, None)
    return value or spark.sparkContext.getConf().get(key)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local session without the setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its machine.
    """
    root = _setting(spark, CHECKPOINT_CONF)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end the scratch folders made inside; frames that read them end with it."""
    start = len(_scratch)
    try:
        yield
    finally:
        for path in _scratch[start:]:
            delete_path(spark, path)
        del _scratch[start:]


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def delete_path(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.delete(target, True)


def durable(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Later stages start from files that outlive any executor, and a frame used
    several times is computed once.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """Size of the inputs a plan reads, after pruning, by Catalyst's statistics; no job is run.

    The estimate for the plan itself is no use here: it multiplies the sides of a join.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
