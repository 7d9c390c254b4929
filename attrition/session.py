"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}


def local_session(cores: str = "8", shuffle_partitions: str = "8") -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("attrition")
        .config("spark.driver.memory", os.environ.get("ATTRITION_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Local tables are a few megabytes: let all cores share them.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the
    executors would each see a different disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    # "local-cluster" has executors with folders of their own, like any other cluster.
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="attrition-")
    return _LOCAL_SCRATCH[app]


ADVISORY, DEFAULT_ADVISORY, TASK_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "67108864b", "16m"


def bound_tasks(spark: SparkSession) -> None:
    """Let a task take at most 16 MB of shuffled rows, unless the session says otherwise.

    Typed rows are up to ten times as large in memory as in a shuffle file, so Spark's 64 MB make tasks
    whose sorts go to disk as soon as a table is large enough to fill them.
    """
    if spark.conf.get(ADVISORY) == DEFAULT_ADVISORY:
        spark.conf.set(ADVISORY, TASK_BYTES)


def delete(spark: SparkSession, name: str) -> None:
    """Remove a file or folder of any store Spark can reach."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/attrition/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder that all executors can reach; ``clear_scratch`` removes them."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:8]}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote on the way; call it once results are taken."""
    delete(spark, scratch_root(spark))


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a scratch folder and read back: worked out once, and of known size to later joins."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
