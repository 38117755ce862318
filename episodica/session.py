"""Checkpoints and scratch tables in the shared folder."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession


# Bytes of a table file whose rows one task of a shuffle holds, and that one task reads.
PARTITION_BYTES = 4 << 20
LEAST_PARTS = "spark.sql.adaptive.coalescePartitions.minPartitionNum"
READ_BYTES = 16 << 20


def spread_by_size(spark: SparkSession, path: str) -> None:
    """Let the session's shuffles have a partition for each PARTITION_BYTES of the table at ``path``, if they have fewer.

    So the memory of a task does not grow with the tables. Small shuffles are still
    coalesced, and a session that reads small tables keeps its settings.
    """
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = math.ceil(files.getContentSummary(at).getLength() / PARTITION_BYTES)
    if parts > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    if parts > max(spark.sparkContext.defaultParallelism, int(spark.conf.get(LEAST_PARTS, "1"))):
        spark.conf.set(LEAST_PARTS, parts)
        # Spark's default; another value is the user's.
        if spark.conf.get("spark.sql.files.maxPartitionBytes") == "134217728b":
            spark.conf.set("spark.sql.files.maxPartitionBytes", READ_BYTES)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and scratch tables.

    A cluster names it in ``spark.checkpoint.dir``. Where that is unset, it is a
    folder in the session's warehouse, which all executors see as well.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None and sc.getCheckpointDir() is None:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured or sc.getCheckpointDir()


def scratch_root(spark: SparkSession) -> str:
    """The folder of this application's scratch tables below the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/scratch-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{scratch_root(spark)}/{uuid.uuid4().hex}/{name}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that later branches read the same rows.

    The copy is a columnar table in the shared folder: it survives lost
    executors, and later readers take only the columns they need.
    """
    path = scratch_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean_up(spark: SparkSession) -> None:
    """Delete this application's scratch tables, once no result that reads them is needed any more."""
    sc = spark.sparkContext
    root = sc._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    root.getFileSystem(sc._jsc.hadoopConfiguration()).delete(root, True)
