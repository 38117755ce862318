"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows with texts that a Python worker gets at once.
BATCH_ROWS = 1000


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches hold at most BATCH_ROWS rows.

    Spark's default of 10,000 rows suits numbers; of texts, a task and its
    worker would hold tens of megabytes several times over. A smaller setting
    stays as it is.
    """
    key, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession.conf
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, BATCH_ROWS)
    return df


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at files that survive the loss of executors, and gives a
    join a plain exchange, whose large partitions Spark can split.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(column: str, n: int):
    """crc32 of the column's decimal text, modulo ``n``; null counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % n
