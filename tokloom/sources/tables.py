"""Parquet table access for the driver-provided (or production) tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SPREAD_BYTES = 16 << 20
LANDING_BYTES = 32 << 20        # of a stored table in one landed file


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or folder, from the file system's metadata."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(p).getLength()


def landing_files(n_bytes: int, least: int = 4) -> int:
    """Files in which a table of ``n_bytes`` lands, each of about ``LANDING_BYTES`` at most."""
    return max(least, -(-n_bytes // LANDING_BYTES))


def read_table(spark: SparkSession, base_dir: str, name: str, text_work: bool = False
               ) -> DataFrame:
    """``<base_dir>/<name>.parquet`` (a file or a folder of part files).

    ``text_work=True`` gives a table of less than ``SPREAD_BYTES`` per core one
    partition per core, for regex/BPE work; larger tables are read as they are.
    """
    path = f"{base_dir.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if text_work and stored_bytes(spark, path) < SPREAD_BYTES * cores:
        return df.repartition(cores)
    return df
