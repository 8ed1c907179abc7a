"""Shared helpers of the training-data operators: table access, scratch tables and seeded hashing."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tokloom.session import ensure_checkpoint_dir

LETTERS_UP = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS_LOW = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which all executors share."""
    return posixpath.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage like ``checkpoint()`` and survives lost executors, and,
    unlike a checkpoint, gives the planner a true size, so a join broadcasts the
    table only when it is under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc32_of_id(doc_id: str = "doc_id"):
    """crc32 of the id's decimal text; null ids give null."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def named_rows(df: DataFrame, **columns: str) -> DataFrame:
    """Only the wanted columns, under fixed names and types (``name='type'``).

    Extra columns, whatever they are called, never reach an operator's plan.
    """
    return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in columns.items()])


def small(keys: DataFrame, most: int = 2_000_000) -> DataFrame:
    """A stored table of narrow rows, marked for broadcast only while it is counted to have at most ``most`` rows."""
    return F.broadcast(keys) if keys.limit(most + 1).count() <= most else keys
