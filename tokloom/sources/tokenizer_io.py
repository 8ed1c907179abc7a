"""Tokenizer file save/load.

File shape: ``{"vocab_size": V, "merges": [[left, right, new_id], ...]}`` with
the merges in rank order (list position = rank). The merge table is bounded by
the vocabulary size, so it is written as a single JSON document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

TOKENIZER_SCHEMA = T.StructType([
    T.StructField("vocab_size", T.IntegerType()),
    T.StructField("merges", T.ArrayType(T.ArrayType(T.IntegerType()))),
])


def merges_to_json(merges: DataFrame, vocab_size: int = 32000) -> DataFrame:
    """One row ``json``: the tokenizer document built from a merge table."""
    ordered = F.array_sort(F.collect_list(
        F.struct("rank", F.array("left", "right", "new_id").alias("m"))))
    return merges.agg(ordered.alias("_m")).select(
        F.to_json(F.struct(F.lit(vocab_size).alias("vocab_size"),
                           F.transform("_m", lambda x: x["m"]).alias("merges"))).alias("json"))


def merges_from_json(df: DataFrame, col: str = "json") -> DataFrame:
    """Tokenizer document -> ``(rank, left, right, new_id, vocab_size)``."""
    doc = df.select(F.from_json(col, TOKENIZER_SCHEMA).alias("d"))
    return doc.select(F.col("d.vocab_size").alias("vocab_size"),
                      F.posexplode("d.merges").alias("rank", "m")).select(
        F.col("rank").cast("int").alias("rank"),
        F.col("m").getItem(0).alias("left"), F.col("m").getItem(1).alias("right"),
        F.col("m").getItem(2).alias("new_id"), "vocab_size")


def save_tokenizer(merges: DataFrame, path: str, vocab_size: int = 32000) -> None:
    """A5: write the document as one JSON text file under ``path``."""
    merges_to_json(merges, vocab_size).coalesce(1).write.mode("overwrite").text(path)


def load_tokenizer(spark: SparkSession, path: str) -> DataFrame:
    """Read a tokenizer document (ours, or a pretty-printed multi-line one)."""
    raw = spark.read.text(path, wholetext=True)
    return merges_from_json(raw.select(F.col("value").alias("json")))
