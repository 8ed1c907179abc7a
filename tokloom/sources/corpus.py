"""Corpus text sink and materialised stages.

A3  blocks -> text files. Range-partitioned and sorted by ``conv_id``, so the
    part files concatenated in name order are the corpus in chat order. The
    text writer ends every row with ``\\n``, so each block's final ``\\n`` is
    dropped before writing (an empty line separator is not accepted).
A7  token cache keyed by a fingerprint of the input files, the merge table and
    the window length; reused only when the folder holds ``_SUCCESS``.
A9  skip-if-done stages: the same ``_SUCCESS`` test for any stage output.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tokloom.functions.pattern import END_MARKER
from tokloom.operators.bpe import merge_list


FILE_BYTES = 128 << 20


def write_corpus(blocks: DataFrame, path: str, key: str = "conv_id",
                 num_files: int | None = None) -> None:
    """A3: write blocks as a UTF-8 text corpus (ordered part files of about ``FILE_BYTES``)."""
    n = num_files or max(1, math.ceil((corpus_size(blocks).first()["n_bytes"] or 0) / FILE_BYTES))
    body = F.expr("substring(block, 1, length(block) - 1)")
    (blocks.repartitionByRange(n, key).sortWithinPartitions(key)
     .select(body.alias("value")).write.mode("overwrite").text(path))


def corpus_size(blocks: DataFrame) -> DataFrame:
    """A3 size report: ``(n_bytes, mb)``."""
    return blocks.agg(F.sum(F.octet_length("block")).cast("bigint").alias("n_bytes")).select(
        "n_bytes", F.round(F.col("n_bytes") / 1048576.0, 6).alias("mb"))


def read_corpus_blocks(spark: SparkSession, path: str, on_invalid: str = "replace") -> DataFrame:
    """A4: ``(file, at, block)`` of a corpus text, one chat per row, split at the end marker.

    ``at`` orders the blocks of a file. Files are split like any text, so a file of any size
    is read in parallel and no row is longer than a chat. Bytes that are not
    UTF-8: ``replace`` (U+FFFD), ``drop`` (left out) or ``fail``. Text after
    the last marker is a block of its own, without one.
    """
    if on_invalid not in ("replace", "drop", "fail"):
        raise ValueError(f"on_invalid: {on_invalid!r}")
    raw = spark.read.option("lineSep", END_MARKER).text(path).select(
        F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"),
        F.col("value"))
    good = F.is_valid_utf8("value")
    bad = {"replace": F.make_valid_utf8("value"),
           "drop": F.replace(F.make_valid_utf8("value"), F.lit("\ufffd"), F.lit("")),
           "fail": F.raise_error(F.lit("the corpus holds bytes that are not UTF-8"))}[on_invalid]
    text = F.when(good, F.col("value")).otherwise(bad)
    return raw.select("file", "at", F.concat(text, F.lit(END_MARKER)).alias("block"))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def is_complete(spark: SparkSession, path: str) -> bool:
    return _exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def fingerprint(inputs: DataFrame, merges, window: int | None = None, **settings) -> str:
    """Input files (name, length, modification time), merge table, window length and all
    ``settings`` that shape the tokens (role map, specials, pattern ...).

    The files' names and times are folded into counts and hash sums by Spark, so their number doesn't
    matter. An input without files has no identity to key a cache by and is refused.
    """
    key = F.sha2(F.concat_ws("|", "p", F.col("s").cast("string"), "t"), 256)
    part = lambda k: F.sum(F.conv(F.substring(key, 1 + 12 * k, 12), 16, 10).cast("decimal(38,0)"))
    try:
        files = inputs.select(F.col("_metadata.file_path").alias("p"),
                              F.col("_metadata.file_size").alias("s"),
                              F.col("_metadata.file_modification_time").cast("string").alias("t")).distinct()
        n, *sums = files.agg(F.count(F.lit(1)), *[part(k) for k in range(5)]).first()
    except AnalysisException as e:
        raise ValueError("a token cache needs an input that is read from files") from e
    if not n:
        raise ValueError("a token cache needs at least one input file with rows")
    doc = json.dumps({"files": [n, *map(str, sums)], "merges": [list(m) for m in merge_list(merges)],
                      "window": window, "settings": settings}, sort_keys=True)
    return hashlib.sha256(doc.encode("utf-8")).hexdigest()[:24]


def materialized(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Reuse ``path`` when finished, else build, write and read it back."""
    if not is_complete(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def cached_tokens(spark: SparkSession, cache_root: str, inputs: DataFrame, merges,
                  build: Callable[[], DataFrame], window: int | None = None, **settings) -> DataFrame:
    """Token table at ``cache_root/<fingerprint>``; a retrained tokenizer, changed
    input or other settings get a new folder instead of a stale hit.

    ``inputs`` is the file-based table that the tokens come from.
    """
    key = fingerprint(inputs, merges, window, **settings)
    return materialized(spark, f"{cache_root.rstrip('/')}/{key}", build)
