"""Word statistics in bounded state (D2, D4, S2): sketches that are written per batch and merged later.

A sketch row holds the number of words, a HyperLogLog sketch of the distinct ones and a frequent-items sketch of
the hot ones. Its size is fixed by ``HLL_BITS`` and ``TRACKED``, whatever it has seen, and rows of batches, days or
partitions merge by union to what one pass over all words would give within the same bounds:

* distinct words: a relative standard error of 1.04 / sqrt(2^HLL_BITS), 0.8 % by default;
* a word's count: never off by more than ``count_error`` of all words; exact while no more than three quarters of
  ``TRACKED`` different words were seen. Every word more frequent than that bound is found.

Sketches are built with map-side partial aggregation, so a hot word is one entry per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

HLL_BITS = 14
TRACKED = 1 << 17


def count_error(n_words: int, tracked: int = TRACKED) -> float:
    """The most by which a count among ``n_words`` words may be off."""
    return 3.5 * n_words / tracked


_ALL = "_all"


def _grouped(df: DataFrame, group: list[str] | None):
    """One group for all rows, but none without rows: there is no sketch of nothing to merge."""
    return df.groupBy(*group) if group else df.groupBy(F.lit(0).alias(_ALL))


def word_sketch(words: DataFrame, group: list[str] | None = None, word: str = "word", tracked: int = TRACKED) -> DataFrame:
    """``(group..., n, distinct, hot)``: one sketch row per group; null words are not counted, no words give no row."""
    return _grouped(words.filter(F.col(word).isNotNull()), group).agg(
        F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(word, HLL_BITS).alias("distinct"),
        F.expr(f"approx_top_k_accumulate(`{word}`, {tracked})").alias("hot")).drop(_ALL)


def merged(sketches: DataFrame, group: list[str] | None = None, tracked: int = TRACKED) -> DataFrame:
    """Sketch rows merged by union, per group; none give no row."""
    return _grouped(sketches, group).agg(
        F.sum("n").alias("n"), F.hll_union_agg("distinct").alias("distinct"),
        F.expr(f"approx_top_k_combine(hot, {tracked})").alias("hot")).drop(_ALL)


def distinct_words(sketches: DataFrame) -> DataFrame:
    """Sketch rows with ``n_words``, the estimated number of distinct words."""
    return sketches.withColumn("n_words", F.hll_sketch_estimate("distinct"))


def hot_words(sketches: DataFrame, k: int) -> DataFrame:
    """``(word, n)`` of the ``k`` most frequent words of each sketch row."""
    return sketches.select(F.inline(F.expr(f"approx_top_k_estimate(hot, {k})")).alias("word", "n"))


def run_word_sketches(spark: SparkSession, source: str, out: str, checkpoint: str, key: str = "doc_id",
                      text: str = "text", max_files_per_trigger: int | None = None, tracked: int = TRACKED) -> DataFrame:
    """S2 in bounded state: a sketch row for each micro-batch of ``source``; the merged row.

    A micro-batch that is repeated after a loss overwrites its own row, and no state but these rows is kept.
    """
    from tokloom.operators import words as W
    from tokloom.streaming.incremental import read_stream

    def write(batch: DataFrame, batch_id: int) -> None:
        lines = W.lines(batch.select(key, F.col(text).alias("block")), key)
        word_sketch(W.words(lines, key), tracked=tracked).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    (read_stream(spark, source, max_files_per_trigger).writeStream.foreachBatch(write)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
    return merged(spark.read.parquet(out).drop("batch_id"), tracked=tracked)
