"""Lines, pre-tokens and word statistics.

Training reads the corpus line by line: each line keeps its ``\\n`` and is
pre-tokenised on its own, so whitespace runs never cross a line end there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tokloom.functions.pattern import PRETOKEN_PATTERN
from tokloom.functions.symbols import word_to_sym
from tokloom.operators.flatten import fold_newlines
from tokloom.operators.scan import prefix_sum, quantile_buckets
from tokloom.session import stored


def pretokens(text: Column, pattern: str = PRETOKEN_PATTERN) -> Column:
    """All pattern matches, left to right (Python ``findall`` equivalent)."""
    return F.regexp_extract_all(text, F.lit(pattern), 0)


def lines(blocks_df: DataFrame, key: str = "conv_id", text: str = "block") -> DataFrame:
    """A4: ``(key, line_no, line)``; every line keeps its ``\\n``.

    Split after each newline (zero-width look-behind), so every piece already
    ends in its ``\\n`` and only the empty piece after a final newline is
    dropped; an unterminated last line is kept as is. Newlines are folded
    first, as text-mode reading does.
    """
    parts = F.split(fold_newlines(F.col(text)), "(?<=\n)")
    return (blocks_df.select(key, F.posexplode(parts).alias("line_no", "line"))
            .filter(F.col("line") != "")
            .select(key, F.col("line_no").cast("int").alias("line_no"), "line"))


def words(lines_df: DataFrame, key: str = "conv_id", pattern: str = PRETOKEN_PATTERN
          ) -> DataFrame:
    """``(key, line_no, word_no, word)``, one row per pre-token occurrence."""
    return lines_df.select(key, "line_no",
                           F.posexplode(pretokens(F.col("line"), pattern))
                           .alias("word_no", "word"))


def position_key(key: Column, line_no: Column, word_no: Column) -> Column:
    """Exact order key of (key, line_no, word_no) as one ``DECIMAL(38,0)``.

    ``key * 2^62 + line_no * 2^31 + word_no`` is monotone in the triple for any
    bigint key and non-negative int positions, and -- unlike a struct -- keeps
    ``min`` on the hash-aggregate path (a struct minimum falls back to a sort).
    """
    d = "decimal(38,0)"
    return (key.cast(d) * F.lit(1 << 62).cast(d) + line_no.cast(d) * F.lit(1 << 31).cast(d)
            + word_no.cast(d)).cast(d)


def position_struct(pos: Column) -> Column:
    """Inverse of ``position_key`` for display: ``struct(k, line_no, word_no)``."""
    d = "decimal(38,0)"
    k = F.floor(pos / F.lit(1 << 62).cast(d))
    rest = pos - k.cast(d) * F.lit(1 << 62).cast(d)
    line = F.floor(rest / F.lit(1 << 31).cast(d))
    word = rest - line.cast(d) * F.lit(1 << 31).cast(d)
    return F.struct(k.cast("bigint").alias("k"), line.cast("int").alias("line_no"),
                    word.cast("int").alias("word_no"))


def word_frequency(words_df: DataFrame, key: str = "conv_id") -> DataFrame:
    """``(word, sym, n, first_pos)``.

    Hash aggregate with map-side partial counts, so a hot word (a single space
    is almost half of all words) is pre-combined in every task before the
    shuffle. ``first_pos`` (earliest occurrence, see ``position_key``)
    reproduces the insertion order the reference's dictionary uses to break ties.
    """
    pos = position_key(F.col(key), F.col("line_no"), F.col("word_no"))
    return (words_df.groupBy("word")
            .agg(F.count(F.lit(1)).alias("n"), F.min(pos).alias("first_pos"))
            .withColumn("sym", word_to_sym(F.col("word"))))


def distinct_word_count(freq: DataFrame, approx: bool = False) -> DataFrame:
    """Number of distinct pre-tokens, one row (``approx`` uses HyperLogLog++)."""
    if approx:
        return freq.agg(F.approx_count_distinct("word").alias("n_words"))
    return freq.agg(F.count(F.lit(1)).alias("n_words"))


def block_sizes(blocks_df: DataFrame, key: str = "conv_id", text: str = "block") -> DataFrame:
    """``(key, _kb)``: bytes of each chat's folded text, without exploding it."""
    return blocks_df.select(key, F.octet_length(fold_newlines(F.col(text))).cast("bigint")
                            .alias("_kb"))


def running_bytes(lines_df: DataFrame, key: str = "conv_id", max_bytes: int | None = None,
                  sizes: DataFrame | None = None) -> DataFrame:
    """Bytes of all earlier lines, in (key, line_no) order.

    Two levels: an exclusive prefix over per-chat byte totals (two-phase, by
    quantile buckets of ``key``), plus a window inside each chat -- a chat is
    one block row already, so that window never exceeds one input row's lines.
    ``sizes`` (see ``block_sizes``) saves summing the lines; either way the
    totals are stored once for the prefix. Rows without key are one chat, the first.
    """
    with_len = lines_df.withColumn("_b", F.octet_length("line").cast("bigint"))
    if sizes is None:
        sizes = with_len.select(key, F.col("_b").alias("_kb"))
    per_key, _ = stored(sizes.groupBy(key).agg(F.sum("_kb").alias("_kb")), "chat-bytes")
    bases = prefix_sum(quantile_buckets(per_key, key), [key], "_kb", "_kbase").select(
        F.col(key).alias("_key"), "_kbase")
    if max_bytes is not None:
        bases = bases.filter(F.col("_kbase") <= F.lit(max_bytes))
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    return (with_len.join(bases, F.col(key).eqNullSafe(F.col("_key")))
            .withColumn("bytes_before",
                        F.col("_kbase") + F.coalesce(F.sum("_b").over(w), F.lit(0)))
            .drop("_b", "_kbase", "_key"))


def budget_lines(lines_df: DataFrame, max_bytes: int | None, key: str = "conv_id",
                 sizes: DataFrame | None = None) -> DataFrame:
    """Keep a line iff the bytes of all earlier lines are <= ``max_bytes``.

    The test happens before a line is added, so the line that crosses the
    budget is still kept. Chats whose own start already exceeds the budget are
    dropped before the per-line window runs.
    """
    if max_bytes is None:
        return lines_df
    return running_bytes(lines_df, key, max_bytes, sizes).filter(F.col("bytes_before") <= F.lit(max_bytes))


def budget_blocks(blocks_df: DataFrame, max_bytes: int | None, key: str = "conv_id",
                  text: str = "block") -> DataFrame:
    """Chats that can hold lines kept by ``budget_lines`` (start <= budget).

    Chat sizes come from ``octet_length`` of the folded block (no explode); the
    kept chats are a prefix in ``key`` order, so line offsets computed on them
    alone are the same as on the whole corpus. Use before ``lines`` so a small
    training budget never explodes the rest of the corpus.
    """
    if max_bytes is None:
        return blocks_df
    sizes, _ = stored(block_sizes(blocks_df, key, text).groupBy(key).agg(F.sum("_kb").alias("_kb")), "chat-bytes")
    starts = prefix_sum(quantile_buckets(sizes, key), [key], "_kb", "_kbase")
    keep = starts.filter(F.col("_kbase") <= F.lit(max_bytes)).select(F.col(key).alias("_key"))
    return blocks_df.join(keep, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
