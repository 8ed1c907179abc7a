"""Input filters and corpus reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tokloom.functions.pattern import END_MARKER, NON_SPACE_PATTERN, special_alternation
from tokloom.operators import codec
from tokloom.operators.flatten import fold_newlines, segment_expr
from tokloom.operators.words import pretokens

STOP_WORDS = ("quit", "exit")


def valid_inputs(turns: DataFrame, text: str = "text") -> DataFrame:
    """Drop stop words (case-folded, unstripped) and blank/whitespace-only text."""
    return turns.filter(~F.lower(F.col(text)).isin(*STOP_WORDS)
                        & F.col(text).rlike(NON_SPACE_PATTERN))


def has_literal_tag(text: str = "text"):
    """Q12: user text that spells a special tag becomes a special token."""
    return F.col(text).rlike(special_alternation())


def corpus_report(turns: DataFrame, merges, window: int) -> DataFrame:
    """``(metric, value)`` rows from one aggregate over the turns.

    Turns with a literal tag are counted per chat while the chat is flattened;
    lines, words and tokens are counted inside each chat's row, never exploded.
    """
    seg = segment_expr(F.col("role"), F.col("text"))
    tags = F.count(F.when(has_literal_tag(), 1)).alias("tag_turns")
    body = F.expr("listagg(seg, '') WITHIN GROUP (ORDER BY turn)").alias("body")
    chats = (turns.withColumn("seg", seg).groupBy("conv_id").agg(body, tags)
             .withColumn("block", F.concat("body", F.lit(END_MARKER))))
    lines = F.filter(F.split(fold_newlines(F.col("block")), "(?<=\n)"), lambda x: x != "")
    n_words = F.aggregate(lines, F.lit(0).cast("bigint"), lambda n, x: n + F.size(pretokens(x)))
    ids = codec.encode_native(F.col("block"), merges) if len(merges) <= codec.AUTO_NATIVE_MERGES \
        else codec.encode_arrow(F.col("block"), merges, spark=turns.sparkSession)
    one = chats.select("tag_turns", F.octet_length("block").alias("bytes"), F.size(lines).alias("lines"),
                       n_words.alias("words"), F.size(ids).alias("tokens"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("double").alias(c)
    sums = one.agg(F.count(F.lit(1)).cast("double").alias("chats"),
                   *map(total, ("bytes", "lines", "words", "tokens", "tag_turns")))
    n = F.col("tokens")
    examples = F.when(n > window, F.floor((n - 1) / window)).otherwise(F.lit(0)).cast("double")
    metrics = {"n_chats": F.col("chats"), "n_bytes": F.col("bytes"), "mb": F.col("bytes") / 1048576.0,
               "n_lines": F.col("lines"), "n_words": F.col("words"), "n_tokens": n,
               "n_examples": examples, "n_tag_turns": F.col("tag_turns")}
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("metric"), F.round(v, 6).alias("value")) for k, v in metrics.items()])))
