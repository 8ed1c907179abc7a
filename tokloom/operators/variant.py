"""H6: the byte-level library-tokenizer variant.

Differences from the default tokenizer: a GPT-2 style pre-token pattern (with a
look-ahead, so Java regex but not RE2), special tokens never take part in
training, and the specials are listed first -- ids ``0..s-1`` -- so byte and
merge ids are shifted up by ``s``. Ids are therefore not interchangeable with
the default tokenizer's. Tie-breaks follow this engine's BPE (count, then first
occurrence); matching the external library's own tie order is not promised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tokloom.functions.pattern import SPACE_CLASS, SPECIAL_TOKENS, special_alternation
from tokloom.operators import bpe, codec
from tokloom.operators.flatten import fold_newlines
from tokloom.operators.words import word_frequency
from tokloom.session import stored

# Published GPT-2 pre-tokenizer pattern, with ``\s`` spelled as the Unicode class.
BYTE_LEVEL_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
                      rf"| ?[^{SPACE_CLASS}\p{{L}}\p{{N}}]+|[{SPACE_CLASS}]+(?![^{SPACE_CLASS}])"
                      rf"|[{SPACE_CLASS}]+")


def variant_specials(specials: dict[str, int] | None = None) -> dict[str, int]:
    return {tok: i for i, tok in enumerate(specials or SPECIAL_TOKENS)}


def _tag_pattern(specials) -> str:
    return special_alternation(specials or SPECIAL_TOKENS)


def variant_words(lines_df: DataFrame, key: str = "conv_id") -> DataFrame:
    """``(key, line_no, word_no, word)`` with specials cut out as boundaries.

    Text is split at every special tag first (a tag is never merged and never
    glues its neighbours together); each piece is pre-tokenised on its own.
    """
    pieces = F.split(F.col("line"), _tag_pattern(None))
    ws = F.flatten(F.transform(pieces, _piece_words))
    return lines_df.select(key, "line_no", F.posexplode(ws).alias("word_no", "word"))


def _piece_words(piece: Column) -> Column:
    return F.regexp_extract_all(piece, F.lit(BYTE_LEVEL_PATTERN), 0)


def encode_byte_level(df: DataFrame, text_col: str, merges, key: str = "conv_id",
                      specials: dict[str, int] | None = None, out: str = "ids") -> DataFrame:
    """Encode ``(key, ids)`` with merges from ``train_byte_level`` (ids in the variant's space).

    The text is cut before and after each tag; a tag gives its own id, other
    pieces are pre-tokenised. Narrow, like the default encoder's plan C.
    """
    sp = variant_specials(specials)
    tags = _tag_pattern(sp)
    pieces = F.split(fold_newlines(F.col(text_col)), f"(?={tags})|(?<={tags})")
    words = F.flatten(F.transform(pieces, lambda p: F.when(p.isin(*sp), F.array(p)).otherwise(
        _piece_words(p))))
    return df.select(key, codec.words_to_ids(words, merges, sp, spark=df.sparkSession,
                                             first_byte=len(sp)).alias(out))


def byte_level_vocabulary(spark: SparkSession, merges, specials: dict[str, int] | None = None
                          ) -> DataFrame:
    """``(id, bytes)`` in the variant's space, for ``codec.decode``."""
    sp = variant_specials(specials)
    return bpe.vocabulary(spark, merges, sp, first_byte=len(sp))


def train_byte_level(lines_df: DataFrame, num_merges: int, key: str = "conv_id",
                     batched: bool = True) -> list[tuple[int, int, int, int]]:
    """Merges ``(left, right, new_id, c)`` in the variant's id space.

    Save and load them with ``tokenizer_io`` like any merge table.
    """
    freq, _ = stored(word_frequency(variant_words(lines_df, key), key), "byte-level-words")
    res = bpe.train(bpe.training_state(freq), num_merges=num_merges, batched=batched)
    s = len(SPECIAL_TOKENS)
    return [(a + s, b + s, n + s, c) for a, b, n, c in res.merges]
