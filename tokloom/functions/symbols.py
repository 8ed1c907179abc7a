"""Symbol strings: one character per token id.

A word's UTF-8 bytes become characters U+0000..U+00FF (ISO-8859-1 decode of
the UTF-8 encoding); a merged or special id ``k`` is the character ``chr(k)``, or
``chr(k + 0x800)`` from the surrogate block on.
BPE merging is then the native, greedy, left-to-right, non-overlapping
``replace`` of a two-character string, and ids are recovered with ``ascii``
(which returns the full code point).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SURROGATES = 0xD800             # ids from here on skip the surrogate block
SKIP = 0x800
WORD_SEPARATOR = "\U0010ffff"     # the last code point; never part of a pair
MAX_SYMBOL_ID = 0x10FFFE - SKIP


def id_char(i: int) -> str:
    if not 0 <= i <= MAX_SYMBOL_ID:
        raise ValueError(f"token id {i} cannot be a symbol character")
    return chr(i if i < SURROGATES else i + SKIP)


def char_id(c: Column) -> Column:
    """Inverse of ``id_char`` for the first character of a string."""
    code = F.ascii(c)
    return F.when(code < SURROGATES, code).otherwise(code - SKIP).cast("int")


def word_to_sym(word: Column) -> Column:
    """String -> symbol string of its raw UTF-8 bytes."""
    return F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")


def sym_chars(sym: Column) -> Column:
    return F.filter(F.split(sym, ""), lambda c: c != F.lit(""))


def sym_to_ids(sym: Column) -> Column:
    """Symbol string -> array<int> of ids."""
    return F.transform(sym_chars(sym), char_id)


def ids_csv(ids: Column) -> Column:
    """array<int> -> '1,2,3' (arrays are compared as text by the oracle)."""
    return F.array_join(F.transform(ids, lambda i: i.cast("string")), ",")


def sym_to_ids_csv(sym: Column) -> Column:
    return ids_csv(sym_to_ids(sym))
