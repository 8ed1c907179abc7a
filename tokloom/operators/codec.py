"""Encode and decode (H4, H5, H8, C1-C3, B6) and the tokenizer contract (H7).

Encoding pre-tokenises a whole block (so whitespace runs may span line ends,
unlike training), maps a special word straight to its id and applies the merge
table to every other word in rank order -- equivalent to the repeated
"lowest-rank pair first" loop, because a pair that contains a merged symbol
always ranks after that symbol's own merge.

Three physical plans:

* plan A (<= ``NATIVE_MERGE_LIMIT`` merges): one narrow projection per block --
  word symbols joined with a separator that belongs to no pair, a chain of
  native ``replace`` calls, then code points back to ids. No shuffle, no
  explode, whole-stage code generation.
* plan B (any size): each *distinct* word is encoded once by an Arrow-batched
  pandas function with the merge table broadcast (bounded by the vocabulary
  size), and the occurrences are joined back. Hot words (a single space is
  almost half of all words) are broadcast from a size-capped dictionary of the
  most frequent words; the long tail is shuffle-joined, where no key can be
  larger than the cap's cut-off count.
* plan C (any size, the default beyond a few merges): pre-tokenise in the JVM,
  then one Arrow-batched iterator function maps each word list to ids
  with a memo that lives as long as the task. Narrow like plan A, linear in the
  text whatever the merge count, without plan B's two shuffles of the token
  stream, and the same in batch and streaming plans.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tokloom.functions.arrow_lists import PIECE, gather, give_back, pieces, string_pieces
from tokloom.functions.pattern import SPECIAL_TOKENS, pretoken_pattern
from tokloom.functions.symbols import (MAX_SYMBOL_ID, WORD_SEPARATOR, char_id, id_char, ids_csv,
                                       word_to_sym)
from tokloom.operators.bpe import apply_merges, merge_list
from tokloom.operators.flatten import fold_newlines
from tokloom.operators.merge_arrays import MergeTable, encode_words as encode_distinct
from tokloom.operators.words import pretokens

NATIVE_MERGE_LIMIT = 256
AUTO_NATIVE_MERGES = 16
MEMO_WORDS = 500_000        # per-task word -> ids cache entries (plan C)
MEMO_BYTES = 8 << 20        # of their words
HOT_WORDS = 20_000          # rows in the broadcast part of the word dictionary


def special_symbol(word: Column, specials: dict[str, int] | None = None) -> Column:
    """Special word -> its one-character symbol; else the byte symbols."""
    sp = specials or SPECIAL_TOKENS
    out = None
    for tok, i in sp.items():
        cond = word == F.lit(tok)
        out = F.when(cond, F.lit(id_char(i))) if out is None else out.when(cond, F.lit(id_char(i)))
    return out.otherwise(word_to_sym(word))


def encode_native(text: Column, merges, specials: dict[str, int] | None = None,
                  pattern: str | None = None) -> Column:
    """H4 plan A: text -> array<int> ids as one native expression.

    ``pattern`` is derived from ``specials`` unless it is given.
    """
    pattern = pattern or pretoken_pattern(specials)
    ms = merge_list(merges)
    if len(ms) > NATIVE_MERGE_LIMIT:
        raise ValueError(f"plan A handles at most {NATIVE_MERGE_LIMIT} merges; use encode_words")
    sym = F.array_join(F.transform(pretokens(fold_newlines(text), pattern),
                                   lambda w: special_symbol(w, specials)), WORD_SEPARATOR)
    merged = apply_merges(sym, ms)
    chars = F.filter(F.split(merged, ""),
                     lambda c: (c != F.lit("")) & (c != F.lit(WORD_SEPARATOR)))
    return F.transform(chars, char_id)


def encode(df: DataFrame, text_col: str, merges, key: str = "conv_id",
           specials: dict[str, int] | None = None, out: str = "ids", plan: str = "auto",
           hot: dict[str, list[int]] | None = None) -> DataFrame:
    """H4: ``(key, ids)``.

    ``plan``: ``native`` (A), ``dictionary`` (B), ``arrow`` (C) or ``auto`` --
    A for short merge tables (each merge is one pass over the text), else C.
    """
    ms = merge_list(merges)
    if plan == "auto":
        plan = "native" if len(ms) <= AUTO_NATIVE_MERGES else "arrow"
    if plan == "native":
        return df.select(key, encode_native(F.col(text_col), ms, specials).alias(out))
    if plan == "dictionary":
        return encode_words(df, text_col, ms, key, specials, out)
    return df.select(key, encode_arrow(F.col(text_col), ms, specials, hot=hot,
                                       spark=df.sparkSession).alias(out))


def encode_arrow(text: Column, merges, specials: dict[str, int] | None = None,
                 pattern: str | None = None, hot: dict[str, list[int]] | None = None,
                 spark=None) -> Column:
    """H4 plan C: JVM pre-tokenisation, then ``words_to_ids``. Null texts stay null."""
    return words_to_ids(pretokens(fold_newlines(text), pattern or pretoken_pattern(specials)),
                        merges, specials, hot, spark)


def words_to_ids(words: Column, merges, specials: dict[str, int] | None = None,
                 hot: dict[str, list[int]] | None = None, spark=None, first_byte: int = 0
                 ) -> Column:
    """Arrow-batched array of words -> array of ids.

    Narrow (no shuffle, no explode). The merge table and an optional dictionary
    of hot words (see ``hot_word_ids``) travel as one broadcast variable --
    fetched once per executor, both bounded (vocabulary size, row cap). The
    table and the memo, seeded with the hot words, are built once per task; each bounded
    piece of a batch is dictionary-encoded by Arrow, its distinct new words are merged together
    (``merge_arrays``), and the ids of all its words are gathered by offsets,
    without a Python step per token. ``first_byte`` is the id of byte 0.
    """
    from pyspark.sql import SparkSession

    ms = merge_list(merges)
    sp = dict(specials or SPECIAL_TOKENS)
    sc = (spark or SparkSession.getActiveSession()).sparkContext
    packed = lambda ids: np.array(ids, "<i4").tobytes()
    seed = {w: packed(ids) for w, ids in (hot or {}).items()} | {w: packed([i]) for w, i in sp.items()}
    shared = sc.broadcast((ms, seed))

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def _enc(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        merges, seed = shared.value
        yield from encoded(batches, merges, seed, first_byte)

    return _enc(words)


def encoded(batches: Iterator[pa.Array], merges, seed: dict[str, bytes], first_byte: int = 0) -> Iterator[pa.Array]:
    """The ids of lists of words, by bounded pieces; ``seed`` has the ids of known words as bytes."""
    table, memo, held = MergeTable(merges), dict(seed), 0
    for batch in batches:
        for lists in string_pieces(batch):
            coded = lists.flatten().dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            new = [w for w in distinct if w not in memo]
            held += sum(map(len, new))
            if len(memo) + len(new) > MEMO_WORDS or held > MEMO_BYTES:        # bounded cache, results unchanged
                memo = dict(seed)
                new = [w for w in distinct if w not in memo]
                held = sum(map(len, new))
            memo.update(zip(new, encode_distinct([w.encode("utf-8") for w in new], table, first_byte)))
            yield _gathered(lists, coded.indices, [memo[w] for w in distinct])
        batch = lists = coded = None
        give_back()


def _gathered(lists: pa.Array, words: pa.Array, ids: list[bytes]) -> pa.Array:
    """The ids of each list's words in turn; ``words`` are numbers into ``ids``, null lists stay null."""
    word = words.to_numpy()
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    flat = np.frombuffer(b"".join(ids), "<i4")
    first = np.concatenate([[0], np.cumsum(size)])[:-1]
    values, ends = gather(flat, first[word], size[word])
    count = lists.value_lengths().fill_null(0).to_numpy()
    bounds = ends[np.concatenate([[0], np.cumsum(count)])]
    if bounds[-1] > np.iinfo(np.int32).max:
        raise ValueError("too many tokens in one batch; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    mask = pa.array(np.array(lists.is_null())) if lists.null_count else None
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values), mask=mask)


def hot_word_ids(freq: DataFrame, merges, n: int = HOT_WORDS,
                 specials: dict[str, int] | None = None) -> dict[str, list[int]]:
    """The ``n`` most frequent words of a frequency table ``(word, n)`` with
    their ids: encoded in parallel (``word_dictionary``), then collected --
    a row-capped dictionary for ``encode_arrow``'s broadcast."""
    top = freq.select("word", F.col("n").alias("cnt")).orderBy(F.desc("cnt"), F.asc("word")).limit(n)
    rows = word_dictionary(top, merges, specials).select("word", "ids").collect()
    return {r["word"]: list(r["ids"]) for r in rows}


# ---- plan B: distinct-word dictionary ---------------------------------------

def word_dictionary(distinct_words: DataFrame, merges, specials: dict[str, int] | None = None
                    ) -> DataFrame:
    """``(word, ids)`` for each distinct word, via ``mapInPandas``.

    The merge list travels in the task closure; it is bounded by the vocabulary
    size (checked), never by the corpus.
    """
    ms = merge_list(merges)
    sp = dict(specials or SPECIAL_TOKENS)

    def run(batches):
        table = MergeTable(ms)
        for pdf in batches:
            ids = encode_distinct([w.encode("utf-8") for w in pdf["word"]], table)
            yield pdf.assign(ids=[[sp[w]] if w in sp else np.frombuffer(i, "<i4").tolist()
                                  for w, i in zip(pdf["word"], ids)])

    schema = T.StructType(list(distinct_words.schema.fields)
                          + [T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return distinct_words.mapInPandas(run, schema)


def encode_words(df: DataFrame, text_col: str, merges, key: str = "conv_id",
                 specials: dict[str, int] | None = None, out: str = "ids",
                 hot_words: int = HOT_WORDS) -> DataFrame:
    """H4 plan B: distinct-word dictionary joined back to the occurrences.

    1. distinct words with counts (partial aggregation), encoded once each and
       materialised with a reliable checkpoint;
    2. the ``hot_words`` most frequent entries (a proven row bound) are
       broadcast-joined to every occurrence;
    3. remaining occurrences shuffle-join the cold dictionary. Occurrences the
       hot side already resolved get a unique salted key that matches nothing,
       so the hottest word is spread over all partitions instead of one;
    4. ids are regrouped per block in position order. Every key keeps its row:
       an empty text gives no ids, a null text null. ``key`` must be unique.
    """
    from tokloom.session import stored
    occ = df.select(key, F.col(text_col).isNotNull().alias("some"),
                    F.posexplode_outer(pretokens(fold_newlines(F.col(text_col)),
                                                 pretoken_pattern(specials))).alias("pos", "word"))
    counts = (occ.filter("word is not null").groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    dictionary, _ = stored(word_dictionary(counts, merges, specials), "dictionary")
    hot = (dictionary.orderBy(F.desc("n"), F.asc("word")).limit(hot_words)
           .select("word", F.col("ids").alias("hot_ids")))
    cold = dictionary.select(F.col("word").alias("jk"), F.col("ids").alias("cold_ids"))
    salted = F.when(F.col("hot_ids").isNull() & F.col("word").isNotNull(), F.col("word")).otherwise(
        F.concat(F.lit(WORD_SEPARATOR + "hot:"), F.col(key).cast("string"), F.lit(":"),
                 F.col("pos").cast("string")))
    resolved = (occ.join(F.broadcast(hot), "word", "left")
                .withColumn("jk", salted)
                .join(cold, "jk", "left")
                .select(key, "some", "pos", F.coalesce("hot_ids", "cold_ids").alias("ids")))
    parts = F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "ids"))))
    ids = F.flatten(F.transform("_p", lambda s: s["ids"]))
    return (resolved.groupBy(key).agg(F.max("some").alias("some"), parts.alias("_p"))
            .select(key, F.when(F.col("some"), ids).alias(out)))


# ---- decode -------------------------------------------------------------------

def _vocab_dict(vocab: DataFrame) -> dict[int, bytes]:
    rows = vocab.select("id", "bytes").limit(MAX_SYMBOL_ID + 2).collect()
    if len(rows) > MAX_SYMBOL_ID + 1:
        raise ValueError("vocabulary larger than the symbol id space")
    return {r["id"]: bytes(r["bytes"]) for r in rows}


def decode(df: DataFrame, ids_col: str, vocab: DataFrame, out: str = "text") -> DataFrame:
    """H5: ids -> text; malformed UTF-8 becomes U+FFFD; unknown ids raise.

    Narrow Arrow-batched projection with the vocabulary (bounded by the vocabulary size) as a broadcast variable: the
    tokens' bytes lie in one flat buffer, and those of a bounded piece of a batch are gathered by offsets. No explode,
    no shuffle of tokens.
    """
    entries = _vocab_dict(vocab)
    size = np.zeros(max(entries, default=-1) + 2, np.int64)
    for i, token in entries.items():
        size[i] = len(token)
    known = np.zeros(len(size), bool)
    known[list(entries)] = True
    shared = df.sparkSession.sparkContext.broadcast((size, known, b"".join(entries[i] for i in sorted(entries))))

    @F.arrow_udf(T.StringType())
    def _dec(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from decoded(batches, *shared.value)

    return df.withColumn(out, _dec(F.col(ids_col)))


def decoded(batches: Iterator[pa.Array], size: np.ndarray, known: np.ndarray, data: bytes) -> Iterator[pa.Array]:
    """The texts of lists of ids, by bounded pieces; the bytes of known ids lie in ``data`` in turn of the ids."""
    data = np.frombuffer(data, np.uint8)
    start = np.concatenate([[0], np.cumsum(size)])[:-1]
    for batch in batches:
        for ids in pieces(batch):
            flat = ids.flatten()
            if flat.null_count:
                raise KeyError("a null id")
            parts, all_ends = [], [np.zeros(1, np.int64)]
            for at in range(0, len(flat), PIECE):            # a long list, too, by bounded parts
                token = flat[at:at + PIECE].to_numpy().astype(np.int64)
                wrong = (token < 0) | (token >= len(size))
                wrong |= ~known[np.where(wrong, 0, token)]
                if wrong.any():
                    raise KeyError(int(token[wrong][0]))
                part, ends = gather(data, start[token], size[token])
                parts.append(part.tobytes())
                all_ends.append(ends[1:] + all_ends[-1][-1])
            text, ends = b"".join(parts), np.concatenate(all_ends)
            bounds = ends[np.concatenate([[0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy())])].tolist()
            out = [text[a:b].decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:])]
            yield pa.array([None if gone else t for t, gone in zip(out, ids.is_null().to_pylist())], pa.string())
        batch = ids = flat = None
        give_back()


def unknown_ids(df: DataFrame, ids_col: str, vocab: DataFrame, key: str = "conv_id"
                ) -> DataFrame:
    """``(key, pos, id)`` for ids with no vocabulary entry (anti-join).

    The vocabulary side is bounded by the vocabulary size, so it is broadcast.
    """
    occ = df.select(key, F.posexplode(ids_col).alias("pos", "id"))
    return occ.join(F.broadcast(vocab.select("id")), "id", "left_anti").select(key, "pos", "id")


def range_violations(df: DataFrame, ids_col: str, vocab_size: int, max_len: int | None = None,
                     key: str = "conv_id") -> DataFrame:
    """Rows whose ids leave ``[0, vocab_size)`` or whose length exceeds ``max_len``."""
    bad = F.filter(ids_col, lambda i: (i < 0) | (i >= vocab_size))
    cond = F.size(bad) > 0
    if max_len is not None:
        cond = cond | (F.size(ids_col) > max_len)
    return df.select(key, F.size(bad).alias("n_bad"), ids_csv(F.array_sort(F.array_distinct(bad))).alias("bad_ids"),
                     F.size(ids_col).alias("n_ids")).filter(cond)


class Tokenizer(Protocol):
    """H7: anything with ``vocab_size`` and a DataFrame encode can feed packing."""

    vocab_size: int

    def encode_df(self, df: DataFrame, text_col: str, key: str = "conv_id") -> DataFrame:
        ...


class MergeTableTokenizer:
    """H7 implementation backed by a merge table (list or DataFrame)."""

    def __init__(self, merges, vocab_size: int = 32000, specials: dict[str, int] | None = None):
        self.merges = merge_list(merges)
        self.vocab_size = vocab_size
        self.specials = specials or SPECIAL_TOKENS

    def encode_df(self, df: DataFrame, text_col: str, key: str = "conv_id") -> DataFrame:
        return encode(df, text_col, self.merges, key, self.specials)
