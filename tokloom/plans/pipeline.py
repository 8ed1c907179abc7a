"""End-to-end entries: tokenizer training and corpus -> batches.

Both are lazy DataFrame chains with a few deliberate materialisation points
(reliable checkpoints or written tables), which are also the restart points
after a failure:

* ``train_tokenizer``: chats -> blocks -> lines -> byte budget -> words ->
  frequency table (materialised) -> BPE rounds. All text is learned from
  unless a byte budget is given (``TRAIN_MAX_BYTES`` is the usual one).
* ``corpus_to_batches``: blocks -> encode -> token table (cached by
  fingerprint) -> offsets -> windows -> (x, y) -> per-epoch shuffled batches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tokloom.functions.pattern import DEFAULT_VOCAB_SIZE, PRETOKEN_PATTERN
from tokloom.operators import bpe, codec, flatten, pack, pair_index, words as W
from tokloom.session import stored
from tokloom.sources import corpus as C


@dataclass
class Tokenizer:
    merges: list[tuple[int, int, int, int]]
    rounds: int
    vocab_size: int = DEFAULT_VOCAB_SIZE
    hot: dict | None = None          # most frequent training words -> ids (bounded)


def train_tokenizer(turns: DataFrame, num_merges: int | None = None,
                    vocab_size: int = DEFAULT_VOCAB_SIZE,
                    max_bytes: int | None = None, exclude_special: bool = False,
                    role_map: dict | None = None, progress=None) -> Tokenizer:
    """Entry 2: learn the merge table from a flat ``(conv_id, turn, role, text)`` table."""
    blocks = W.budget_blocks(flatten.blocks(turns, role_map), max_bytes)
    lines = W.budget_lines(W.lines(blocks), max_bytes)
    freq, _ = stored(W.word_frequency(W.words(lines)), "words")
    state, _ = stored(bpe.training_state(freq, exclude_special), "bpe-state")
    res = pair_index.train_indexed(state, num_merges=num_merges, vocab_size=vocab_size, progress=progress)
    hot = codec.hot_word_ids(freq, res.merges)
    return Tokenizer(res.merges, res.rounds, vocab_size, hot)


@dataclass
class Batches:
    tokens: DataFrame        # (conv_id, ids, n, start)
    examples: DataFrame      # (example_id, x, y)
    batches: DataFrame       # (epoch, step, slot, example_id, x, y)


def corpus_to_batches(turns: DataFrame, merges, window: int = 256, batch_size: int = 32,
                      epochs: int = 10, seed: int = 7, cache_root: str | None = None,
                      role_map: dict | None = None, hot: dict | None = None) -> Batches:
    """Entry 1: encode the corpus and cut it into shuffled training batches.

    With ``cache_root`` the token table (ids plus global offsets) is written
    under a fingerprint of the input files and the merge table and reused while
    that folder is complete; otherwise it is a reliable checkpoint.
    """
    blocks = flatten.blocks_in_order(turns, role_map)

    def build() -> DataFrame:
        # the offsets are stored with the ids, so re-windowing only shuffles window slices
        return pack.token_offsets(codec.encode(blocks, "block", merges, hot=hot), ordered=True)

    if cache_root:
        tokens = C.cached_tokens(turns.sparkSession, cache_root, turns, merges, build,
                                 role_map=role_map or flatten.DEFAULT_ROLE_MAP,
                                 pattern=PRETOKEN_PATTERN)
    else:
        tokens = build()
    win, _ = stored(pack.windows(tokens, window), "windows")
    examples = pack.xy(win, window)
    ranked = pack.shuffled(win, seed, epochs=epochs)
    out = pack.batches(ranked, batch_size).select(
        F.col("epoch").cast("int").alias("epoch"), "step", "slot", "example_id")
    return Batches(tokens, examples, pack.with_xy(out, win, window))
