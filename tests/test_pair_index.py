"""Training with the pair index: merge by merge the strict result, whatever the batches and bounds."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.bruteforce import train as py_train
from tokloom.operators import bpe, flatten, pair_index as P, words as W


def state_of(spark, lines):
    rows = [(k, line) for k, line in enumerate(lines)]
    found = W.lines(spark.createDataFrame(rows, "conv_id long, block string"))
    return bpe.training_state(W.word_frequency(W.words(found)))


def test_whole_corpus(spark, sf_small):
    lines = W.lines(flatten.blocks(spark.read.parquet(f"{sf_small}/conversations.parquet")))
    texts = [r["line"] for r in lines.orderBy("conv_id", "line_no").collect()]
    got = P.train_indexed(bpe.training_state(W.word_frequency(W.words(lines))), 400, rewrite=128)
    assert got.merges == py_train(texts, 400)
    assert got.rounds < 100


@pytest.mark.parametrize("batch, rewrite, hot", [(192, 512, 400_000), (1, 3, 400_000), (7, 5, 6), (40, 1000, 12)])
def test_ties_runs_and_bounds(spark, batch, rewrite, hot):
    """Few letters make equal symbols in a row, ties everywhere and places that lag."""
    rnd = random.Random(batch)
    lines = [" ".join("".join(rnd.choices("aab", k=rnd.randrange(1, 30))) for _ in range(rnd.randrange(1, 9)))
             for _ in range(25)] + ["zz yy zz yy xx", "é日本 é日本"]
    limit = 10_000 if batch > 10 else 40
    got = P.train_indexed(state_of(spark, lines), limit, batch=batch, rewrite=rewrite, hot=hot)
    want = py_train(lines, limit)
    assert got.merges == want
    assert len(want) < 10_000  # without a limit every word becomes one symbol


def test_nothing_to_merge(spark):
    assert P.train_indexed(state_of(spark, ["a b", ""]), 5).merges == []
    assert P.train_indexed(state_of(spark, ["ab ab"]), 0).merges == []
    with pytest.raises(ValueError):
        P.train_indexed(state_of(spark, ["ab"]), 10_000_000)


def test_chain_equals_replacement():
    rnd = random.Random(5)
    texts = ["".join(rnd.choices("abc", k=rnd.randrange(2, 20))) for _ in range(50)]
    flat = np.frombuffer("".join(texts).encode(), np.uint8).astype(np.int64)
    size = np.array([len(t) for t in texts])
    word = np.repeat(np.arange(50), size)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    merges = [(97 * int(P._PAIR) + 97, 256), (256 * int(P._PAIR) + 98, 257), (98 * int(P._PAIR) + 256, 258),
              (257 * int(P._PAIR) + 257, 259)]
    out = P._advanced(P.Words(flat, word, at, np.arange(50), np.ones(50, np.int64)), merges, 10)
    touched = [t for t in texts if any(p in t for p in ("aa",))]
    for a, b in (("aa", "Ā"), ("Āb", "ā"), ("bĀ", "Ă"), ("āā", "ă")):
        touched = [t.replace(a, b) for t in touched]
    assert "".join(chr(s) for s in out.symbol) == "".join(touched)


def test_rounds_use_all_cores_and_repeat_few_merges(spark, monkeypatch):
    """Words that come in one file are dealt to all cores; a round does not repeat all merges since the start."""
    rnd = random.Random(3)
    lines = ["".join(rnd.choices("abcdefgh", k=12)) for _ in range(400)]
    seen, tried = [], P._tried

    def watched(blocks, done, *more):
        seen.append((len(blocks.inputFiles()), len(done)))
        return tried(blocks, done, *more)

    monkeypatch.setattr(P, "_tried", watched)
    got = P.train_indexed(state_of(spark, lines).coalesce(1), 120, batch=8)
    assert got.merges == py_train(lines, 120)
    assert min(files for files, _ in seen) >= spark.sparkContext.defaultParallelism > 1
    assert max(done for _, done in seen) < 32 + 8


def test_blocks_are_read_by_bounded_parts(monkeypatch):
    blocks = [P._block(P.Words(np.full(10, 97), np.repeat([0, 1], 5), np.tile(np.arange(5), 2), np.array([k, k + 1]),
                               np.ones(2, np.int64))) for k in range(7)]
    batch = pa.Table.from_batches(blocks).combine_chunks().to_batches()[0]
    monkeypatch.setattr(P, "SYMBOLS", 25)
    parts = list(P._reads([batch, batch.slice(0, 0), batch.slice(6)], np.ones(300, np.int64)))
    assert [len(p.symbol) for p in parts] == [20, 20, 20, 10, 10]
    assert [p.rank.tolist() for p in parts[-2:]] == [[6, 7], [6, 7]]
