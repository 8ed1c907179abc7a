"""Token counts by rank-synchronous merging, held against the library of the model."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from odd_rows import ROWS
from tokloom.llm import rank_merge as R

SYMBOLS = ["a", "b", "the", "ing", " ", "  ", "▁", "\n", "\t", "<s>", "</s>", "<0x0A>", "é", "ß", "中", "文",
           "日本語", "한", "😀", "​", "0", "1", ".", "...", "====", "\x00", "ﬁ", "ER", " un", "////"]


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(R.DEFAULT_FILE))


@pytest.fixture(scope="module")
def tables():
    return R.Tables(R.scored_pieces())


def counts(texts, tables):
    return R.token_counts(pa.array(texts, pa.string()), tables).tolist()


def test_equals_the_library_on_random_texts(model, tables):
    rnd = random.Random(3)
    texts = ["".join(rnd.choices(SYMBOLS, k=rnd.randrange(60))) for _ in range(4000)]
    texts += ["".join(chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(32, 0x3000), rnd.randrange(0xE000, 0x1FFFF)]))
                      for _ in range(30)) for _ in range(500)]
    texts += ["", " ", "   ", " " * 900, "a" * 900, "ab" * 400, "=" * 700, " x" * 300]
    assert counts(texts, tables) == [len(i) for i in model.encode(texts)]
    assert counts([None, "", None], tables) == [0, 0, 0]


@pytest.mark.parametrize("text", [" " * 3000, "a" * 5000, "ab" * 2500, "=-" * 2000, "the" * 1500])
def test_long_sequences_use_the_heap(model, tables, text):
    assert counts([text], tables) == [len(model.encode(text))]


def test_heap_and_arrays_agree(tables, monkeypatch):
    rnd = random.Random(4)
    texts = ["".join(rnd.choices(SYMBOLS, k=80)) for _ in range(300)]
    by_arrays = counts(texts, tables)
    monkeypatch.setattr(R, "LONG", 0)
    assert counts(texts, tables) == by_arrays


def test_parts_of_long_texts_add_up(model, tables):
    rnd = random.Random(5)
    for text in ["", " ", "a ", "a  ", *("".join(rnd.choices(SYMBOLS, k=200)) for _ in range(200))]:
        got = R.slice_counts(pa.array([text]), tables, limit=9)
        assert got.tolist() == [len(model.encode(text))], text


def test_a_small_table_with_tied_scores():
    """Equal scores merge leftmost first; worked out by a plain loop over the pieces."""
    pieces = [(p, 0.0 if len(p) == 1 else -1.0 if len(p) < 4 else -2.0)
              for p in ("▁", "a", "b", "aa", "aaa", "ab", "ba", "▁a", "abab", "aab")]
    tables, score = R.Tables(pieces), dict(pieces)

    def plain(text):
        out = list("▁" + text) if text else []
        while True:
            at = [(-score[x + y], i) for i, (x, y) in enumerate(zip(out, out[1:])) if x + y in score]
            if not at:
                return sum(1 if s in score else len(s.encode()) for s in out)
            i = min(at)[1]
            out[i:i + 2] = [out[i] + out[i + 1]]

    rnd = random.Random(6)
    texts = ["".join(rnd.choices("aaabbcé", k=rnd.randrange(14))) for _ in range(2000)]
    assert counts(texts, tables) == [plain(t) for t in texts]


def test_odd_rows(spark, odd_docs, no_docs, model):
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"])
                 for r in R.count_tokens(spark, odd_docs).collect())
    text = [(r[0], r[1] or "") for r in ROWS]
    want = [(d, len(t.encode()), len(model.encode(t))) for d, t in text]
    assert got == sorted((d is None, d or 0, b, n, n > 4096) for d, b, n in want)
    assert R.count_tokens(spark, no_docs).count() == 0
    assert np.array([n for *_, n in want]).max() > 4096
