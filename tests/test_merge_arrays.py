"""Merging flat arrays of symbols against the plain loop over one word."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokloom.operators import codec, merge_arrays as A


def plain(word, merges):
    """The lowest-ranked pair that the word holds, at all its places from the left, until none is left."""
    rank = {}
    for r, (a, b, _) in enumerate(merges):
        rank.setdefault((a, b), r)
    seq = list(word)
    while True:
        found = [rank[p] for p in zip(seq, seq[1:]) if p in rank]
        if not found:
            return seq
        a, b, new = merges[min(found)]
        out, i = [], 0
        while i < len(seq):
            if seq[i:i + 2] == [a, b]:
                out.append(new)
                i += 2
            else:
                out.append(seq[i])
                i += 1
        seq = out


def random_merges(rnd, letters, n):
    merges, symbols = [], list(letters)
    for k in range(n):
        merges.append((rnd.choice(symbols), rnd.choice(symbols), 256 + k))
        symbols.append(256 + k)
    return merges


@pytest.mark.parametrize("seed", range(6))
def test_equals_the_plain_loop(seed, monkeypatch):
    rnd = random.Random(seed)
    merges = random_merges(rnd, b"abc", 40) + [(97, 97, 999)]
    words = [bytes(rnd.choices(b"abcd", k=rnd.randrange(60))) for _ in range(300)]
    want = [np.array(plain(w, merges), "<i4").tobytes() for w in words]
    table = A.MergeTable(merges)
    assert A.encode_words(words, table) == want
    monkeypatch.setattr(A, "LONG", 0)
    assert A.encode_words(words, table) == want
    monkeypatch.setattr(A, "LONG", 20)
    assert A.encode_words(words, table) == want
    assert A.encode_words([], table) == [] and A.encode_words([b"", b"ab"], A.MergeTable([])) == [
        b"", np.array([97, 98], "<i4").tobytes()]


def test_a_long_word_takes_no_quadratic_time():
    rnd = random.Random(9)
    merges = random_merges(rnd, b"abcdefgh", 2000)
    table = A.MergeTable(merges)
    took = {}
    for n in (100_000, 1_000_000):
        word = np.random.default_rng(1).choice(np.frombuffer(b"abcdefgh", np.uint8), n).tobytes()
        t = time.time()
        ids = np.frombuffer(A.encode_words([word], table)[0], "<i4")
        took[n] = time.time() - t
        assert 0 < len(ids) < n
    assert took[1_000_000] < 25 * took[100_000] + 1


def test_null_and_empty_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "abab <HUMAN> x")], "conv_id long, block string")
    got = {r["conv_id"]: r["ids"] for r in codec.encode(df, "block", [(97, 98, 256)] , plan="arrow").collect()}
    assert got == {1: None, 2: [], 3: [256, 256, 32, 32000, 32, 120]}


def test_unknown_ids_are_refused(spark):
    vocab = spark.createDataFrame([(97, bytearray(b"a"))], "id int, bytes binary")
    fine = spark.createDataFrame([([97, 97],), ([],), (None,)], "ids array<int>")
    assert [r["text"] for r in codec.decode(fine, "ids", vocab).collect()] == ["aa", "", None]
    for bad in ([98], [-1], [5000]):
        with pytest.raises(Exception, match="KeyError"):
            codec.decode(spark.createDataFrame([(bad,)], "ids array<int>"), "ids", vocab).agg(F.count("text")).collect()
