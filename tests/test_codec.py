import tracemalloc

import numpy as np
import pyarrow as pa

from tests.bruteforce import encode as py_encode, train as py_train
from tokloom.functions.arrow_lists import gather, pieces, string_pieces
from tokloom.operators import bpe, codec, flatten, words as W


def test_encode_golden(spark):
    df = spark.createDataFrame([(1, "ab<GPT>é")], "conv_id long, t string")
    got = codec.encode(df, "t", [(97, 98, 256), (99, 100, 257)]).first()["ids"]
    assert got == [256, 32001, 195, 169]


def test_decode_broken_and_unknown(spark):
    vocab = bpe.vocabulary(spark, [])
    df = spark.createDataFrame([(1, [240, 159]), (2, [104, 31998])], "conv_id long, ids array<int>")
    assert codec.decode(df.filter("conv_id = 1"), "ids", vocab).first()["text"] == "�"
    bad = codec.unknown_ids(df, "ids", vocab).collect()
    assert [(r["conv_id"], r["pos"], r["id"]) for r in bad] == [(2, 1, 31998)]


def test_encode_plans_match_python(spark, sf_small):
    turns = spark.read.parquet(f"{sf_small}/conversations.parquet")
    blocks = flatten.blocks(turns)
    lines = [r["line"] for r in W.lines(blocks).orderBy("conv_id", "line_no").collect()]
    merges = py_train(lines, 60)
    texts = {r["conv_id"]: r["block"] for r in blocks.collect()}
    a = {r["conv_id"]: r["ids"] for r in codec.encode(blocks, "block", merges).collect()}
    b = {r["conv_id"]: r["ids"] for r in
         codec.encode_words(blocks, "block", merges, hot_words=5).collect()}
    c = {r["conv_id"]: r["ids"] for r in
         codec.encode(blocks, "block", merges, plan="arrow").collect()}
    fq = W.word_frequency(W.words(W.lines(blocks))).select("word", "n")
    hot = codec.hot_word_ids(fq, merges, n=300)
    assert len(hot) == 300 and hot[" "] == py_encode(" ", merges)
    d = {r["conv_id"]: r["ids"] for r in
         codec.encode(blocks, "block", merges, plan="arrow", hot=hot).collect()}
    assert d == c
    for cid, t in texts.items():
        expect = py_encode(t, merges)
        assert a[cid] == expect
        assert b[cid] == expect
        assert c[cid] == expect
    vocab = bpe.vocabulary(spark, merges)
    dec = codec.decode(codec.encode(blocks, "block", merges), "ids", vocab)
    assert {r["conv_id"]: r["text"] for r in dec.collect()} == texts


PLANS = ("native", "dictionary", "arrow")


def test_custom_specials_in_all_plans(spark):
    df = spark.createDataFrame([(1, "a<X>b<GPT>")], "conv_id long, t string")
    for plan in PLANS:
        got = codec.encode(df, "t", [(97, 98, 256)], specials={"<X>": 40000}, plan=plan).first()["ids"]
        assert got == [97, 40000, 98, *b"<GPT>"], plan


def test_empty_and_null_texts_keep_their_rows(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "ab")], "conv_id long, t string")
    for plan in PLANS:
        got = {r["conv_id"]: r["ids"] for r in codec.encode(df, "t", [(97, 98, 256)], plan=plan).collect()}
        assert got == {1: [], 2: None, 3: [256]}, plan


def test_ids_beyond_the_surrogate_block(spark):
    merges = [(97, 98, 55_295), (55_295, 99, 55_296), (55_296, 100, 70_000), (70_000, 101, 1_000_000)]
    df = spark.createDataFrame([(1, "ab abc abcd abcde")], "conv_id long, t string")
    for plan in PLANS:
        got = codec.encode(df, "t", merges, plan=plan).first()["ids"]
        assert got == [55_295, 32, 55_296, 32, 70_000, 32, 1_000_000], plan
    dec = codec.decode(codec.encode(df, "t", merges), "ids", bpe.vocabulary(spark, merges))
    assert dec.first()["text"] == "ab abc abcd abcde"


def test_byte_level_round_trip(spark):
    from tokloom.operators import variant
    text = "a<GPT>b can't\n\n  x  <|endoftext|>\n\ny1 é…"
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "conv_id long, block string")
    ms = variant.train_byte_level(W.lines(df.filter("conv_id = 1")), 3)
    enc = variant.encode_byte_level(df, "block", ms)
    ids = {r["conv_id"]: r["ids"] for r in enc.collect()}
    assert ids[2] == [] and ids[3] is None and {1, 2} <= set(ids[1]) and 0 not in ids[1]
    out = codec.decode(enc, "ids", variant.byte_level_vocabulary(spark, ms)).collect()
    assert {r["conv_id"]: r["text"] for r in out} == {1: text, 2: "", 3: None}


def test_range_violations(spark):
    df = spark.createDataFrame([(1, [1, 32000, 5]), (2, [1, 2])], "conv_id long, ids array<int>")
    bad = codec.range_violations(df, "ids", 32000).collect()
    assert [(r["conv_id"], r["n_bad"], r["bad_ids"]) for r in bad] == [(1, 1, "32000")]
    assert codec.range_violations(df, "ids", 40000, max_len=2).count() == 1


def test_decode_unknown_id_fails(spark):
    import pytest
    vocab = bpe.vocabulary(spark, [])
    df = spark.createDataFrame([(1, [104, 31998])], "conv_id long, ids array<int>")
    with pytest.raises(Exception):
        codec.decode(df, "ids", vocab).collect()


def peak_mb(results):
    """MB that numpy holds at most while ``results`` pass one by one, and how many there are."""
    tracemalloc.start()
    n = sum(1 for _ in results)
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return peak, n


def test_large_batches_are_handled_in_bounded_pieces():
    rnd = np.random.default_rng(5)
    words = [f"w{i}" for i in range(1000)]
    for rows, length in ((3000, 1000), (2, 1_500_000)):       # many lists, and lists longer than a piece
        flat = pa.array(words).take(pa.array(rnd.integers(0, 1000, rows * length)))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * length), flat)
        peak, n = peak_mb(codec.encoded(iter([lists]), [(119, 49, 256)], {}))
        assert n > 1 and peak < 40 + (rows == 2) * 100, peak
        ids = pa.concat_arrays(list(codec.encoded(iter([lists]), [(119, 49, 256)], {})))
        vocab = {i: bytes([i]) for i in range(256)} | {256: b"w1"}
        size, known = np.array([*(len(vocab[i]) for i in range(257)), 0]), np.array([True] * 257 + [False])
        data = b"".join(vocab[i] for i in sorted(vocab))
        peak, n = peak_mb(codec.decoded(iter([ids]), size, known, data))
        assert n > 1 and peak < 40 + (rows == 2) * 210, peak
        texts = pa.concat_arrays(list(codec.decoded(iter([ids]), size, known, data))).to_pylist()
        assert texts == ["".join(x) for x in lists.to_pylist()]


def test_pieces_keep_null_and_empty_lists():
    lists = pa.array([None, ["ab"], [], ["ab", "c"] * 5, None, ["c"]], pa.list_(pa.string()))
    assert [p.to_pylist() for p in pieces(lists, 4)] == [[None, ["ab"], []], [["ab", "c"] * 5], [None, ["c"]]]
    got = pa.concat_arrays(list(codec.encoded(iter([lists[:0], lists]), [(97, 98, 256)], {})))
    assert got.to_pylist() == [None, [256], [], [256, 99] * 5, None, [99]]
    assert not list(codec.decoded(iter([pa.array([], pa.list_(pa.int32()))]), np.zeros(1, int), np.zeros(1, bool), b""))


def test_long_words_are_merged_and_kept_in_bounded_parts():
    def lists(k):
        """1,000 words of 250 letters that no other list holds, in two lists."""
        words = [f"{k * 1000 + i:06d}".ljust(250, "x") for i in range(1000)]
        return pa.array([words[:500], words[500:]], pa.list_(pa.string()))

    merges = [(120, 120, 256), (256, 256, 257)]
    one = pa.concat_arrays([lists(k) for k in range(32)])            # 8 MB of words in one batch
    peak, n = peak_mb(codec.encoded(iter([one]), merges, {}))
    assert n > 1 and peak < 100, peak
    ids = pa.concat_arrays(list(codec.encoded(iter([lists(6), lists(7), lists(6)]), merges, {})))
    want = [[i for w in words for i in [*w[:6].encode(), *[257] * 61]] for k in (6, 7, 6) for words in lists(k).to_pylist()]
    assert ids.to_pylist() == want


def test_the_memo_of_long_words_is_bounded():
    def batches():
        for k in range(16):                  # 64 MB of words that don't come again, 4 MB at a time
            words = [f"{k * 16000 + i:06d}".ljust(250, "y") for i in range(16000)]
            yield pa.array([words[i:i + 100] for i in range(0, 16000, 100)], pa.list_(pa.string()))

    peak, n = peak_mb(codec.encoded(batches(), [(120, 120, 256)], {}))
    assert n >= 16 and peak < 140, peak


def test_string_pieces_are_cut_by_bytes_too():
    lists = pa.array([["aaaa", None], None, ["b"] * 3, ["c" * 20], [], ["d"]], pa.list_(pa.string()))
    assert [p.to_pylist() for p in string_pieces(lists, 100, 7)] == [
        [["aaaa", None], None, ["b"] * 3], [["c" * 20]], [[], ["d"]]]
    assert [p.to_pylist() for p in string_pieces(lists.slice(2), 3, 100)] == [[["b"] * 3], [["c" * 20], [], ["d"]]]
    assert not list(string_pieces(lists[:0]))


def test_long_and_empty_runs_are_gathered_by_parts():
    rnd = np.random.default_rng(2)
    data, size = rnd.integers(0, 99, 500), np.array([0, 0, 3, 400, 1, 0, 7, 2, 0])
    first = np.array([500, 3, 0, 100, 499, 500, 5, 498, 0])
    want = np.concatenate([data[a:a + n] for a, n in zip(first, size)])
    for most in (1, 4, 8, 1000):
        got, ends = gather(data, first, size, most)
        assert got.tolist() == want.tolist() and ends.tolist() == [0, *np.cumsum(size)]
    assert gather(data, first[:0], size[:0])[0].tolist() == []
