from pyspark.sql import functions as F

from tests.bruteforce import train as py_train
from tokloom.functions.symbols import sym_to_ids
from tokloom.operators import bpe, flatten, words as W


def _state(spark, text):
    lines = W.lines(spark.createDataFrame([(1, text)], "conv_id long, block string"))
    return bpe.training_state(W.word_frequency(W.words(lines)))


def test_pair_stats_overlap(spark):
    st = bpe.pair_stats(_state(spark, "aaa"))
    assert [(r["left"], r["right"], r["c"]) for r in st.collect()] == [(97, 97, 2)]


def test_merge_overlap(spark):
    st = _state(spark, "aaa").select(sym_to_ids(bpe.apply_merges(F.col("sym"), [(97, 97, 256)]))
                                      .alias("ids"))
    assert st.first()["ids"] == [256, 97]


def test_tie_order_and_early_stop(spark):
    res = bpe.train(_state(spark, "ab cd ab cd\n"), num_merges=10)
    assert [m[:3] for m in res.merges] == [(97, 98, 256), (99, 100, 257)]


def _corpus_lines(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    return W.lines(flatten.blocks(turns))


def test_train_matches_python(spark, sf_small):
    lines = _corpus_lines(spark, sf_small)
    py_lines = [r["line"] for r in lines.orderBy("conv_id", "line_no").collect()]
    expect = py_train(py_lines, 40)
    state = bpe.training_state(W.word_frequency(W.words(lines)))
    strict = bpe.train(state, num_merges=40, batched=False, checkpoint_every=16)
    batched = bpe.train(state, num_merges=40, batched=True)
    assert strict.merges == expect
    assert batched.merges == expect
    assert batched.rounds < strict.rounds


def test_vocabulary(spark):
    v = bpe.vocabulary(spark, [(97, 98, 256), (256, 99, 257)])
    got = {r["id"]: bytes(r["bytes"]) for r in v.collect()}
    assert got[257] == b"abc" and got[32002] == b"<|endoftext|>" and len(got) == 261


def test_tokenizer_json_roundtrip(spark, tmp_path):
    from tokloom.sources import tokenizer_io as io
    m = spark.createDataFrame([(0, 97, 98, 256, 5), (1, 256, 99, 257, 3)], bpe.MERGE_SCHEMA)
    io.save_tokenizer(m, str(tmp_path / "tok"))
    back = io.load_tokenizer(spark, str(tmp_path / "tok"))
    assert [tuple(r) for r in back.select("rank", "left", "right", "new_id").orderBy("rank")
            .collect()] == [(0, 97, 98, 256), (1, 256, 99, 257)]
    # a pretty-printed document (indent=2, one file) loads too
    import json
    p = tmp_path / "pretty.json"
    p.write_text(json.dumps({"vocab_size": 32000, "merges": [[97, 98, 256]]}, indent=2))
    one = io.load_tokenizer(spark, str(p)).collect()
    assert [(r["rank"], r["left"], r["right"], r["new_id"], r["vocab_size"]) for r in one] == \
        [(0, 97, 98, 256, 32000)]


def test_byte_level_variant_splits_at_specials(spark):
    from tokloom.operators import variant, words as W
    lines = W.lines(spark.createDataFrame([(1, "a<GPT>b can't\n")], "conv_id long, block string"))
    got = [r["word"] for r in variant.variant_words(lines).orderBy("word_no").collect()]
    assert got == ["a", "b", " can", "'t", "\n"]
    ms = variant.train_byte_level(lines, 2)
    assert all(a >= 3 and b >= 3 and n >= 259 for a, b, n, _ in ms)


def test_training_is_partition_invariant(spark, sf_small):
    lines = _corpus_lines(spark, sf_small)
    out = []
    for parts in (1, 17):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            st = bpe.training_state(W.word_frequency(W.words(lines.repartition(parts))))
            out.append(bpe.train(st, num_merges=20).merges)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert out[0] == out[1]


def test_exclude_special_option(spark):
    text = "<HUMAN>\n<HUMAN>\n<HUMAN>\nab ab\n"
    with_sp = bpe.train(_state(spark, text), num_merges=1).merges
    st = bpe.training_state(W.word_frequency(W.words(W.lines(
        spark.createDataFrame([(1, text)], "conv_id long, block string")))), exclude_special=True)
    without = bpe.train(st, num_merges=1).merges
    assert with_sp[0][:2] != (97, 98)      # specials count as ordinary words by default
    assert without[0][:2] == (97, 98)


def test_merge_limit_follows_vocab_size(spark, sf_small):
    # vocab_size - 256 bytes - 3 specials merges at most (Q8)
    st = bpe.training_state(W.word_frequency(W.words(_corpus_lines(spark, sf_small))))
    assert len(bpe.train(st, vocab_size=262).merges) == 3


def test_narrow_and_wide_position_keys_agree(spark, sf_small):
    st = bpe.training_state(W.word_frequency(W.words(_corpus_lines(spark, sf_small))))
    a = [tuple(r) for r in bpe.best_pairs(bpe.pair_stats(st, wide=True), 50)
         .select("left", "right", "c").collect()]
    b = [tuple(r) for r in bpe.best_pairs(bpe.pair_stats(st, wide=False), 50)
         .select("left", "right", "c").collect()]
    assert a == b
