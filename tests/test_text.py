from pyspark.sql import functions as F

from tokloom.operators import flatten, words as W
from tokloom.sources import chats


def _split(spark, s):
    df = spark.createDataFrame([(s,)], "t string")
    return df.select(W.pretokens(F.col("t")).alias("w")).first()["w"]


def test_split_unicode(spark):
    assert _split(spark, "naïve ½ x_1!") == ["naïve", " ", "½", " ", "x_1", "!"]


def test_split_tags(spark):
    assert _split(spark, "hi <GPT>\n\n<SYSTEM>") == ["hi", " ", "<GPT>", "\n\n", "<", "SYSTEM", ">"]


def test_split_tag_inside_word(spark):
    assert _split(spark, "a<GPT>b<GPT") == ["a", "<GPT>", "b", "<", "GPT"]


def test_split_matches_python_on_documents(spark, sf_small):
    from tests.bruteforce import PATTERN
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r["w"] for r in
           docs.select("doc_id", W.pretokens(F.col("text")).alias("w")).collect()}
    for r in docs.collect():
        assert got[r["doc_id"]] == PATTERN.findall(r["text"])


def test_flatten(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")],
                                  "conv_id long, turn long, role string, text string")
    assert flatten.blocks(turns).first()["block"] == "<HUMAN>\na\n<GPT>\nb\n\n<|endoftext|>\n\n"


def test_flatten_no_turns(spark):
    nested = spark.createDataFrame([(7, [])], chats.CHAT_RECORD)
    assert flatten.blocks_from_nested(nested).first()["block"] == "\n<|endoftext|>\n\n"


def test_nested_equals_flat(spark, sf_small):
    turns = spark.read.parquet(f"{sf_small}/conversations.parquet")
    a = {r["conv_id"]: r["block"] for r in flatten.blocks(turns).collect()}
    b = {r["conv_id"]: r["block"]
         for r in flatten.blocks_from_nested(chats.nest_turns(turns)).collect()}
    assert a == b


def _lines_df(spark, texts):
    return W.lines(spark.createDataFrame([(1, "".join(texts))], "conv_id long, block string"))


def test_byte_budget(spark):
    lines = _lines_df(spark, ["abc\n"] * 3)
    assert W.budget_lines(lines, 4).count() == 2
    assert W.budget_lines(lines, 0).count() == 1


def test_lines_keep_newline_and_fold_cr(spark):
    got = [r["line"] for r in _lines_df(spark, ["a\r\n", "b\r", "c"]).orderBy("line_no").collect()]
    assert got == ["a\n", "b\n", "c"]


def test_word_frequency_first_position(spark):
    lines = _lines_df(spark, ["b a\n", "a b a\n"])
    fq = {r["word"]: (r["n"], tuple(r["fp"])) for r in
          W.word_frequency(W.words(lines)).select(
              "word", "n", W.position_struct(F.col("first_pos")).alias("fp")).collect()}
    assert fq["a"] == (3, (1, 0, 2))
    assert fq["b"] == (2, (1, 0, 0))


def test_json_chat_source_roundtrip(spark, tmp_path, sf_small):
    import json
    turns = spark.read.parquet(f"{sf_small}/conversations.parquet")
    recs = {}
    for r in turns.orderBy("conv_id", "turn").collect():
        recs.setdefault(r["conv_id"], []).append({"from": r["role"], "value": r["text"]})
    p = tmp_path / "chats.jsonl"
    with open(p, "w", encoding="utf-8") as f:
        for cid, conv in recs.items():
            f.write(json.dumps({"conv_id": cid, "conversations": conv, "source": "x"}) + "\n")
    nested = chats.read_chat_records(spark, str(p))
    a = {r["conv_id"]: r["block"] for r in flatten.blocks_from_nested(nested).collect()}
    b = {r["conv_id"]: r["block"] for r in flatten.blocks(turns).collect()}
    assert a == b


def test_corpus_sink_concatenates_in_order(spark, tmp_path, sf_small):
    import glob
    from tokloom.sources import corpus
    turns = spark.read.parquet(f"{sf_small}/conversations.parquet")
    blocks = flatten.blocks(turns)
    out = str(tmp_path / "corpus")
    corpus.write_corpus(blocks, out, num_files=3)
    text = "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(out + "/part-*")))
    expect = "".join(r["block"] for r in blocks.orderBy("conv_id").collect())
    assert text == expect
    assert corpus.corpus_size(blocks).first()["n_bytes"] == len(expect.encode("utf-8"))


def test_budget_blocks_prefilter_keeps_same_lines(spark, sf_small):
    turns = spark.read.parquet(f"{sf_small}/conversations.parquet")
    blocks = flatten.blocks(turns)
    for budget in (0, 5000, 20000):
        a = W.budget_lines(W.lines(blocks), budget)
        b = W.budget_lines(W.lines(W.budget_blocks(blocks, budget)), budget)
        key = lambda df: sorted((r["conv_id"], r["line_no"]) for r in df.collect())
        assert key(a) == key(b)


def test_head_subset_sizes(spark, sf_small):
    turns = spark.read.parquet(f"{sf_small}/conversations.parquet")
    n_chats = turns.select("conv_id").distinct().count()
    assert chats.head_subset(turns, 0).count() == 0
    assert chats.head_subset(turns, n_chats + 5).count() == turns.count()
    first3 = sorted(r["conv_id"] for r in turns.select("conv_id").distinct().collect())[:3]
    got = sorted({r["conv_id"] for r in chats.head_subset(turns, 3).collect()})
    assert got == first3


def test_chat_source_ignores_further_keys_and_numbers_records(spark, tmp_path):
    import json
    folder = tmp_path / "chats"
    folder.mkdir()
    n = 0
    for f in range(3):
        with open(folder / f"part-{f}.jsonl", "w", encoding="utf-8") as out:
            for _ in range(4 + f):
                turn = {"weight": 1.5, "value": f"text {n}", "from": "human", "more": {"a": [1]}}
                out.write(json.dumps({"conversations": [turn], "id": "x", "n": n}) + "\n")
                n += 1
    got = chats.read_chat_records(spark, str(folder), with_id=False)
    turns = chats.explode_turns(got).orderBy("conv_id").collect()
    assert [(r["conv_id"], r["text"]) for r in turns] == [(i, f"text {i}") for i in range(n)]


def test_null_text_keeps_the_turn(spark):
    turns = spark.createDataFrame([(1, 0, "user", None), (1, 1, "assistant", "b"), (1, 2, None, "c")],
                                  "conv_id long, turn long, role string, text string")
    block = flatten.blocks(turns).first()["block"]
    assert block == "<HUMAN>\n\n<GPT>\nb\n<>\nc\n\n<|endoftext|>\n\n"
    assert flatten.blocks_from_nested(chats.nest_turns(turns)).first()["block"] == block


def test_corpus_text_source(spark, tmp_path):
    import pytest
    from tokloom.sources import corpus
    folder = tmp_path / "text"
    folder.mkdir()
    blocks = [f"<HUMAN>\nhi {i}\n\nthere\n\n<|endoftext|>\n\n".encode() for i in range(9)]
    (folder / "part-0").write_bytes(b"".join(blocks[:5]) + b"bad \xff\xfe bytes\n\n<|endoftext|>\n\n")
    (folder / "part-1").write_bytes(b"".join(blocks[5:]))
    read = lambda mode: [r["block"] for r in corpus.read_corpus_blocks(spark, str(folder), mode)
                         .orderBy("file", "at").collect()]
    good = [b.decode() for b in blocks]
    assert sorted(read("replace")) == sorted([*good, "bad \ufffd\ufffd bytes\n\n<|endoftext|>\n\n"])
    assert sorted(read("drop")) == sorted([*good, "bad  bytes\n\n<|endoftext|>\n\n"])
    with pytest.raises(Exception, match="UTF-8"):
        read("fail")
    with pytest.raises(ValueError):
        corpus.read_corpus_blocks(spark, str(folder), "other")


def test_token_cache_key(spark, tmp_path):
    import pytest
    from tokloom.sources import corpus
    path = str(tmp_path / "in")
    key = lambda **s: corpus.fingerprint(spark.read.parquet(path), [(97, 98, 256)], 64, **s)
    spark.createDataFrame([(1, "a")], "k long, t string").write.parquet(path)
    first = key(role_map={"user": "human"})
    assert first == key(role_map={"user": "human"})
    assert first != key(role_map={"user": "gpt"})
    assert first != corpus.fingerprint(spark.read.parquet(path), [(97, 98, 257)], 64, role_map={"user": "human"})
    spark.createDataFrame([(1, "b" * 100)], "k long, t string").write.mode("overwrite").parquet(path)
    assert first != key(role_map={"user": "human"})
    with pytest.raises(ValueError):
        corpus.fingerprint(spark.createDataFrame([(1, "a")], "k long, t string"), [])


def test_training_keeps_few_states(spark, sf_small):
    import os
    from tokloom.operators import bpe
    from tokloom.session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    alive = lambda: {f for f in os.listdir(root) if "bpe-state" in f}
    turns = spark.read.parquet(f"{sf_small}/conversations.parquet")
    state = bpe.training_state(W.word_frequency(W.words(W.lines(flatten.blocks(turns)))))
    before = alive()
    bpe.train(state, num_merges=40, checkpoint_every=8)
    assert len(alive() - before) <= 2


def test_lines_without_key_are_the_first_chat(spark):
    lines = W.lines(spark.createDataFrame([(2, "ccc\n"), (None, "a\nbb\n"), (1, "d\n")], "conv_id long, block string"))
    got = {(r["conv_id"], r["line"]): r["bytes_before"] for r in W.running_bytes(lines).collect()}
    assert got == {(None, "a\n"): 0, (None, "bb\n"): 2, (1, "d\n"): 5, (2, "ccc\n"): 7}
    assert {r["line"] for r in W.budget_lines(lines, 4).collect()} == {"a\n", "bb\n"}
    blocks = spark.createDataFrame([(2, "ccc\n"), (None, "a\nbb\n"), (1, "d\n")], "conv_id long, block string")
    assert {r["conv_id"] for r in W.budget_blocks(blocks, 5).collect()} == {None, 1}
