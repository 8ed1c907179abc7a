from pyspark.sql import functions as F

from tokloom.operators import codec, flatten, words as W
from tokloom.sources import chats
from tokloom.streaming import incremental as S

MERGES = [(101, 32, 256), (116, 104, 257), (32, 116, 258)]


def test_incremental_encode_resumes_and_equals_batch(spark, sf_small):
    turns = spark.read.parquet(f"{sf_small}/conversations.parquet")
    nested = chats.nest_turns(turns)
    src = S.scratch_dir(spark, "t-src")
    sink = S.scratch_dir(spark, "t-sink")
    first = nested.filter(F.col("conv_id") % 2 == 0)
    second = nested.filter(F.col("conv_id") % 2 == 1)
    first.repartition(2).write.mode("append").parquet(src)
    rec = S.ProgressRecorder()
    S.run_incremental_encode(spark, src, sink, sink + "-ckpt", MERGES, listener=rec)
    n1 = spark.read.parquet(sink).count()
    assert n1 == first.count()
    # new files arrive; the restarted query picks up only those
    second.repartition(2).write.mode("append").parquet(src)
    out = S.run_incremental_encode(spark, src, sink, sink + "-ckpt", MERGES)
    batch = codec.encode(flatten.blocks(turns), "block", MERGES)
    got = {r["conv_id"]: r["ids"] for r in out.collect()}
    assert len(got) == out.count() == batch.count()
    assert got == {r["conv_id"]: r["ids"] for r in batch.collect()}
    assert sum(r[1] for r in rec.rows) == n1


def test_stream_equals_batch_at_a_thousand_merges(spark, sf_small):
    turns = spark.read.parquet(f"{sf_small}/conversations.parquet")
    # a merge table as a real tokenizer's: any chain of pairs will do
    base = [(a, b) for a in range(97, 123) for b in range(97, 123)]
    merges = [(a, b, 256 + i) for i, (a, b) in enumerate(base)]
    merges += [(256 + i, 32 + i % 90, 256 + len(base) + i) for i in range(1000 - len(base))]
    src, sink = S.scratch_dir(spark, "t-src"), S.scratch_dir(spark, "t-sink")
    chats.nest_turns(turns).repartition(3).write.parquet(src)
    out = S.run_incremental_encode(spark, src, sink, sink + "-ckpt", merges)
    batch = codec.encode(flatten.blocks(turns), "block", merges)
    assert {r["conv_id"]: r["ids"] for r in out.collect()} == \
        {r["conv_id"]: r["ids"] for r in batch.collect()}


def test_progress_holds_every_batch(spark, sf_small):
    turns = spark.read.parquet(f"{sf_small}/conversations.parquet")
    src, sink = S.scratch_dir(spark, "t-src"), S.scratch_dir(spark, "t-sink")
    chats.nest_turns(turns).repartitionByRange(5, "conv_id").write.parquet(src)
    rec = S.ProgressRecorder()
    S.run_incremental_encode(spark, src, sink, sink + "-ckpt", MERGES, 1, rec)
    assert len(rec.rows) == 5
    assert sum(r[1] for r in rec.rows) == turns.select("conv_id").distinct().count()


def test_word_counts_are_compacted_and_leave_no_setting(spark):
    src, out = S.scratch_dir(spark, "t-docs"), S.scratch_dir(spark, "t-wc")
    before = spark.conf.get(S._STATE_STORE, None)
    for k in range(3):
        spark.createDataFrame([(k, "a b a")], "doc_id long, text string").coalesce(1).write.mode(
            "append").parquet(src)
        got = S.run_word_counts(spark, src, out, out + "-ckpt", 1)
        assert {r["word"]: r["n"] for r in got.collect()} == {"a": 2 * (k + 1), "b": k + 1, " ": 2 * (k + 1)}
    assert spark.read.parquet(out).select("batch_id").distinct().count() == 1
    assert spark.conf.get(S._STATE_STORE, None) == before


def test_running_word_counts_equal_batch(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    src = S.scratch_dir(spark, "t-docs")
    docs.repartition(3).write.parquet(src)
    out = S.scratch_dir(spark, "t-wc")
    got = {r["word"]: r["n"] for r in S.run_word_counts(spark, src, out, out + "-ckpt").collect()}
    lines = W.lines(docs.select("doc_id", F.col("text").alias("block")), "doc_id")
    batch = W.words(lines, "doc_id").groupBy("word").count()
    assert got == {r["word"]: r["count"] for r in batch.collect()}


def test_one_large_file_is_encoded_by_all_cores(spark):
    src, sink = S.scratch_dir(spark, "t-src"), S.scratch_dir(spark, "t-sink")
    spark.createDataFrame([(i, [("human", "hi")]) for i in range(200)],
                          "conv_id long, conversations array<struct<from: string, value: string>>") \
        .coalesce(1).write.parquet(src)
    out = S.run_incremental_encode(spark, src, sink, sink + "-ckpt", MERGES)
    cores = spark.sparkContext.defaultParallelism
    assert out.select(F.input_file_name()).distinct().count() == cores > 1 and out.count() == 200


def test_landing_files_follow_the_size_of_the_table():
    from tokloom.sources.tables import LANDING_BYTES, landing_files
    assert [landing_files(b) for b in (0, LANDING_BYTES, 40 * LANDING_BYTES + 1)] == [4, 4, 41]
