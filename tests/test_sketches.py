"""Sketches of words: exact while small, within their bounds when not, the same merged as in one pass."""

import pytest
from pyspark.sql import functions as F

from tokloom.operators import sketches as K, words as W


def zipf(spark, n):
    """Word w<k> about n / k times, for k up to 3,000."""
    return spark.range(1, 3001).select(F.format_string("w%d", "id").alias("word"),
                                       F.explode(F.sequence(F.lit(1), F.ceil(F.lit(n) / F.col("id")))).alias("k"))


def exact(words, k):
    return [(r["word"], r["count"]) for r in words.groupBy("word").count().orderBy(F.desc("count")).limit(k).collect()]


def test_exact_while_small(spark):
    words = zipf(spark, 2000)
    one = K.word_sketch(words)
    assert [(r["word"], r["n"]) for r in K.hot_words(one, 10).collect()] == exact(words, 10)
    assert abs(K.distinct_words(one).first()["n_words"] / 3000 - 1) < 0.04


@pytest.mark.parametrize("parts", [1, 7])
def test_merged_within_the_bound(spark, parts):
    words = zipf(spark, 3000).withColumn("g", F.pmod(F.xxhash64("word", "k"), F.lit(parts)))
    tracked = 1024
    both = K.merged(K.word_sketch(words, ["g"], tracked=tracked), tracked=tracked)
    n = words.count()
    assert both.first()["n"] == n and abs(K.distinct_words(both).first()["n_words"] / 3000 - 1) < 0.04
    found = {r["word"]: r["n"] for r in K.hot_words(both, 15).collect()}
    bound = K.count_error(n, tracked)
    for word, count in exact(words, 15):
        if count > 2 * bound:
            assert abs(found[word] - count) <= bound


def test_stream_and_batch_agree(spark, tmp_path, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    docs.repartition(3).write.parquet(src)
    got = K.run_word_sketches(spark, src, out, out + "-ckpt", max_files_per_trigger=1)
    words = W.words(W.lines(docs.select("doc_id", F.col("text").alias("block")), "doc_id"), "doc_id")
    assert got.first()["n"] == words.count() and spark.read.parquet(out).count() == 3
    assert [(r["word"], r["n"]) for r in K.hot_words(got, 8).collect()] == exact(words, 8)
    one = K.distinct_words(K.word_sketch(words)).first()["n_words"]
    assert abs(K.distinct_words(got).first()["n_words"] / one - 1) < 0.01


def test_nothing(spark):
    none = spark.createDataFrame([(None,)], "word string")
    for group in (None, ["word"]):
        assert K.word_sketch(none, group).count() == K.merged(K.word_sketch(none, group), group).count() == 0
