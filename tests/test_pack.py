import pytest
from pyspark.sql import Window, functions as F

from tests.bruteforce import windows as py_windows
from tokloom.operators import pack, scan


def _tokens(spark, seqs):
    return spark.createDataFrame([(i, s) for i, s in enumerate(seqs)],
                                 "conv_id long, ids array<int>")


@pytest.mark.parametrize("n,expect", [(0, 0), (1, 0), (4, 0), (5, 1), (8, 1), (9, 2)])
def test_window_counts(spark, n, expect):
    off = pack.token_offsets(_tokens(spark, [list(range(n))]))
    assert pack.windows(off, 4).count() == expect
    assert pack.window_count(off, 4).first()["n_examples"] == expect


def test_window_contents_and_xy(spark):
    off = pack.token_offsets(_tokens(spark, [list(range(9))]))
    w = pack.windows(off, 4).orderBy("example_id").collect()
    assert [r["ids"] for r in w] == [[0, 1, 2, 3, 4], [4, 5, 6, 7, 8]]
    e = pack.xy(pack.windows(off, 4), 4).orderBy("example_id").first()
    assert e["x"] == [0, 1, 2, 3] and e["y"] == [1, 2, 3, 4]


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_windows_cross_chats_match_python(spark, parts):
    import random
    rnd = random.Random(3)
    seqs = [[rnd.randrange(1000) for _ in range(rnd.choice([0, 1, 2, 3, 7, 15, 40]))]
            for _ in range(120)]
    flat = [t for s in seqs for t in s]
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        off = pack.token_offsets(_tokens(spark, seqs).repartition(parts))
        got = [r["ids"] for r in pack.windows(off, 8).orderBy("example_id").collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got == py_windows(flat, 8)


def test_batches_keep_partial(spark):
    ex = spark.range(70).withColumnRenamed("id", "example_id")
    b = pack.batches(pack.shuffled(ex, seed=7), 32)
    sizes = [r["count"] for r in b.groupBy("step").count().orderBy("step").collect()]
    assert sizes == [32, 32, 6]
    assert sorted(r["example_id"] for r in b.collect()) == list(range(70))


def test_epochs_reshuffle(spark):
    ex = spark.range(50).withColumnRenamed("id", "example_id")
    r = pack.shuffled(ex, seed=7, epochs=2)
    orders = {e: [x["example_id"] for x in r.filter(F.col("epoch") == e).orderBy("r").collect()]
              for e in (0, 1)}
    assert sorted(orders[0]) == sorted(orders[1]) == list(range(50))
    assert orders[0] != orders[1]


def test_two_phase_prefix_equals_naive_window(spark):
    df = spark.range(10000).select(F.col("id").alias("k"),
                                   ((F.col("id") * 7919) % 101).alias("v"))
    got = scan.prefix_sum(scan.quantile_buckets(df, "k", 13), ["k"], "v", "s")
    naive = df.withColumn("s2", F.coalesce(F.sum("v").over(
        Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    j = got.join(naive, "k")
    assert j.filter(F.col("s") != F.col("s2")).count() == 0 and j.count() == 10000


def test_steps_and_token_bytes(spark):
    counts = spark.createDataFrame([(4481, 70)], "n_tokens long, n_examples long")
    r = pack.steps(counts, 32, 10).first()
    assert (r["steps_per_epoch"], r["total_steps"]) == (3, 30)
    tb = pack.token_bytes(_tokens(spark, [[1, 2, 3]])).first()
    assert tb["n_tokens"] == 3


def test_pipeline_end_to_end(spark, sf_small, tmp_path):
    from tests.bruteforce import encode as py_encode, windows as py_windows
    from tokloom.operators import flatten
    from tokloom.plans import pipeline
    turns = spark.read.parquet(f"{sf_small}/conversations.parquet")
    tok = pipeline.train_tokenizer(turns, num_merges=24)
    assert len(tok.merges) == 24
    assert 0 < len(tok.hot) <= 20_000
    out = pipeline.corpus_to_batches(turns, tok.merges, window=32, epochs=2,
                                     cache_root=str(tmp_path / "cache"), hot=tok.hot)
    texts = [r["block"] for r in flatten.blocks(turns).orderBy("conv_id").collect()]
    stream = [t for b in texts for t in py_encode(b, tok.merges)]
    expect = py_windows(stream, 32)
    got = out.examples.orderBy("example_id").collect()
    assert [r["x"] + r["y"][-1:] for r in got] == expect
    rows = {(r["epoch"], r["example_id"]): r for r in out.batches.collect()}
    assert all(r["x"] + r["y"][-1:] == expect[i] for (_, i), r in rows.items())
    per_epoch = out.batches.groupBy("epoch").count().collect()
    assert sorted(r["count"] for r in per_epoch) == [len(expect)] * 2


def test_repeated_keys_keep_their_tokens(spark):
    df = spark.createDataFrame([(1, [1, 2, 3]), (1, [4, 5]), (2, None), (3, [6])], "conv_id long, ids array<int>")
    off = pack.token_offsets(df).orderBy("start", "n").collect()
    assert sum(r["n"] for r in off) == 6 and [r["start"] for r in off if r["n"]] in ([0, 3, 5], [0, 2, 5])


def test_hash_digits_follow_the_row_count():
    assert scan.hash_digits(10) == 2 and scan.hash_digits(10**11) == 5
    assert scan.hash_digits(scan.ROWS_PER_BUCKET * 16**4) == 4


def test_random_access_reads_one_row_group(spark):
    win = pack.windows(pack.token_offsets(_tokens(spark, [list(range(400))])), 4)
    table, _ = pack.store_windows(win, 4)
    assert pack.example_at(table, 7).first()["ids"] == list(range(28, 33))
    plan = pack.example_at(table, 7)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(example_id), EqualTo(example_id,7)]" in plan


def test_grouped_two_phase_rank_equals_naive(spark):
    df = spark.range(3000).select(
        (F.col("id") % 3).alias("g"), F.md5(F.col("id").cast("string")).alias("h"),
        F.col("id").alias("k"))
    got = scan.global_row_number(df.withColumn(scan.BUCKET, scan.hash_prefix_bucket(F.col("h"), 2)),
                                 ["h", "k"], "r", group=["g"])
    naive = df.withColumn("r2", F.row_number().over(Window.partitionBy("g").orderBy("h", "k")) - 1)
    j = got.join(naive, ["g", "k"])
    assert j.count() == 3000 and j.filter(F.col("r") != F.col("r2")).count() == 0


def test_missing_and_repeated_keys_lose_nothing(spark):
    """Chats without key come first; window, count and offsets agree."""
    rows = [(None, [9, 8, 7]), (2, [3, 4, 5, 6]), (1, [0, 1, 2]), (None, []), (2, [1] * 9), (1, None), (None, [5] * 6)]
    tokens = spark.createDataFrame(rows, "conv_id long, ids array<int>").repartition(5)
    off = pack.token_offsets(tokens)
    got = sorted((r["start"], r["conv_id"], r["n"]) for r in off.collect() if r["n"])
    assert [g[0] for g in got] == [sum(g[2] for g in got[:k]) for k in range(len(got))]
    assert [g[1] for g in got] == [None, None, 1, 2, 2] and off.count() == len(rows)
    assert pack.windows(off, 4).count() == pack.window_count(tokens, 4).first()["n_examples"] == 6


def test_ordered_rows_are_not_shuffled_again(spark, sf_small):
    from tokloom.operators import codec, flatten

    turns = spark.read.parquet(f"{sf_small}/conversations.parquet")
    merges = [(116, 104, 256)]
    plain = pack.token_offsets(codec.encode(flatten.blocks(turns), "block", merges))
    ordered = pack.token_offsets(codec.encode(flatten.blocks_in_order(turns), "block", merges), ordered=True)
    key = lambda df: sorted((r["conv_id"], r["n"], r["start"], r["ids"]) for r in df.collect())
    assert key(plain) == key(ordered)
    plan = ordered._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hash" not in plan and "Exchange range" not in plan and "Window" not in plan


def test_running_totals_of_hot_keys(spark):
    df = spark.range(5000).select((F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 7)).alias("k"), "id",
                                  (F.col("id") % 11).alias("v"))
    got = scan.running_totals(scan.in_order(df, ["k", "id"], 6), "v", "s")
    naive = df.withColumn("s2", F.coalesce(F.sum("v").over(Window.orderBy(F.col("k").asc_nulls_first(), "id")
                                           .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    j = got.select("id", "s").join(naive, "id")
    assert j.count() == 5000 and j.filter("s <> s2").count() == 0
