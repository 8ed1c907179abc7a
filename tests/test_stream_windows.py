"""Windows of a growing stream: those of the batch operator, each once, whatever the cuts and restarts."""

import random

import pytest
from pyspark.sql import functions as F

from tests.bruteforce import windows as py_windows
from tokloom.streaming import incremental as I, windows as S


def landed(spark, folder, rows):
    spark.createDataFrame(rows, "conv_id long, ids array<int>").coalesce(1).write.mode("append").parquet(folder)


def go_on(spark, src, out, length, shards=1):
    tokens = I.read_stream(spark, src)
    q = (S.packed_windows(tokens, length, shards).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", out + "-ckpt").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(S.WINDOW_SCHEMA).parquet(out)


@pytest.mark.parametrize("length", [3, 8])
def test_windows_go_on_after_every_stop(spark, tmp_path, length):
    rnd = random.Random(length)
    src, out, flat, at = str(tmp_path / "in"), str(tmp_path / "out"), [], 0
    for k in range(4):
        rows = [(at + i, [rnd.randrange(1000) for _ in range(rnd.choice([0, 1, 2, 5, 30]))]) for i in range(12)]
        rows += [(at + 12, None)] if k else [(None, [7, 7])]
        at += 20
        flat += [t for _, ids in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)) for t in ids or []]
        rnd.shuffle(rows)
        landed(spark, src, rows)
        got = go_on(spark, src, out, length).orderBy("example_id").collect()
        assert [r["ids"] for r in got] == py_windows(flat, length)
        assert [r["example_id"] for r in got] == list(range(len(got)))
    assert go_on(spark, src, out, length).count() == len(got)  # nothing new, nothing twice


def test_shards_are_streams_of_their_own(spark, tmp_path):
    rows = [(i, list(range(i % 9))) for i in range(200)]
    landed(spark, str(tmp_path / "in"), rows)
    got = go_on(spark, str(tmp_path / "in"), str(tmp_path / "out"), 4, 3).collect()
    of = {r["id"]: r["s"] for r in spark.range(200).select(
        "id", F.pmod(F.xxhash64("id"), F.lit(3)).cast("int").alias("s")).collect()}
    for shard in range(3):
        flat = [t for i, ids in rows if of[i] == shard for t in ids]
        mine = sorted((r["example_id"], r["ids"]) for r in got if r["shard"] == shard)
        assert [w for _, w in mine] == py_windows(flat, 4)


def test_json_chats(spark, tmp_path):
    src = str(tmp_path / "in")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(
        '{"conv_id": 1, "more": 5, "conversations": [{"from": "human", "value": "hi", "weight": 0.5}]}\n')
    got = I.run_incremental_encode(spark, src, str(tmp_path / "out"), str(tmp_path / "ckpt"), [], fmt="json")
    assert [r["conv_id"] for r in got.collect()] == [1] and got.first()["ids"][0] == 32000


def test_micro_batches_are_packed_by_many_tasks(spark, tmp_path):
    """The same windows as by state, no shard in one task, and a repeated batch changes nothing."""
    rnd = random.Random(4)
    sink, states, flat = str(tmp_path / "out"), str(tmp_path / "states"), {0: [], 1: []}
    number = lambda c: F.pmod(F.xxhash64(c), F.lit(2)).cast("int")
    for k in range(3):
        rows = [(100 * k + i, [rnd.randrange(1000) for _ in range(rnd.choice([0, 1, 2, 5, 30]))]) for i in range(40)]
        rows += [(100 * k + 50, None), (None, [7, k])]
        df = spark.createDataFrame(rows, "conv_id long, ids array<int>")
        of = {r["conv_id"]: r["s"] for r in df.select("conv_id", number("conv_id").alias("s")).collect()}
        for c, ids in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
            flat[of[c]] += ids or []
        for _ in range(1 + (k == 1)):
            S.pack_micro_batch(df, k, sink, states, 4, 2)
        got = spark.read.schema(S.WINDOW_SCHEMA).option("recursiveFileLookup", "true").parquet(sink).collect()
        for shard in (0, 1):
            mine = sorted((r["example_id"], r["ids"]) for r in got if r["shard"] == shard)
            assert [w for _, w in mine] == py_windows(flat[shard], 4) and [i for i, _ in mine] == list(range(len(mine)))


def test_window_stream_without_files_and_over_restarts(spark, tmp_path):
    chats = "conv_id long, conversations array<struct<from: string, value: string>>"
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([], chats).write.parquet(src)
    assert S.run_window_stream(spark, src, out, out + "-ckpt", [], 8).count() == 0
    for k in range(2):
        spark.createDataFrame([(k, [("x", "ab" * 9)])], chats).coalesce(1).write.mode("append").parquet(src)
        win = S.run_window_stream(spark, src, out, out + "-ckpt", [], 8)
    tokens = [t for _ in range(2) for t in (*b"<X>\n" + b"ab" * 9 + b"\n\n", 32002, 10, 10)]
    assert [r["ids"] for r in win.orderBy("example_id").collect()] == py_windows(tokens, 8)
