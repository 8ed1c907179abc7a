"""Windows over a token stream that is still growing (P1 in streams).

The stream is cut into shards. Each shard is a token stream of its own, in order of arrival: the chats of a micro-batch
by their id (none first), after those of the micro-batches before. Its state is the unfinished tail, never more than a
window, and the number of the next example. A window is emitted once, as soon as it is full; neighbours share one
token, as in ``pack.windows``. State and sink are committed with the micro-batch, so a query that was stopped
or lost goes on where it was.

``run_window_stream`` packs each micro-batch by the batch operator, spread over all tasks. ``packed_windows`` is the
stateful form for any streaming query; there a shard's part of a micro-batch is one group, so it needs as many
shards as keep that small.

With one shard, and files that arrive in key order, the examples are those of the batch operator. More shards
spread the work; ``(shard, example_id)`` names an example then.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tokloom.operators import codec, flatten, pack
from tokloom.session import drop_stored, stored
from tokloom.streaming.incremental import read_stream

WINDOW_SCHEMA = "shard int, example_id long, ids array<int>"
_STATE = "tail binary, next long"
_STATE_ROW = "shard int, tail array<int>, next long"


def packed_windows(tokens: DataFrame, length: int, shards: int = 1, key: str = "conv_id") -> DataFrame:
    """Streaming ``(key, ids)`` -> ``(shard, example_id, ids)`` of every window that got full."""
    shard = F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")

    def run(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tail, number = state.get if state.exists else (b"", 0)
        rows = pd.concat(list(frames)).sort_values(key, na_position="first", kind="stable")
        parts = [np.frombuffer(tail, "<i4"), *(np.asarray(i, "<i4") for i in rows["ids"] if i is not None)]
        stream = np.concatenate(parts)
        # a window needs length + 1 tokens and leaves its last one to the next
        n = max(0, (len(stream) - 1) // length)
        state.update((stream[n * length:].astype("<i4").tobytes(), number + n))
        at = np.arange(n)[:, None] * length + np.arange(length + 1)
        yield pd.DataFrame({"shard": np.full(n, group[0], np.int32), "example_id": np.arange(number, number + n),
                            "ids": list(stream[at])})

    return (tokens.select(shard.alias("shard"), key, "ids").groupBy("shard")
            .applyInPandasWithState(run, WINDOW_SCHEMA, _STATE, "append", GroupStateTimeout.NoTimeout))


def pack_micro_batch(tokens: DataFrame, batch_id: int, sink: str, states: str, length: int, shards: int = 1,
                     key: str = "conv_id") -> None:
    """The windows that a micro-batch of ``(key, ids)`` fills, written to ``sink``, and the state after it to ``states``.

    The same windows as ``packed_windows``, but by the batch operator: offsets from totals of range partitions, each
    window from its slices, so no task holds a shard. Only a shard's tail, at most a window, passes the driver. Folders
    are named by the batch and written anew when it is repeated, from the state of the batch before.
    """
    spark = tokens.sparkSession
    rows, path = stored(tokens.select(F.pmod(F.xxhash64(key), F.lit(shards)).cast("int").alias("shard"), key, "ids"),
                        "micro-batch")
    before = _latest_state(spark, states, batch_id)
    found, after = None, []
    for shard in range(shards):
        tail, number = before.get(shard, ([], 0))
        offsets = pack.token_offsets(rows.filter(F.col("shard") == shard), key).select(
            "ids", "n", (F.col("start") + len(tail)).alias("start"))
        if tail:
            offsets = offsets.unionByName(spark.createDataFrame(
                [(tail, len(tail), 0)], "ids array<int>, n long, start long"))
        total = offsets.agg(F.sum("n")).first()[0] or 0
        n = max(0, (total - 1) // length)
        win = pack.windows(offsets, length).select(
            F.lit(shard).alias("shard"), (F.col("example_id") + number).alias("example_id"), "ids")
        found = win if found is None else found.unionByName(win)
        # what stands behind the last full window: at most ``length`` tokens
        skip = F.greatest(F.lit(n * length) - F.col("start"), F.lit(0)).cast("int")
        rest = (offsets.filter((F.col("n") > 0) & (F.col("start") + F.col("n") > n * length))
                .select("start", F.slice("ids", skip + 1, F.greatest(F.size("ids") - skip, F.lit(0))).alias("ids"))
                .orderBy("start").collect())
        after.append((shard, [t for r in rest for t in r["ids"]], number + n))
    found.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
    spark.createDataFrame(after, _STATE_ROW).coalesce(1).write.mode("overwrite").parquet(f"{states}/batch_id={batch_id}")
    drop_stored(spark, path)


def _latest_state(spark: SparkSession, states: str, batch_id: int) -> dict[int, tuple[list[int], int]]:
    """{shard: (tail, next)} after the last batch before ``batch_id``."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(states)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [st.getPath().getName() for st in fs.listStatus(root)] if fs.exists(root) else []
    earlier = [int(x.partition("=")[2]) for x in names if x.startswith("batch_id=") and int(x.partition("=")[2]) < batch_id]
    if not earlier:
        return {}
    rows = spark.read.schema(_STATE_ROW).parquet(f"{states}/batch_id={max(earlier)}").collect()
    return {r["shard"]: (list(r["tail"]), r["next"]) for r in rows}


def run_window_stream(spark: SparkSession, source: str, sink: str, checkpoint: str, merges, length: int,
                      shards: int = 1, max_files_per_trigger: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Encode and pack every file of nested chats that is new in ``source``; the windows so far."""
    def write(chats: DataFrame, batch_id: int) -> None:
        spread = chats.repartition(spark.sparkContext.defaultParallelism)
        tokens = codec.encode(flatten.blocks_from_nested(spread), "block", merges)
        pack_micro_batch(tokens, batch_id, sink, f"{checkpoint}/windows", length, shards)

    (read_stream(spark, source, max_files_per_trigger, fmt).writeStream.foreachBatch(write)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
    out = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sink)
    out.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(out)
    return spark.read.schema(WINDOW_SCHEMA).option("recursiveFileLookup", "true").parquet(sink)
