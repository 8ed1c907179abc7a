"""Structured Streaming operators.

S1  incremental encode: nested chat records arrive as files; each micro-batch
    is flattened and encoded by narrow projections (no state) and appended to
    a Parquet file sink. The sink's commit log plus ``checkpointLocation`` make
    a restart resume exactly where it stopped, without duplicates.
S2  running word counts: a streaming ``groupBy(word).count()`` (state =
    distinct words, RocksDB store). Each micro-batch's changed totals are
    written to their own batch folder (idempotent per ``batch_id``); the
    current table is the latest total per word.
S3  progress: ``DataFrame.observe`` metrics per micro-batch, captured by a
    ``StreamingQueryListener``.

Windows over the token stream are in ``streaming.windows``.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tokloom.operators import codec, flatten, words as W
from tokloom.session import ensure_checkpoint_dir
from tokloom.sources.chats import CHAT_RECORD


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (never machine-local
    on a cluster: ``spark.checkpoint.dir`` names shared storage there)."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tokloom-{name}-{uuid.uuid4().hex[:12]}"


def stream_source_path(spark: SparkSession, path: str) -> str:
    """File streams need a folder or glob; a lone file becomes a glob (asked of its file system)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p) and fs.getFileStatus(p).isFile():
        return path[:-1] + "[" + path[-1] + "]"
    return path


def read_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                fmt: str = "parquet", schema=None) -> DataFrame:
    """A file stream of ``path``. Parquet tells its own schema; JSON is read as nested chat records unless
    ``schema`` says otherwise, and keys that it does not name do no harm."""
    if schema is None:
        schema = CHAT_RECORD if fmt == "json" else spark.read.parquet(path).schema
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(stream_source_path(spark, path))


# ---- S1 ------------------------------------------------------------------------

def encode_stream(chats: DataFrame, merges, role_map: dict | None = None) -> DataFrame:
    """Streaming nested chats -> ``(conv_id, ids)``; stateless, so append mode."""
    blocks = flatten.blocks_from_nested(chats, role_map)
    return codec.encode(blocks, "block", merges)


def run_incremental_encode(spark: SparkSession, source: str, sink: str, checkpoint: str,
                           merges, max_files_per_trigger: int | None = None,
                           listener: "ProgressRecorder | None" = None, fmt: str = "parquet") -> DataFrame:
    """Encode every not-yet-processed file of ``source`` into ``sink``.

    ``trigger(availableNow=True)`` processes the backlog in micro-batches and
    stops; calling it again later picks up only new files. By default a trigger
    takes the whole backlog; ``max_files_per_trigger`` cuts it. Any merge table
    that the batch encoder takes will do. ``fmt`` is parquet or json.
    """
    chats = read_stream(spark, source, max_files_per_trigger, fmt)
    # a micro-batch may be one file of one row group: its chats are dealt to all cores before the work on their texts
    enc = encode_stream(chats.repartition(spark.sparkContext.defaultParallelism), merges)
    enc = enc.observe("progress", F.count(F.lit(1)).alias("rows"),
                      F.sum(F.size("ids")).alias("tokens"))
    if listener is not None:
        spark.streams.addListener(listener)
    try:
        q = (enc.writeStream.format("parquet").option("path", sink)
             .option("checkpointLocation", checkpoint).outputMode("append")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        if listener is not None:
            listener.wait()
    finally:
        if listener is not None:
            spark.streams.removeListener(listener)
    return spark.read.parquet(sink)


# ---- S2 ------------------------------------------------------------------------

def word_count_stream(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    lines = W.lines(docs.select(key, F.col(text).alias("block")), key)
    return W.words(lines, key).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_word_counts(spark: SparkSession, source: str, out: str, checkpoint: str,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Running word counts; returns the current ``(word, n)`` table.

    The state store is chosen for this query alone (a query keeps the one it
    was started with). Each run ends by folding its updates into one snapshot.
    """
    before = spark.conf.get(_STATE_STORE, None)
    spark.conf.set(_STATE_STORE, _ROCKSDB)
    try:
        counts = word_count_stream(read_stream(spark, source, max_files_per_trigger))

        def write_batch(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

        q = (counts.writeStream.outputMode("update").foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        if before is None:
            spark.conf.unset(_STATE_STORE)
        else:
            spark.conf.set(_STATE_STORE, before)
    q.awaitTermination()
    return compact_word_counts(spark, out)


def current_word_counts(spark: SparkSession, out: str) -> DataFrame:
    """Latest total per word across the update batches (totals only grow)."""
    return spark.read.parquet(out).groupBy("word").agg(F.max("n").alias("n"))


def compact_word_counts(spark: SparkSession, out: str) -> DataFrame:
    """Fold all batches but the last into the last one's folder, and return the current table.

    The new table is complete before a batch folder goes: the totals are written
    as a snapshot beside them, and words that occur in both count once (the
    larger total wins), so a reader or a restart at any point sees right totals.
    """
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = [st.getPath() for st in fs.listStatus(root) if st.getPath().getName().startswith("batch_id=")]
    if len(old) > 1:
        last = max(int(p.getName().partition("=")[2]) for p in old)
        current_word_counts(spark, out).write.mode("overwrite").parquet(f"{out}/batch_id=-{last + 1}")
        for p in old:
            fs.delete(p, True)
    return spark.read.parquet(out).groupBy("word").agg(F.max("n").alias("n"))


# ---- S3 ------------------------------------------------------------------------

class ProgressRecorder(StreamingQueryListener):
    """Keeps ``(batch_id, rows, tokens, input_rows)`` per finished micro-batch.

    One small row per micro-batch, never data rows.
    """

    def __init__(self, name: str = "progress"):
        self.name = name
        self.rows: list[tuple] = []
        self.ended = threading.Event()

    def wait(self, seconds: float = 60.0) -> None:
        """Until the query's end is told; events come in order, so all its progress is in then."""
        if not self.ended.wait(seconds):
            raise TimeoutError("the end of the streaming query was not told")

    def onQueryStarted(self, event):
        self.ended.clear()

    def onQueryProgress(self, event):
        p = event.progress
        m = p.observedMetrics.get(self.name)
        if m is not None:
            self.rows.append((int(p.batchId), int(m["rows"] or 0), int(m["tokens"] or 0),
                              int(p.numInputRows)))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended.set()

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            self.rows, "batch_id long, rows long, tokens long, input_rows long")
