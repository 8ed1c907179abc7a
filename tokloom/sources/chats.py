"""Chat record sources (A1) and the head subset (A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tokloom.operators.scan import global_row_number, quantile_buckets
from tokloom.session import drop_stored, stored

CHAT_TURN = T.StructType([
    T.StructField("from", T.StringType()),
    T.StructField("value", T.StringType()),
])
CHAT_RECORD = T.StructType([
    T.StructField("conv_id", T.LongType()),
    T.StructField("conversations", T.ArrayType(CHAT_TURN)),
])


def read_chat_records(spark: SparkSession, path: str, fmt: str = "json",
                      with_id: bool = True) -> DataFrame:
    """A1: nested chat records ``(conv_id, conversations)``; the schema is given, not inferred.

    Only the named keys are read, so further keys in a record or a turn do no
    harm. ``with_id=False`` is for records without ``conv_id``: they are
    numbered in file order (path, block, position) by two narrow passes, the
    first of which counts the records of each input partition.
    """
    schema = CHAT_RECORD if with_id else T.StructType(CHAT_RECORD.fields[1:])
    df = spark.read.schema(schema).format(fmt).load(path)
    return df if with_id else _numbered(df)


def _numbered(df: DataFrame) -> DataFrame:
    """Add ``conv_id`` 0, 1, ... in (file, block, position) order."""
    at = df.select("*", F.input_file_name().alias("_f"), F.input_file_block_start().alias("_b"),
                   F.monotonically_increasing_id().alias("_m"))
    counts = at.groupBy("_f", "_b").agg(F.count(F.lit(1)).alias("_n"))
    first = at.groupBy("_f", "_b").agg(F.min("_m").alias("_m0"))
    # one row for each block of each file, not for each record
    before = Window.orderBy("_f", "_b").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return (at.join(base, ["_f", "_b"]).join(first, ["_f", "_b"])
            .select((F.col("_base") + F.col("_m") - F.col("_m0")).alias("conv_id"), "conversations"))


def nest_turns(turns: DataFrame) -> DataFrame:
    """Flat ``(conv_id, turn, role, text)`` -> nested chat records."""
    return (turns.groupBy("conv_id")
            .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
            .select("conv_id",
                    F.transform("t", lambda x: F.struct(x["role"].alias("from"),
                                                        x["text"].alias("value")))
                    .alias("conversations")))


def explode_turns(chats: DataFrame) -> DataFrame:
    """Nested records -> flat turns; ``turn`` is the position in the list."""
    return (chats.select("conv_id", F.posexplode("conversations").alias("turn", "c"))
            .select("conv_id", F.col("turn").cast("bigint").alias("turn"),
                    F.col("c.from").alias("role"), F.col("c.value").alias("text")))


def head_subset(turns: DataFrame, subset_size: int | None) -> DataFrame:
    """A2: turns of the first ``subset_size`` chats by ``conv_id``.

    ``None`` keeps everything; a size not below the chat count keeps
    everything; 0 gives an empty result. The ``subset_size``-th id is found by
    a two-phase rank over the distinct ids and used as a plain filter bound:
    one number reaches the driver, whatever the size, and nothing is broadcast.
    """
    if subset_size is None:
        return turns
    if subset_size <= 0:
        return turns.limit(0)
    ids, path = stored(turns.select("conv_id").distinct(), "chat-ids")
    ranked = global_row_number(quantile_buckets(ids, "conv_id"), ["conv_id"], "_r")
    last = ranked.filter(F.col("_r") == int(subset_size) - 1).agg(F.max("conv_id")).first()[0]
    drop_stored(turns.sparkSession, path)
    return turns.filter("conv_id is not null") if last is None else turns.filter(
        F.col("conv_id") <= F.lit(last))
