"""A token cache that grows with its input (A7): one part for each file of chats.

The key of a part says all that shapes its tokens: the file's path, size and time, the merge table, the settings.
Files whose key is known are not read again; the others are encoded together by one job. A changed file gets a
new key and its old part is no longer read. Parts count once a manifest names them, which is written after
them, so a run that was lost leaves nothing that is believed.

The token stream is the files in path order and in each the chats by id, those without first. A part keeps the number of
tokens before each of its chats; the stream's offsets are these plus the totals of the parts before, one number a file.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tokloom.functions.pattern import PRETOKEN_PATTERN
from tokloom.operators import codec, flatten
from tokloom.operators.bpe import merge_list
from tokloom.operators.scan import in_order, running_totals
from tokloom.session import drop_stored
from tokloom.sources.chats import CHAT_RECORD

_FIELDS = "conv_id long, ids array<int>, n long, before long, part string"


def _part_key(settings: str) -> Column:
    file = F.concat_ws("|", F.col("_metadata.file_path"), F.col("_metadata.file_size").cast("string"),
                       F.col("_metadata.file_modification_time").cast("string"), F.lit(settings))
    return F.substring(F.sha2(file, 256), 1, 32)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def known_parts(spark: SparkSession, cache: str) -> set[str]:
    """Parts that a manifest names; as many as there were files, not chats."""
    folder = f"{cache.rstrip('/')}/manifests"
    return {r["part"] for r in spark.read.schema("part string").json(folder).collect()} if _exists(spark, folder) else set()


def cached_stream(spark: SparkSession, chats: str, cache: str, merges, fmt: str = "json",
                  role_map: dict | None = None) -> DataFrame:
    """``(conv_id, ids, n, start)`` of all chats in the files of ``chats``; only files without a part are encoded."""
    merges = merge_list(merges)
    said = json.dumps({"merges": [list(m) for m in merges], "roles": role_map or flatten.DEFAULT_ROLE_MAP,
                       "pattern": PRETOKEN_PATTERN, "format": fmt}, sort_keys=True)
    settings = hashlib.sha256(said.encode()).hexdigest()
    # listed by Spark, without a look into the files
    files = (spark.read.format("binaryFile").load(chats)
             .select(F.col("_metadata.file_path").alias("path"), _part_key(settings).alias("part"))
             .orderBy("path").collect())
    parts, root = [r["part"] for r in files], f"{cache.rstrip('/')}/parts"
    known = known_parts(spark, cache)
    missing = [r for r in files if r["part"] not in known]
    if missing:
        _encode(spark, missing, root, merges, fmt, role_map, settings)
        # a new folder for each run: manifests are only ever added
        spark.createDataFrame([(r["part"],) for r in missing], "part string").coalesce(1).write.mode("append").json(
            f"{cache.rstrip('/')}/manifests")
    if not parts:
        return spark.createDataFrame([], "conv_id long, ids array<int>, n long, start long")
    table = spark.read.schema(_FIELDS).parquet(root).filter(F.col("part").isin(parts))
    totals = {r["part"]: r["n"] for r in table.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    bases, total = [], 0
    for part in parts:
        bases.append((part, total))
        total += totals.get(part) or 0
    base = spark.createDataFrame(bases, "part string, base long")
    return (table.join(F.broadcast(base), "part")
            .select("conv_id", "ids", "n", (F.col("base") + F.col("before")).alias("start")))


def _encode(spark: SparkSession, missing, root: str, merges, fmt: str, role_map, settings: str) -> None:
    """Write the parts of files; what an unfinished run left of them goes first."""
    for r in missing:
        if _exists(spark, f"{root}/part={r['part']}"):
            drop_stored(spark, f"{root}/part={r['part']}")
    read = (spark.read.schema(CHAT_RECORD).format(fmt).load([r["path"] for r in missing])
            .select("conv_id", "conversations", F.col("_metadata.file_path").alias("path"), _part_key(settings).alias("part")))
    text = flatten.blocks_from_nested(read.withColumn("conv_id", F.struct("conv_id", "path", "part")), role_map)
    tokens = codec.encode(text, "block", merges).select(
        "conv_id.*", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    rows = in_order(tokens.withColumn("n", F.size("ids").cast("long")), ["path", "conv_id"])
    at = running_totals(rows, "n", "at", f"parts-{uuid.uuid4().hex[:8]}")
    # one row a file
    first = at.groupBy("part").agg(F.min("at").alias("first"))
    (at.join(F.broadcast(first), "part").select("conv_id", "ids", "n", (F.col("at") - F.col("first")).alias("before"), "part")
     .write.mode("append").partitionBy("part").parquet(root))
