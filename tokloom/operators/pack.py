"""Token stream packing: offsets, fixed windows, (x, y), shuffle, batches.

The corpus token stream is the concatenation of every chat's ids in
``conv_id`` order. Windows hold ``L + 1`` consecutive ids and start at
``0, L, 2L, ...`` while ``start < total - L``, so neighbours share one token,
windows cross chat boundaries and the incomplete tail is dropped; their number
is ``max(0, (total - 1) div L)``.

Nothing here moves one row per token: chats are cut into at most
``n / L + 2`` slices, and each window is stitched from at most ``L + 1``
slices (a bounded group whatever the chat-length distribution).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tokloom.operators.scan import (BUCKET, global_row_number, hash_digits, hash_prefix_bucket, in_order,
                                    running_totals)
from tokloom.session import stored


def token_offsets(tokens: DataFrame, key: str = "conv_id", ids: str = "ids", ordered: bool = False) -> DataFrame:
    """``(key, ids, n, start)``; ``start`` = tokens of all earlier chats, those without key first.

    ``ordered`` says that the rows are laid out in key order already (``flatten.blocks_in_order``, then a narrow
    encode): they are stored as they pass, with the sum so far, and id arrays never meet a shuffle. Otherwise
    they are stored and laid out once.
    """
    rows = tokens.select(key, F.coalesce(ids, F.array().cast("array<int>")).alias(ids))
    if not ordered:
        rows, _ = stored(rows.select(key, ids, F.monotonically_increasing_id().alias("_row")), "tokens")
        rows = in_order(rows, [key, "_row"]).drop("_row")
    return running_totals(rows.select(key, ids, F.size(ids).cast("bigint").alias("n")), "n", "start", "tokens")


def window_count(tokens: DataFrame, L: int, ids: str = "ids") -> DataFrame:
    """One row ``(n_tokens, n_examples)`` from the tokens' sizes; no offsets needed."""
    total = F.coalesce(F.sum(F.greatest(F.size(ids), F.lit(0))), F.lit(0)).cast("bigint")
    return tokens.agg(total.alias("n_tokens")).select(
        "n_tokens",
        F.when(F.col("n_tokens") > L, F.floor((F.col("n_tokens") - 1) / L))
        .otherwise(F.lit(0)).cast("bigint").alias("n_examples"))


def windows(offsets: DataFrame, L: int, ids: str = "ids") -> DataFrame:
    """``(example_id, ids)`` -- every full ``L + 1`` window of the stream.

    A chat covering global positions ``[s, s + n - 1]`` meets windows
    ``max(0, ceil(s / L) - 1) .. (s + n - 1) div L``; each meeting contributes
    the overlapping slice. Slices are regrouped by window id and concatenated
    in stream order; only complete windows are kept.
    """
    s, n = F.col("start"), F.col("n")
    lo = F.greatest(F.lit(0), F.floor((s + L - 1) / L) - 1).cast("bigint")
    hi = F.floor((s + n - 1) / L).cast("bigint")
    parts = (offsets.filter(n > 0)
             .select(ids, "start", "n", F.explode(F.sequence(lo, hi)).alias("example_id")))
    w0 = F.col("example_id") * L
    g_from = F.greatest(s, w0)
    g_to = F.least(s + n - 1, w0 + L)
    parts = parts.filter(g_from <= g_to).select(
        "example_id", g_from.alias("g"),
        F.slice(ids, (g_from - s + 1).cast("int"), (g_to - g_from + 1).cast("int")).alias("part"))
    return (parts.groupBy("example_id")
            .agg(F.array_sort(F.collect_list(F.struct("g", "part"))).alias("_p"))
            .select("example_id", F.flatten(F.transform("_p", lambda x: x["part"])).alias("ids"))
            .filter(F.size("ids") == L + 1))


def xy(win: DataFrame, L: int) -> DataFrame:
    """``x = ids[:-1]``, ``y = ids[1:]``."""
    return win.select("example_id", F.slice("ids", 1, L).alias("x"),
                      F.slice("ids", 2, L).alias("y"))


def next_token_pairs(tokens: DataFrame, key: str = "conv_id", ids: str = "ids") -> DataFrame:
    """E3 (row form inside each chat): ``(key, pos, x, y)`` with ``y`` the next id.

    Narrow: neighbours come from two slices of the same array, no window sort.
    """
    n = F.size(ids)
    z = F.arrays_zip(F.slice(ids, 1, n - 1).alias("x"), F.slice(ids, 2, n - 1).alias("y"))
    return (tokens.filter(F.size(ids) > 1)
            .select(key, F.posexplode(z).alias("pos", "xy"))
            .select(key, "pos", F.col("xy.x").alias("x"), F.col("xy.y").alias("y")))


def shuffle_key(example_id: Column, seed: int, epoch: Column | int = 0) -> Column:
    """deterministic order key ``md5('seed:epoch:example_id')`` (same in SQL)."""
    ep = epoch if isinstance(epoch, Column) else F.lit(epoch)
    return F.md5(F.concat_ws(":", F.lit(str(seed)), ep.cast("string"),
                             example_id.cast("string")))


def shuffled(examples: DataFrame, seed: int, epochs: int | None = None) -> DataFrame:
    """``(epoch, example_id, h, r)`` -- rank ``r`` in hash order per epoch.

    Epochs are a generator (``explode(sequence)``), not a join. Ranks are
    two-phase: counts per (epoch, hash prefix), with as many hex digits as the
    number of examples asks for, then a row number inside each bucket. Pass a
    stored table: its ids are read three times.
    """
    ex = examples.select("example_id")
    digits = hash_digits(ex.count())
    if epochs is None:
        ex = ex.withColumn("epoch", F.lit(0))
    else:
        ex = ex.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    ex = ex.withColumn("h", shuffle_key(F.col("example_id"), seed, F.col("epoch")))
    ex = ex.withColumn(BUCKET, hash_prefix_bucket(F.col("h"), digits))
    return global_row_number(ex, ["h", "example_id"], "r", group=["epoch"])


def batches(ranked: DataFrame, batch_size: int) -> DataFrame:
    """``step = r div B``, ``slot = r mod B``; the last partial batch is kept."""
    return ranked.withColumn("step", F.floor(F.col("r") / batch_size).cast("bigint")) \
                 .withColumn("slot", (F.col("r") % batch_size).cast("int"))


def with_xy(batch: DataFrame, win: DataFrame, L: int) -> DataFrame:
    """Batch rows with the ``x`` and ``y`` of their example."""
    return batch.join(xy(win, L), "example_id")


def steps(counts: DataFrame, batch_size: int, epochs: int = 1) -> DataFrame:
    """One row ``(n_examples, steps_per_epoch, total_steps)`` from ``window_count``."""
    return counts.select(
        "n_examples",
        F.ceil(F.col("n_examples") / batch_size).cast("bigint").alias("steps_per_epoch"),
        (F.ceil(F.col("n_examples") / batch_size) * epochs).cast("bigint").alias("total_steps"))


def token_bytes(tokens: DataFrame, ids: str = "ids", width: int = 8) -> DataFrame:
    """``(n_tokens, gb)`` of the int64 stream (8 bytes per id)."""
    n = F.coalesce(F.sum(F.size(ids)), F.lit(0)).cast("bigint")
    return tokens.agg(n.alias("n_tokens")).select(
        "n_tokens", F.round(F.col("n_tokens") * width / F.pow(F.lit(1024), 3), 9).alias("gb"))


def example_at(win: DataFrame, idx: int) -> DataFrame:
    """Random access ``dataset[idx]``: on a table from ``store_windows`` the filter
    is pushed to the scan and skips every file and row group but one."""
    return win.filter(F.col("example_id") == F.lit(idx))


def store_windows(win: DataFrame, partitions: int | None = None) -> tuple[DataFrame, str]:
    """Windows as a stored table in ``example_id`` order, for random access and sequential reads."""
    n = partitions or int(win.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table, path = stored(win, "windows")
    return stored(table.repartitionByRange(n, "example_id").sortWithinPartitions("example_id"),
                  "windows-sorted")
