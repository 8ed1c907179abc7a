"""Training order without a sort (F3, P4, P5): a keyed permutation of the example numbers, and batches to resume from.

Examples are numbered 0 to n - 1 without gaps, so a shuffle needs no ranks: a keyed permutation of these numbers gives
every example its place by arithmetic. It is the swap-or-not construction: in each round a number x has a partner
(K - x) mod n, and a hash bit of the larger of the two says whether they change places. Partners agree on the bit, so
each round is its own inverse; the rounds backwards give the example at a place. It works for any n, without walks.

Everything is narrow, for any number of epochs: no hash is sorted, no rank is counted. The rounds run on whole Arrow
columns. Keys are a few numbers per epoch, made from the seed. n is below 2^50.

``store_batches`` writes batches in training order, in folders of consecutive steps; ``resume`` reads from a step on
and opens no folder before it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tokloom.session import stored

ROUNDS = 32
PRIME = 2**31 - 1
STEP = 48271
CHUNK_STEPS = 256


def round_keys(n: int, seed: int, epoch: int, rounds: int = ROUNDS) -> list[tuple[int, int, int, int, int]]:
    """(K, a, b, c, d) of each round: K below n, the others below the prime."""
    out = []
    for r in range(rounds):
        x = (seed * 1000003 + epoch * 7368787 + r * 15485863 + 12345) % PRIME
        a = (x * x + 7 * x + 1) % PRIME
        b = a * STEP % PRIME
        c = b * STEP % PRIME
        d = c * STEP % PRIME
        out.append(((a * PRIME + b) % n if n else 0, a, b, c, d))
    return out


def permuted(x: np.ndarray, n: int, keys: list[tuple[int, int, int, int, int]]) -> np.ndarray:
    """Every round on the numbers ``x``; a polynomial of the larger partner, squared twice, gives the bit."""
    for k, a, b, c, d in keys:
        partner = (k + n - x) % n
        big = np.maximum(x, partner)
        h = (big % PRIME * c + big // PRIME * d + b) % PRIME
        g = h * h % PRIME
        x = np.where((g * g + a) % PRIME >> 16 & 1, partner, x)
    return x


def _permuted(column: Column, n: int, keys: list[list[tuple[int, int, int, int, int]]]) -> Column:
    """For each number an array of its images, one for each list of keys; the image of null is null."""
    @F.arrow_udf(T.ArrayType(T.LongType()))
    def run(numbers: pa.Array) -> pa.Array:
        x = numbers.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        images = np.stack([permuted(x, n, each) for each in keys], axis=1).reshape(-1)
        gone = np.repeat(np.array(numbers.is_null(), bool), len(keys))
        ends = np.arange(len(x) + 1, dtype=np.int32) * len(keys)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(images, pa.int64(), mask=gone))

    return run(column.cast("bigint"))


def place_of(examples: DataFrame, n: int, seed: int, epochs: int = 1, example: str = "example_id") -> DataFrame:
    """``(epoch, example_id, r)``: the place of every example in every epoch; narrow."""
    places = _permuted(F.col(example), n, [round_keys(n, seed, e) for e in range(epochs)])
    return (examples.select(F.col(example).alias("example_id"), places.alias("_places"))
            .select("example_id", F.posexplode("_places").alias("epoch", "r")).select("epoch", "example_id", "r"))


def example_at(places: DataFrame, n: int, seed: int, epoch: int = 0, place: str = "r") -> DataFrame:
    """``places`` with the ``example_id`` that stands there in this epoch: the inverse; narrow."""
    return places.withColumn("example_id", _permuted(F.col(place), n, [round_keys(n, seed, epoch)[::-1]])[0])


def batch_ids(spark: SparkSession, n: int, batch_size: int, seed: int, epoch: int, from_step: int = 0) -> DataFrame:
    """``(step, slot, example_id)`` of one epoch from a step on, generated in training order from the inverse."""
    rows = example_at(spark.range(min(from_step * batch_size, n), n).withColumnRenamed("id", "r"), n, seed, epoch)
    return rows.select(F.expr(f"r div {batch_size}").alias("step"), (F.col("r") % batch_size).cast("int").alias("slot"),
                       "example_id")


def store_batches(rows: DataFrame, name: str = "batches", chunk_steps: int = CHUNK_STEPS) -> tuple[DataFrame, str]:
    """Rows with (epoch, step, slot) as a stored table in training order, in folders of ``chunk_steps`` steps.

    Every row is shuffled once, by ranges of its place, so a folder's files hold consecutive steps. ``(table, path)``;
    the table reads as ``resume`` from the start.
    """
    spark = rows.sparkSession
    # the shape of the folder first: an empty table has none to read
    _, path = stored(rows.limit(0), name)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.withColumn("chunk", F.expr(f"cast(step div {chunk_steps} as int)"))
    (keyed.repartitionByRange(n, "epoch", "step", "slot").sortWithinPartitions("epoch", "chunk", "step", "slot")
     .write.mode("overwrite").option("overwriteSchema", "true").partitionBy("epoch", "chunk").parquet(path))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema.fields)
    return spark.read.schema(fields).parquet(path), path


def resume(table: DataFrame, epoch: int, step: int, chunk_steps: int = CHUNK_STEPS) -> DataFrame:
    """The rows of ``store_batches`` from (epoch, step) on. Folders before it are pruned, and so are row groups of its own
    folder by the pushed filter."""
    chunk = step // chunk_steps
    later = (F.col("epoch") > epoch) | ((F.col("epoch") == epoch) & (F.col("chunk") > chunk))
    here = (F.col("epoch") == epoch) & (F.col("chunk") == chunk) & (F.col("step") >= step)
    return table.filter(later | here).drop("chunk")
