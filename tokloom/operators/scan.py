"""Two-phase ordered scans: exclusive prefix sums and global row numbers.

``Window.orderBy`` without ``partitionBy`` moves every row into one task. Here
rows get a deterministic bucket that is monotone in the order key, then

1. ``groupBy(bucket)`` totals (partial aggregation; at most ``n_buckets`` rows),
2. a running sum over those few totals (the only un-partitioned window, bounded
   by ``n_buckets``), broadcast back,
3. a window ``partitionBy(bucket).orderBy(key)`` plus the bucket's base.

Buckets for a numeric key come from approximate quantiles, so each holds about
``rows / n_buckets`` rows whatever the key distribution; hash-ordered keys use a
hash prefix as the bucket. Rows without a key come first, in a bucket of their own.

Where the rows themselves can be laid out in order (``in_order``), nothing of this is needed:
``running_totals`` adds up inside each partition while the rows pass, and only one total per partition is
gathered. Neither a hot key nor a missing one makes a large group there.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tokloom.session import stored

BUCKET = "_bucket"
ROWS_PER_BUCKET = 1 << 20


def quantile_buckets(df: DataFrame, key: str, n_buckets: int | None = None,
                     accuracy: int = 10_000) -> DataFrame:
    """Add ``_bucket`` (int) monotone in numeric ``key`` from approx quantiles.

    The bucket count follows the row count (about ``ROWS_PER_BUCKET`` rows each:
    a hundred thousand split points for 10^11 rows); one more aggregation returns
    that many approximate quantiles, and only those reach the driver. Pass a
    stored table: it is read three times. Binary search over
    them runs in the JVM (``Bucketizer``). There are always at least two
    data-derived buckets, so the bucket-base join stays an equi-join (a literal
    bucket would be folded into a cross join).
    """
    if n_buckets is None:
        n = df.select(key).count()
        n_buckets = math.ceil(n / ROWS_PER_BUCKET)
    n_buckets = max(2, n_buckets)
    accuracy = max(accuracy, 20 * n_buckets)
    probs = [i / n_buckets for i in range(1, n_buckets)]
    kd = F.col(key).cast("double")
    qs = df.agg(F.percentile_approx(kd, probs, accuracy).alias("q")).first()["q"] or []
    splits = [-math.inf] + sorted(set(q for q in qs if q is not None)) + [math.inf]
    if len(splits) < 3:
        splits = [-math.inf, 0.0, math.inf]
    tmp = f"{key}__d"
    b = Bucketizer(splits=splits, inputCol=tmp, outputCol=BUCKET, handleInvalid="keep")
    out = b.transform(df.withColumn(tmp, kd))
    return out.withColumn(BUCKET, F.coalesce(F.col(BUCKET).cast("int"), F.lit(-1))).drop(tmp)


def hash_digits(n: int) -> int:
    """Hex digits that cut ``n`` hashes into buckets of at most ``ROWS_PER_BUCKET`` on average."""
    return max(2, math.ceil(math.log(max(1, n / ROWS_PER_BUCKET), 16)))


def hash_prefix_bucket(hex_hash: Column, digits: int = 3) -> Column:
    """Bucket = leading hex digits of a hash; monotone in the hash order."""
    return F.conv(F.substring(hex_hash, 1, digits), 16, 10).cast("int")


def _bucket_bases(df: DataFrame, value: Column | None, group: list[str]) -> DataFrame:
    agg = F.count(F.lit(1)) if value is None else F.sum(value)
    totals = df.groupBy(*group, BUCKET).agg(agg.cast("bigint").alias("_bt"))
    spec = Window.partitionBy(*group) if group else Window
    w = spec.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*group, BUCKET,
                         F.coalesce(F.sum("_bt").over(w), F.lit(0)).cast("bigint").alias("_base"))


def prefix_sum(df: DataFrame, order_cols: list[str], value: str, out: str,
               inclusive: bool = False, group: list[str] | None = None) -> DataFrame:
    """Running sum of ``value`` in ``order_cols`` order (per ``group``); needs ``_bucket``.

    The bucket-base table has at most groups x buckets rows and is broadcast.
    """
    g = list(group or [])
    bases = _bucket_bases(df, F.col(value), g)
    end = 0 if inclusive else -1
    w = (Window.partitionBy(*g, BUCKET).orderBy(*order_cols)
         .rowsBetween(Window.unboundedPreceding, end))
    return (df.join(F.broadcast(bases), [*g, BUCKET])
            .withColumn(out, (F.col("_base") + F.coalesce(F.sum(value).over(w), F.lit(0)))
                        .cast("bigint"))
            .drop("_base", BUCKET))


def global_row_number(df: DataFrame, order_cols: list[str], out: str,
                      group: list[str] | None = None) -> DataFrame:
    """0-based rank in ``order_cols`` order (per ``group``); needs ``_bucket``."""
    g = list(group or [])
    bases = _bucket_bases(df, None, g)
    w = Window.partitionBy(*g, BUCKET).orderBy(*order_cols)
    return (df.join(F.broadcast(bases), [*g, BUCKET])
            .withColumn(out, (F.col("_base") + F.row_number().over(w) - 1).cast("bigint"))
            .drop("_base", BUCKET))


def in_order(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """Rows laid out in order of ``keys`` over range partitions; nulls come first."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(k).asc_nulls_first() for k in keys]
    return df.repartitionByRange(n, *order).sortWithinPartitions(*order)


PART, BEFORE = "_part", "_before"


def running_totals(ordered: DataFrame, value: str, out: str, name: str = "ordered") -> DataFrame:
    """``ordered`` (see ``in_order``) as a stored table with ``out``: the sum of ``value`` (bigint) of all rows before.

    One pass writes the rows with the sum so far of their partition; the totals of the partitions, one row each, are
    added up on the driver and joined back by the partition's number. Rows are neither shuffled nor windowed.
    """
    spark = ordered.sparkSession
    fields = [*ordered.schema.fields, T.StructField(PART, T.IntegerType()), T.StructField(BEFORE, T.LongType())]

    def run(batches):
        from pyspark import TaskContext

        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column(batch.schema.get_field_index(value)).fill_null(0).to_numpy()
            ends = n.cumsum() + total
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), pa.array(ends - n, pa.int64())],
                [*batch.schema.names, PART, BEFORE])
            total = int(ends[-1]) if len(ends) else total

    table, _ = stored(ordered.mapInArrow(run, T.StructType(fields)), name)
    totals = table.groupBy(PART).agg(F.sum(value).alias("n")).orderBy(PART).collect()
    bases, total = [], 0
    for r in totals:
        bases.append((r[PART], total))
        total += r["n"] or 0
    base = spark.createDataFrame(bases, f"{PART} int, _base long")
    return (table.join(F.broadcast(base), PART)
            .withColumn(out, (F.col("_base") + F.col(BEFORE)).cast("bigint")).drop(PART, BEFORE, "_base"))
