"""Vector and matrix operators on ``array<float>`` columns.

Row-wise operators are higher-order functions on the array (no explode).
Per-dimension statistics explode to ``(pos, value)`` and aggregate with
map-side combine; a matrix product is one narrow pass over the vectors with
the small matrix, whose size is checked, as a literal.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tokloom.session import stored

SMALL_MATRIX_CELLS = 1 << 20
HOT_IDS = 4096              # ids whose rows a lookup broadcasts
TILE_CELLS = 1 << 22        # cells of summed tiles that a task holds


def as_double(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def elementwise_product(a: Column, b: Column) -> Column:
    """V1: ``a * b`` element by element."""
    return F.zip_with(as_double(a), as_double(b), lambda x, y: x * y)


def array_sum(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def row_mean(v: Column) -> Column:
    """V3 (dim 1): mean of one vector."""
    return array_sum(as_double(v)) / F.size(v)


def row_std(v: Column) -> Column:
    """Per-row sample standard deviation (n - 1 denominator)."""
    return _with_squares(v, lambda s, ss: F.sqrt(ss / (F.size(v) - 1)))


def standardize(v: Column, eps: float = 1e-5) -> Column:
    """V5: ``(x - mean) / sqrt(var_pop + eps)`` per row (layer norm, no scale)."""
    return _with_squares(v, lambda s, ss: F.transform(
        as_double(v), lambda x: (x - s / F.size(v)) / F.sqrt(ss / F.size(v) + eps)))


def _with_squares(v: Column, finish) -> Column:
    """``finish`` of the sum and the sum of squared differences from the mean.

    Both reach it as variables, by the last step of an aggregate, so a vector is summed twice; as plain
    expressions they would be summed anew for every element.
    """
    zero = F.lit(0.0).cast("double")
    return F.aggregate(as_double(v), zero, lambda acc, x: acc + x, lambda s: F.aggregate(
        as_double(v), zero, lambda acc, x: acc + (x - s / F.size(v)) * (x - s / F.size(v)), lambda ss: finish(s, ss)))


def coordinates(df: DataFrame, key: str, vec: str) -> DataFrame:
    """``(key, pos, v)`` coordinate form (0-based ``pos``)."""
    return df.select(key, F.posexplode(vec).alias("pos", "v")).withColumn(
        "v", F.col("v").cast("double"))


def column_means(df: DataFrame, vec: str, group: list[str] | None = None) -> DataFrame:
    """V3 (dim 0): per-dimension mean, optionally per group (label centroids)."""
    g = list(group or [])
    return (df.select(*g, F.posexplode(vec).alias("pos", "v"))
            .groupBy(*g, "pos").agg(F.avg(F.col("v").cast("double")).alias("mean")))


def global_mean(df: DataFrame, vec: str) -> DataFrame:
    """V3 (all): mean over every element, without exploding."""
    return df.agg((F.sum(array_sum(as_double(F.col(vec)))) / F.sum(F.size(vec))).alias("mean"))


def matmul_small(vectors: DataFrame, matrix: DataFrame, key: str, vec: str) -> DataFrame:
    """V2: ``A @ B`` with A as rows ``(key, vec)`` and a small B as rows ``(j, column)``: ``(key, j, score)``.

    B's columns (at most ``SMALL_MATRIX_CELLS`` numbers, else an error) come to
    the driver and go into the plan as a literal: each vector meets them in
    place, without a shuffle or a join. For a B without such a bound use ``matmul_tiled``.
    """
    rows = matrix.select("j", "column").limit(SMALL_MATRIX_CELLS + 1).collect()
    if sum(len(r["column"]) for r in rows) > SMALL_MATRIX_CELLS:
        raise ValueError("matrix too large for a literal")
    columns = F.array(*[F.struct(F.lit(r["j"]).alias("j"),
                                 F.lit([float(x) for x in r["column"]]).alias("c")) for r in rows])
    dots = F.transform(columns, lambda m: F.struct(
        m["j"].alias("j"), array_sum(elementwise_product(F.col(vec), m["c"])).alias("score")))
    return vectors.select(key, F.inline(dots))


def _tiles(coords: DataFrame, row: str, col: str, value: str, block: int) -> DataFrame:
    """``(r, c, tile)`` of a matrix in coordinate form: dense blocks of ``block`` x ``block`` doubles as bytes."""
    at = lambda c: F.col(c).cast("long")
    cells = coords.select(F.expr(f"cast(`{row}` as bigint) div {block}").alias("r"),
                          F.expr(f"cast(`{col}` as bigint) div {block}").alias("c"),
                          F.pmod(at(row), F.lit(block)).cast("int").alias("i"),
                          F.pmod(at(col), F.lit(block)).cast("int").alias("j"), F.col(value).cast("double").alias("v"))
    # a block holds no more cells than its size, however many rows the matrix has
    cells = cells.groupBy("r", "c", "i", "j").agg(F.sum("v").alias("v"))
    lists = cells.groupBy("r", "c").agg(F.collect_list("i").alias("i"), F.collect_list("j").alias("j"),
                                        F.collect_list("v").alias("v"))

    def dense(batches):
        for batch in batches:
            tiles = []
            for k in range(batch.num_rows):
                tile = np.zeros((block, block))
                i, j, v = (batch.column(c)[k].values.to_numpy() for c in ("i", "j", "v"))
                tile[i, j] = v
                tiles.append(tile.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("r"), batch.column("c"), pa.array(tiles, pa.binary())],
                                             ["r", "c", "tile"])

    return lists.mapInArrow(dense, "r long, c long, tile binary")


def matmul_tiled(a: DataFrame, b: DataFrame, block: int = 128) -> DataFrame:
    """V2 of two large matrices in coordinate form, ``(i, k, v)`` and ``(k, j, v)``: ``(i, j, score)`` of cells that any
    product reaches. Numbers of rows and columns start at 0.

    Both are cut into dense tiles. Tiles of one range of k meet, one row for each pair of tiles instead of one for each
    product of two cells, are multiplied as blocks, and the products of a place are summed, first inside the
    partition. For n x k times k x m the shuffles carry n k + k m cells, and n m for each range of k.
    """
    left = _tiles(a, "i", "k", "v", block).select(F.col("r").alias("r"), F.col("c").alias("k"),
                                                  F.col("tile").alias("x"))
    right = _tiles(b, "k", "j", "v", block).select(F.col("r").alias("k"), F.col("c").alias("c"),
                                                   F.col("tile").alias("y"))

    def multiply(batches):
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for k in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[k].as_py()).reshape(block, block) for c in ("x", "y"))
                place = (batch.column("r")[k].as_py(), batch.column("c")[k].as_py())
                total[place] = total.get(place, 0) + x @ y
                if len(total) * block * block >= TILE_CELLS:
                    yield from written(total)
                    total = {}
        yield from written(total)

    def written(total):
        for (r, c), tile in total.items():
            i, j = np.nonzero(tile)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i + r * block, pa.int64()), pa.array(j + c * block, pa.int64()), pa.array(tile[i, j])],
                ["i", "j", "score"])

    cells = left.join(right, "k").select("r", "c", "x", "y").mapInArrow(multiply, "i long, j long, score double")
    return cells.groupBy("i", "j").agg(F.sum("score").alias("score"))


def matmul(coords: DataFrame, matrix: DataFrame, key: str) -> DataFrame:
    """V2 for a large B, both in coordinate form: ``(key, pos, v)`` and ``(pos, j, w)``."""
    return (coords.join(matrix, "pos").groupBy(key, "j")
            .agg(F.sum(F.col("v") * F.col("w")).alias("score")))


def argmax_index(v: Column) -> Column:
    """0-based index of the first maximum."""
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def gather(v: Column, idx: Column) -> Column:
    """V4: 0-based element pick; null when out of range (``get``)."""
    return F.get(v, idx)


def lookup(ids_df: DataFrame, table: DataFrame, id_col: str, table_key: str, hot: int = HOT_IDS) -> DataFrame:
    """token/vector id -> table row; ids without a row stay, with nulls (see ``missing_ids``).

    Token ids are as skewed as keys get: one of them may be half of all tokens. The rows of the ``hot`` most frequent
    ids, a proven bound, are broadcast, and their tokens stay where they are. The other tokens meet the table by the
    planner's choice; none of their ids is more frequent than the last of the hot ones. Rows that repeat a key of
    the table give a row each, as in any join.
    """
    side, _ = stored(table, "lookup")
    rows, _ = stored(ids_df, "lookup-ids")
    names = ids_df.columns
    top, _ = stored(rows.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_hot"))
                    .agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "_hot").limit(hot).select("_hot"), "hot-ids")
    marked = rows.join(F.broadcast(top), F.col(id_col) == F.col("_hot"), "left")
    near, _ = stored(side.join(F.broadcast(top), F.col(table_key) == F.col("_hot"), "left_semi"), "hot-rows")
    # a table that repeats its keys has no bound on the rows of an id, so its size decides
    near = F.broadcast(near) if near.limit(hot + 1).count() <= hot else near
    of = lambda df: df.select(*names)
    there = of(marked.filter(F.col("_hot").isNotNull())).join(near, F.col(id_col) == F.col(table_key), "left")
    away = of(marked.filter(F.col("_hot").isNull())).join(side, F.col(id_col) == F.col(table_key), "left")
    return there.unionByName(away)


def missing_ids(looked_up: DataFrame, id_col: str, table_key: str) -> DataFrame:
    """C5 report: ``(id, n)`` of the ids that the table lacks."""
    return (looked_up.filter(F.col(table_key).isNull()).groupBy(F.col(id_col).alias("id"))
            .agg(F.count(F.lit(1)).alias("n")))
