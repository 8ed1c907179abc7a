"""Bulk-synchronous best-fit packing of documents into sequences of bounded length.

Documents are tokenised once; longer ones are cut. The pieces are then sorted by length, and every piece gets its
rank among the pieces of its length (counted per salt, so a length that a third of all pieces share is
still spread). A run of equal lengths is a range of ranks; open gaps are kept as runs too: a gap width and a
range of sequence numbers. Rounds go from the longest length down, and in a round

* all pieces of the length sweep to their successor, the narrowest open gap that holds them,
* when more pieces than gaps meet, the lower ranks get the gaps and the others sweep on,
* where no gap is wide enough, as many sequences are opened as the remaining ranks fill,
* the gaps that were used are narrowed and join the runs of their new width.

A round works on runs, of which there are never more than two per length: their number is bounded by the
sequence length (4096), not by the data, so the sweep itself is a few thousand steps at any size. The placements
(runs of ranks, with sequence and offset) are broadcast, and each executor places its own pieces by a
binary search. The plan is exactly best-fit decreasing.

Edge cases: a null or empty text is one piece with only the end id. Rows that repeat an id, or have none,
are packed row by row. An empty table gives no rows. Equal pieces are ordered by id, piece and
checksum. Extra columns are never read.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tokloom.llm import bytetext as B
from tokloom.llm.common import named_rows, stored
from tokloom.llm.tokens import SLICE_BYTES, token_ids, tokenizer_file

CAPACITY = 4096
SALT_ROWS = 50_000


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each piece of each row."""
    source = tokenizer_file(docs.sparkSession, tokenizer)

    def run(batches):
        for batch in batches:
            for part in B.slices(batch, "text", SLICE_BYTES):
                rows = []
                ids, starts = token_ids(part.column("text"), source.value)
                for doc, lo, hi in zip(part.column("doc_id").to_pylist(), starts[:-1].tolist(),
                                       starts[1:].tolist()):
                    rows += [(doc, k, at, min(capacity, hi - lo - at),
                              zlib.crc32(ids[lo + at:min(hi, lo + at + capacity)]))
                             for k, at in enumerate(range(0, hi - lo, capacity))]
                columns = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(),
                                                              pa.int64(), pa.int64()))],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    return named_rows(docs, doc_id="long", text="string").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def placements(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """The rounds: rows (length, first rank, first sequence, offset), a row for each run of ranks.

    Each run lasts until the next row's first rank; ranks of a run go to consecutive sequences.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    widths: list[int] = []  # of the open gaps, ascending

    def add(width: int, first: int, n: int) -> None:
        if width not in gaps:
            bisect.insort(widths, width)
            gaps[width] = []
        gaps[width].append((first, n))

    placed, opened = [], 0
    for length in sorted(counts, reverse=True):
        rank, total = 0, counts[length]
        while rank < total:
            at = bisect.bisect_left(widths, length)
            if at == len(widths):
                n = -(-(total - rank) // (capacity // length))
                add(capacity, opened, n)
                opened += n
                continue
            width = widths[at]
            first, n = gaps[width].pop()
            took = min(n, total - rank)
            placed.append((length, rank, first, capacity - width))
            rank += took
            if n > took:
                gaps[width].append((first + took, n - took))
            elif not gaps[width]:
                del gaps[width], widths[at]
            if width > length:
                add(width - length, first, took)
    return np.array(placed, np.int64).reshape(-1, 4)


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (from ``pieces``) with sequence_id and offset."""
    spark: SparkSession = parts.sparkSession
    parts = stored(parts, "pieces")
    # at most ``capacity`` rows, whatever the data
    counts = {r["length"]: r["n"] for r in
              parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    salts = max(16, sum(counts.values()) // SALT_ROWS)
    plan = placements(counts, capacity)
    order = np.lexsort((plan[:, 1], plan[:, 0]))
    plan = plan[order]
    sent = spark.sparkContext.broadcast(plan)

    salted = parts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    before = (salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
              .withColumn("base", F.sum("n").over(Window.partitionBy("length").orderBy("salt"))
                          - F.col("n")).drop("n"))
    within = F.row_number().over(Window.partitionBy("length", "salt")
                                 .orderBy("doc_id", "piece", "ids_crc32"))
    ranked = (salted.withColumn("within", within).join(before, ["length", "salt"])
              .select(*parts.columns, (F.col("base") + F.col("within") - 1).alias("rank")))

    def place(batches):
        runs = sent.value
        starts = runs[:, 0] << 44 | runs[:, 1]
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            key = batch.column("length").to_numpy() << 44 | rank
            run = np.searchsorted(starts, key, "right") - 1
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-1] + [pa.array(runs[run, 2] + rank - runs[run, 1]),
                                      pa.array(runs[run, 3])],
                [*batch.schema.names[:-1], "sequence_id", "offset"])

    return ranked.mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
               "sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY
                   ) -> DataFrame:
    return pack(pieces(docs, tokenizer, capacity), capacity)
