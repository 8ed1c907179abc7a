"""Training-order materialisation: token sequences in a keyed random order, in fixed-stride shards.

Every text is tokenised once and cut into sequences of at most ``length`` ids. Sequences are numbered without a
shuffle: a narrow first pass over the texts' lengths reserves for each text as many numbers as it can need at
most, and one count for each input partition is all that reaches the driver. A keyed Feistel
network with cycle-walking permutes the D reserved numbers without a table; a sequence's place in the order of
its permuted number among all sequences is its global slot. Equal ranges of permuted numbers are shuffled to one task
each, sorted, and written as one shard of fixed-stride records. The manifest of shard sizes turns a slot into a shard
and a record by arithmetic: a reader starts at any slot and reads on sequentially.

Both passes must see the same partitions, which holds for scans of stored tables; the second one checks the
numbers that it used against those reserved. A shard is written under a temporary name and then renamed, so a
task that is run again, on another executor or in a later run, replaces it by the same bytes.

Record: doc_id (int64), sequence number within the text (uint32), ids in use (uint32), then
``length`` ids as uint16, padded with zeros; all little-endian.

Edge cases: a null or empty text is one sequence with only the end id. Rows without an id are stored with
the least int64 and read back as null; repeated rows are sequences of their own. An empty table gives
no shard. Extra columns are never read.
"""

from __future__ import annotations

import bisect
import itertools
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tokloom.llm import bytetext as B
from tokloom.llm.common import named_rows, shared_folder
from tokloom.llm.files import Folder
from tokloom.llm.tokens import SLICE_BYTES, largest_id, token_ids, tokenizer_file

LENGTH = 512
SHARD_BYTES = 32 << 20
KEY = 20_240_613
ROUNDS = 6
NO_ID = -(2**63)


class Permutation:
    """Keyed bijection of 0 .. n-1: a balanced Feistel network over the next even number of bits,
    applied again to values that fall outside."""

    def __init__(self, n: int, key: int):
        self.n = n
        self.half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
        self.keys = B.mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + np.uint64(key) * np.uint64(ROUNDS + 1))

    def _once(self, x: np.ndarray, keys: np.ndarray, back: bool) -> np.ndarray:
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> half, x & mask
        for k in keys:
            if back:
                left, right = right ^ (B.mix(left ^ k) & mask), left
            else:
                left, right = right, left ^ (B.mix(right ^ k) & mask)
        return left << half | right

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        keys = self.keys[::-1] if back else self.keys
        out = self._once(np.asarray(x, np.uint64), keys, back)
        while len(over := np.flatnonzero(out >= np.uint64(self.n))):
            out[over] = self._once(out[over], keys, back)
        return out.astype(np.int64)

    def slot(self, n: np.ndarray) -> np.ndarray:
        return self._walk(n, False)

    def number(self, slot: np.ndarray) -> np.ndarray:
        """The inverse of ``slot``."""
        return self._walk(slot, True)


@dataclass(frozen=True)
class Shards:
    """Where the shards are and how many records each has; all that a reader needs."""

    folder: str
    length: int
    sizes: tuple[int, ...]

    @property
    def stride(self) -> int:
        return 16 + 2 * self.length

    @property
    def starts(self) -> list[int]:
        """First slot of each shard, and the number of sequences."""
        return [0, *itertools.accumulate(self.sizes)]

    @property
    def sequences(self) -> int:
        return sum(self.sizes)

    def name(self, shard: int) -> str:
        return f"shard-{shard:07d}.bin"


def _sequences(part: pa.RecordBatch, source: str):
    """For each row: its id and its ids as uint16."""
    ids, starts = token_ids(part.column("text"), source)
    ids = ids.astype("<u2")
    for doc, lo, hi in zip(part.column("doc_id").to_pylist(), starts[:-1].tolist(),
                           starts[1:].tolist()):
        yield NO_ID if doc is None else doc, ids[lo:hi]


def _reserved(text: pa.Array, length: int) -> np.ndarray:
    """Numbers reserved for each text: a byte gives at most one id, and composing and lower-casing
    make a text at most four times as long; the end id comes on top."""
    return -(-(4 * B.lengths(text) + 2) // length)


def materialise(docs: DataFrame, folder: str, tokenizer: str | None = None, length: int = LENGTH,
                shard_bytes: int = SHARD_BYTES, key: int = KEY) -> Shards:
    """Write the shards of a stored table into ``folder``, which all executors share.

    ``shard_bytes`` is the text that goes into a shard on average.
    """
    spark: SparkSession = docs.sparkSession
    source = tokenizer_file(spark, tokenizer)
    if largest_id(source.value) > 0xFFFF:
        raise ValueError("the records hold ids of 16 bits")
    rows = named_rows(docs, doc_id="long", text="string")

    def count(batches):
        n = size = 0
        for batch in batches:
            n += int(_reserved(batch.column("text"), length).sum())
            size += int(B.lengths(batch.column("text")).sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([n], pa.int64()),
             pa.array([size], pa.int64())], ["part", "n", "size"])

    # one row for each input partition
    parts = rows.mapInArrow(count, "part int, n long, size long").toArrow().to_pandas().sort_values("part")
    counts = dict(zip(parts["part"].tolist(), parts["n"].tolist()))
    base, total = {}, 0
    for part, n in counts.items():
        base[part], total = total, total + n
    if not total:
        return Shards(folder, length, ())
    order, n_shards = Permutation(total, key), max(1, -(-int(parts["size"].sum()) // shard_bytes))

    def number(batches):
        here = TaskContext.get().partitionId()
        at = base[here]
        for batch in batches:
            for part in B.slices(batch, "text", SLICE_BYTES):
                room = _reserved(part.column("text"), length)
                first = at + np.concatenate([[0], np.cumsum(room)])
                at = int(first[-1])
                out = []
                for i, (doc, ids) in enumerate(_sequences(part, source.value)):
                    n = -(-len(ids) // length)
                    if n > room[i]:
                        raise RuntimeError("a text has more ids than its bytes allow")
                    out += [(first[i] + k, doc, k, ids[k * length:(k + 1) * length].tobytes())
                            for k in range(n)]
                numbers, doc, piece, ids = zip(*out)
                place = order.slot(np.array(numbers, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place), pa.array((place * n_shards // total).astype(np.int32)),
                     pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(ids, pa.binary())],
                    ["place", "shard", "doc_id", "piece", "ids"])
        if at != base[here] + counts[here]:
            raise RuntimeError("the input's partitions changed between the two passes")

    def write(batches):
        target, attempt = Folder(folder), TaskContext.get().taskAttemptId()
        out, open_shard, n = None, None, 0
        for batch in batches:
            for shard, doc, piece, ids in zip(*(batch.column(c).to_pylist()
                                                for c in ("shard", "doc_id", "piece", "ids"))):
                if shard != open_shard:
                    if out is not None:
                        out.done()
                        yield _size(open_shard, n)
                    open_shard, n = shard, 0
                    out = target.write(f"shard-{shard:07d}.bin", attempt)
                head = (doc.to_bytes(8, "little", signed=True) + piece.to_bytes(4, "little")
                        + (len(ids) // 2).to_bytes(4, "little"))
                out.put(head + ids + bytes(2 * length - len(ids)))
                n += 1
        if out is not None:
            out.done()
            yield _size(open_shard, n)

    Folder(folder).make()
    sizes = [0] * n_shards
    # one row for each shard
    for shard, n in (rows.mapInArrow(number, "place long, shard int, doc_id long, piece int, ids binary")
                     .repartitionById(n_shards, F.col("shard")).sortWithinPartitions("shard", "place")
                     .mapInArrow(write, "shard int, n long").collect()):
        sizes[shard] = n
    return Shards(folder, length, tuple(sizes))


def _size(shard: int, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([n], pa.int64())],
                                      ["shard", "n"])


def read(spark: SparkSession, shards: Shards, first_slot: int = 0) -> DataFrame:
    """(slot, shard, record, doc_id, piece, length, ids_crc32, ids) from ``first_slot`` on, in slot
    order within a shard; a task reads one shard after another from front to back."""
    starts = shards.starts
    first = max(0, bisect.bisect_right(starts, first_slot) - 1)

    def run(batches):
        folder = Folder(shards.folder)
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                record = max(0, first_slot - starts[shard])
                if record >= shards.sizes[shard]:
                    continue
                with folder.read(shards.name(shard)) as f:
                    f.seek(record * shards.stride)
                    while data := f.read(1024 * shards.stride):
                        yield _decoded(data, starts[shard], record, shard, shards)
                        record += len(data) // shards.stride

    end = len(shards.sizes)
    return spark.range(min(first, end), end, 1, max(1, end - first)).mapInArrow(
        run, "slot long, shard int, record int, doc_id long, piece int, length int, ids_crc32 long, "
             "ids array<int>")


def _decoded(data: bytes, start: int, record: int, shard: int, shards: Shards) -> pa.RecordBatch:
    kind = np.dtype([("doc", "<i8"), ("piece", "<u4"), ("n", "<u4"), ("ids", "<u2", shards.length)])
    rows = np.frombuffer(data, kind)
    n = rows["n"].astype(np.int64)
    used = rows["ids"][np.arange(shards.length) < n[:, None]]
    ends = np.concatenate([[0], np.cumsum(n)])
    wide = used.astype("<u4")
    crc = [zlib.crc32(wide[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
    record = record + np.arange(len(rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(start + record), pa.array(np.full(len(rows), shard, np.int32)),
         pa.array(record.astype(np.int32)),
         pa.array(rows["doc"], mask=rows["doc"] == NO_ID), pa.array(rows["piece"].astype(np.int32)),
         pa.array(n.astype(np.int32)), pa.array(crc, pa.int64()),
         pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(wide.astype(np.int32)))],
        ["slot", "shard", "record", "doc_id", "piece", "length", "ids_crc32", "ids"])


def training_order(docs: DataFrame) -> DataFrame:
    """The record of every sequence, as read back from shards in the shared folder."""
    spark = docs.sparkSession
    shards = materialise(docs, shared_folder(spark, "training-order"))
    return read(spark, shards).drop("ids")
