"""Arrow arrays of lists cut to bounded pieces, and memory given back, for functions that run in Python workers.

A batch holds as many rows as Spark puts into it, and a row of a text column may hold any number of words or ids. What a
function builds per element, in 64-bit numbers and in several copies, is many times the batch; so it works
piece by piece.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 18         # list elements handled at once
PIECE_BYTES = 4 << 20   # of their strings


def cuts(size: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Where to cut items of these sizes so that each part, from first to second, is of at most ``most``, or one item."""
    ends = np.cumsum(size, dtype=np.int64)
    at = 0
    while at < len(ends):
        base = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
        yield at, to
        at = to


def pieces(lists: pa.Array, most: int = PIECE) -> Iterator[pa.Array]:
    """``lists`` in turn, cut so that each part holds at most ``most`` elements, or one list."""
    for a, b in cuts(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), most):
        yield lists.slice(a, b - a)


def string_pieces(lists: pa.Array, most: int = PIECE, most_bytes: int = PIECE_BYTES) -> Iterator[pa.Array]:
    """``pieces`` of lists of strings that hold at most ``most_bytes`` bytes as well, or one list."""
    for part in pieces(lists, most):
        size = pc.binary_length(part.flatten()).fill_null(0).to_numpy(zero_copy_only=False)
        count = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        before = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        for a, b in cuts(np.diff(before[np.concatenate([[0], np.cumsum(count)])]), most_bytes):
            yield part.slice(a, b - a)


def gather(data: np.ndarray, first: np.ndarray, size: np.ndarray, most: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """``size`` entries of ``data`` from each of ``first`` on, end to end, and where each of them begins and ends.

    The places are worked out for ``most`` entries at a time, so long lists and long runs cost little more than the result.
    """
    ends = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(ends[-1], data.dtype)
    for a, b in cuts(size, most):
        if b == a + 1:
            out[ends[a]:ends[b]] = data[first[a]:first[a] + size[a]]
        else:
            out[ends[a]:ends[b]] = data[np.arange(ends[a], ends[b]) + np.repeat(first[a:b] - ends[a:b], size[a:b])]
    return out, ends


def give_back() -> None:
    """Return the memory of finished pieces to the system.

    Python workers outlive their tasks and serve the next stage, and what they once held counts against the
    executor's limit for as long as they hold on to it.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
