"""Vectorised words and hashes over Arrow string columns.

A whole Arrow slice is handled as one byte buffer: word bounds, word hashes and
shingle hashes come from numpy passes over that buffer, so the cost per text is a
few array operations, not a Python step per word. UTF-8 never uses ASCII bytes inside
a longer character, so splitting at ASCII white space is exact on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tokloom.functions.arrow_lists import give_back

SLICE_BYTES = 2 << 20

_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
_STEP_INV = np.uint64(pow(int(_STEP), -1, 1 << 64))

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES
           ) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds at most ``limit`` bytes of text, or one row."""
    text = batch.column(batch.schema.get_field_index(column))
    ends = np.cumsum(lengths(text))
    at, n = 0, batch.num_rows
    while at < n:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(at, to - at)
        at = to
    give_back()


def lengths(text: pa.Array) -> np.ndarray:
    """Bytes of each text; null counts as empty."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def flat(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the column (uint8) and the start offsets of its texts, plus the end."""
    text = text.cast(pa.large_string()) if not pa.types.is_large_string(text.type) else text
    n = lengths(text)
    if text.null_count:
        import pyarrow.compute as pc
        text = pc.fill_null(text, "")
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = text.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else \
        np.zeros(0, np.uint8)
    return raw, np.concatenate([[0], np.cumsum(n)])


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out) if n else out


def runs(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True that do not cross text starts: (begin, end, first run of each text)."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(starts), np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = starts[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return begin, end, np.searchsorted(begin, starts, "left")


class RunHasher:
    """64-bit hashes of any runs of bytes of one buffer, from sums over the buffer's beginnings."""

    def __init__(self, raw: np.ndarray):
        with np.errstate(over="ignore"):
            self.total = np.zeros(len(raw) + 1, np.uint64)
            np.cumsum(_BYTE[raw] * powers(_STEP, len(raw)), out=self.total[1:], dtype=np.uint64)
            self.back = powers(_STEP_INV, len(raw) + 1)

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.total[end] - self.total[begin]) * self.back[begin]
                       + (end - begin).astype(np.uint64))


def run_hashes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of every run."""
    return RunHasher(raw)(begin, end) if len(begin) else np.zeros(0, np.uint64)


def words(text: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray,
                                                     np.ndarray, np.ndarray]:
    """Words between ASCII white space: (raw bytes, begin, end, hash, first word of each text)."""
    raw, starts = flat(text)
    if lower:
        raw = LOWER[raw]
    begin, end, first = runs(~IS_SPACE[raw], starts)
    return raw, begin, end, run_hashes(raw, begin, end), first


def joined_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` neighbours of ``h`` in order (len(h) - width + 1 of them)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.full(n, np.uint64(width), np.uint64)
        for k in range(width):
            out = out * np.uint64(0xD6E8FEB86659FD93) + h[k:k + n]
        return mix(out)


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """Distinct shingle hashes of one text's word hashes, sorted; fewer words than
    ``width`` give the whole sequence as one, no words give none."""
    if not len(h):
        return h
    return np.unique(joined_hashes(h, min(width, len(h))))
