"""Merge tables applied to flat arrays of symbols (H4): a whole batch of words at once, and words of any length.

Encoding replaces, again and again, the pair of the lowest rank that a word holds, at all its places from the left.

* Words of a batch lie in one flat array. In every round each word finds its lowest rank and merges it at all places, all
  words together; a word needs about as many rounds as it has different merges, which is few for ordinary words.
* A long word (more than ``LONG`` symbols) would need many rounds over all its symbols. There the symbols are a linked
  list, and a priority queue holds the ranks with their places: the lowest comes first, its places that still hold the pair
  are merged, and the pairs that come to be beside them are queued. Every place is queued as often as a
  neighbour changes, so the time grows with n log n, whatever the number of merges.
"""

from __future__ import annotations

import heapq

import numpy as np

from tokloom.functions.arrow_lists import cuts

LONG = 256
SYMBOLS = 1 << 18    # merged at once, or one word: each is held as several 64-bit numbers
_NONE = np.iinfo(np.int64).max
_SHIFT = 21          # symbol ids are code points, so a pair fits in 42 bits


class MergeTable:
    """(left, right, new) in rank order as sorted arrays; of a pair listed twice the first counts."""

    def __init__(self, merges: list[tuple[int, int, int]]):
        table = np.array([m[:3] for m in merges], np.int64).reshape(-1, 3)
        key = table[:, 0] << _SHIFT | table[:, 1]
        self.key, self.rank = np.unique(key, return_index=True)
        self.new = table[:, 2]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, _NONE where it is none."""
        if not len(self.key):
            return np.full(len(left), _NONE)
        key = left << _SHIFT | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], _NONE)


def every_other(follows: np.ndarray) -> np.ndarray:
    """Of runs of places, where ``follows`` says that one stands right after the one before, every other from the first."""
    order = np.arange(len(follows))
    return (order - np.maximum.accumulate(np.where(follows, 0, order))) % 2 == 0


def merge_long(symbol: np.ndarray, table: MergeTable) -> np.ndarray:
    """The symbols of one word after all merges, by a linked list and a queue of ranks."""
    n = len(symbol)
    symbol = symbol.copy()
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    queue: list[int] = []
    waiting: dict[int, list[np.ndarray]] = {}

    def enqueue(at: np.ndarray) -> None:
        at = at[(at >= 0) & (after[at] < n)] if len(at) else at
        rank = table.ranks(symbol[at], symbol[after[at]])
        at, rank = at[rank < _NONE], rank[rank < _NONE]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        for part in np.split(np.arange(len(at)), np.flatnonzero(rank[1:] != rank[:-1]) + 1):
            if len(part):
                r = int(rank[part[0]])
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(queue, r)
                waiting[r].append(at[part])

    enqueue(np.arange(n - 1))
    while queue:
        r = heapq.heappop(queue)
        at = np.unique(np.concatenate(waiting.pop(r)))
        at = at[(symbol[at] >= 0) & (after[at] < n)]
        at = at[table.ranks(symbol[at], symbol[after[at]]) == r]
        if not len(at):
            continue
        at = at[every_other(np.concatenate([[False], after[at[:-1]] == at[1:]]))]
        second = after[at]
        third = after[second]
        symbol[at], symbol[second] = table.new[r], -1
        after[at] = third
        inside = third < n
        before[third[inside]] = at[inside]
        enqueue(np.unique(np.concatenate([before[at], at])))
    return symbol[symbol >= 0]


def merge_words(symbol: np.ndarray, size: np.ndarray, table: MergeTable) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, sizes) of all words after all merges; ``size`` symbols of each word stand in turn."""
    long = np.flatnonzero(size > LONG)
    starts = np.concatenate([[0], np.cumsum(size)])
    out_size = size.copy()
    done: dict[int, np.ndarray] = {}
    for w in long.tolist():
        done[w] = merge_long(symbol[starts[w]:starts[w + 1]], table)
        out_size[w] = len(done[w])
    word = np.repeat(np.arange(len(size)), size)
    stay = np.repeat(size <= LONG, size)
    sym, word = symbol[stay], word[stay]
    finished: list[tuple[np.ndarray, np.ndarray]] = []
    while len(sym):
        same = np.append(word[:-1] == word[1:], False)
        rank = np.full(len(sym), _NONE)
        at = np.flatnonzero(same)
        rank[at] = table.ranks(sym[at], sym[at + 1])
        first = np.flatnonzero(np.concatenate([[True], ~same[:-1]]))
        least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(sym))))
        idle = least == _NONE
        if idle.any():
            finished.append((word[idle], sym[idle]))
            sym, word, rank, least = sym[~idle], word[~idle], rank[~idle], least[~idle]
        place = np.flatnonzero(rank == least)
        if not len(place):
            break
        place = place[every_other(np.concatenate([[False], place[1:] == place[:-1] + 1]))]
        sym = sym.copy()
        sym[place] = table.new[rank[place]]
        stay = np.ones(len(sym), bool)
        stay[place + 1] = False
        sym, word = sym[stay], word[stay]
    finished += [(np.full(len(ids), w), ids) for w, ids in done.items()]
    if not finished:
        return np.zeros(0, np.int64), out_size
    word = np.concatenate([f[0] for f in finished])
    sym = np.concatenate([f[1] for f in finished])
    order = np.argsort(word, kind="stable")
    return sym[order], np.bincount(word, minlength=len(size))


def encode_words(words: list[bytes], table: MergeTable, first_byte: int = 0) -> list[bytes]:
    """The ids of each word as little-endian 32-bit numbers."""
    out: list[bytes] = []
    sizes = np.array([len(w) for w in words], np.int64)
    for a, b in cuts(sizes, SYMBOLS):
        symbol = np.frombuffer(b"".join(words[a:b]), np.uint8).astype(np.int64) + first_byte
        ids, size = merge_words(symbol, sizes[a:b], table)
        data, ends = ids.astype("<i4").tobytes(), (np.cumsum(size) * 4).tolist()
        out += [data[p:q] for p, q in zip([0, *ends], ends)]
    return out
