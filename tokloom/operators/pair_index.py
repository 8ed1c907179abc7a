"""Byte-pair-encoding training with an index of pairs kept up to date by differences.

``bpe.train`` counts all pairs of all words anew in every round. Here the pairs are counted once. A merge changes
only the words that hold its pair, and there only the pairs beside it; the tasks report these differences and the
driver keeps the counts of the best pairs exact with them.

What makes the driver's table both small and exact: a pair occurs from the step on that makes the younger of its symbols,
and never gains an occurrence later. So its place in the order (count falling, then first occurrence) only gets worse,
and a pair that is left out when it is behind the ``HOT`` best stays behind them. When the best pair known
falls back to where pairs were left out, all are counted again.

One job a round tries a batch of merges that the driver expects, in order, on top of those decided; every
difference carries its step. The driver then goes through the steps: while the merge it expected is the best
pair by exact counts, it counts; the rest of the batch is forgotten, and nothing has to be undone, because the words
are stored before the batch and merges are a list. The result equals strict training merge by merge.

Ties go to the pair seen first: the earliest word, then the leftmost place. Places are byte offsets in the word,
which other merges do not move. When the first occurrence of a pair goes, its place is only known to be later; the
next job finds it, and until then no decision rests on it.

State: blocks of words as flat arrays, written to the checkpoint folder and rewritten every ``REWRITE`` merges. A lost
task reads its blocks again and repeats the merges since. The first merges change most of the words, and every round
repeats those since the last rewriting, so the words are rewritten earlier then: after ``REWRITE_FIRST`` merges, or a
quarter of all. The words are dealt to as many files as there are cores, or more when these would hold more than
``FILE_BYTES``, since a file is one task's work in every round. The differences that reach the driver grow with the
number of symbols beside a merged pair, not with the corpus.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tokloom.functions.pattern import BASE_BYTES, DEFAULT_VOCAB_SIZE, SPECIAL_TOKENS
from tokloom.functions.symbols import MAX_SYMBOL_ID
from tokloom.operators.bpe import TrainResult
from tokloom.session import drop_stored, stored

HOT = 400_000
BATCH = 192
REWRITE = 512
REWRITE_FIRST = 32
FILE_BYTES = 4 << 20            # of words in one file of blocks
SYMBOLS = 1 << 21               # symbols that a task holds as arrays at once
ASK = 4_000
_PAIR = np.int64(1 << 21)      # a pair of symbols as one number: left * _PAIR + right
_NEVER = np.iinfo(np.int64).max
_BLOCK = "ranks binary, counts binary, sizes binary, symbols binary"


@dataclass
class Words:
    """Words as flat arrays: of each symbol its id, its word and its byte offset; of each word its rank and count."""

    symbol: np.ndarray
    word: np.ndarray
    at: np.ndarray
    rank: np.ndarray
    count: np.ndarray

    def beside(self) -> np.ndarray:
        """Whether symbols i and i + 1 are of one word."""
        return self.word[:-1] == self.word[1:]

    def kept(self, words: np.ndarray) -> Words:
        """Only the words marked in ``words``."""
        stay = words[self.word]
        number = np.cumsum(words) - 1
        return Words(self.symbol[stay], number[self.word[stay]], self.at[stay], self.rank[words], self.count[words])

    def places(self, shift: int) -> np.ndarray:
        """The order of each symbol among all: its word's rank, then its offset."""
        return (self.rank[self.word] << shift) + self.at

    def holding(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where some of the pairs (sorted) stand, and which."""
        if len(self.symbol) < 2 or not len(pairs):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # symbols first: few places have both of a pair's
        left, right = np.zeros((2, int(max(self.symbol.max(), (pairs // _PAIR).max(), (pairs % _PAIR).max())) + 1), bool)
        left[pairs // _PAIR], right[pairs % _PAIR] = True, True
        at = np.flatnonzero(left[self.symbol[:-1]] & right[self.symbol[1:]] & self.beside())
        key = self.symbol[at] * _PAIR + self.symbol[at + 1]
        hit = pairs[np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)] == key
        return at[hit], key[hit]


class Chain:
    """Words while they are merged: symbols linked to their neighbours, and the places of the pairs to merge."""

    def __init__(self, words: Words, merges: list[tuple[int, int]], shift: int):
        self.words, self.symbol = words, words.symbol.copy()
        n, beside = len(self.symbol), words.beside()
        number = np.arange(n)
        self.after, self.before = np.full(n, -1), np.full(n, -1)
        self.after[:-1][beside] = number[1:][beside]
        self.before[1:][beside] = number[:-1][beside]
        self.place, self.count = words.places(shift), words.count[words.word]
        self.wanted = np.unique(np.array([p for p, _ in merges], np.int64))
        at, key = words.holding(self.wanted)
        order = np.argsort(key, kind="stable")
        at, ends = at[order], np.searchsorted(key[order], self.wanted, "right")
        self.at = {int(p): [at[a:b]] for p, a, b in zip(self.wanted, np.concatenate([[0], ends[:-1]]), ends)}

    def _pairs(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct places that have a right neighbour, and their pairs."""
        at = np.unique(at)
        at = at[at >= 0]
        at = at[self.after[at] >= 0]
        return at, self.symbol[at] * _PAIR + self.symbol[self.after[at]]

    def merge(self, pair: int, new: int, report=None) -> None:
        """Replace the pair, from the left; ``report(kind, pairs, counts, places)`` of what goes (0) and comes (1)."""
        at, key = self._pairs(np.concatenate(self.at[pair]))
        at = at[key == pair]
        if not len(at):
            return
        a, b = divmod(pair, int(_PAIR))
        if a == b:  # of a run of equal symbols every other pair
            order = np.arange(len(at))
            fresh = np.concatenate([[True], self.after[at[:-1]] != at[1:]])
            at = at[(order - np.maximum.accumulate(np.where(fresh, order, 0))) % 2 == 0]
        second = self.after[at]
        if report is not None:
            gone, key = self._pairs(np.concatenate([self.before[at], at, second]))
            report(0, key, self.count[gone], self.place[gone])
        third = self.after[second]
        self.symbol[at], self.symbol[second] = new, -1
        self.after[at] = third
        self.before[third[third >= 0]] = at[third >= 0]
        come, key = self._pairs(np.concatenate([self.before[at], at]))
        if report is not None:
            report(1, key, self.count[come], self.place[come])
        hit = self.wanted[np.minimum(np.searchsorted(self.wanted, key), len(self.wanted) - 1)] == key
        for p in np.unique(key[hit]).tolist():
            self.at[p].append(come[key == p])

    def merged(self) -> Words:
        stay = self.symbol >= 0
        w = self.words
        return Words(self.symbol[stay], w.word[stay], w.at[stay], w.rank, w.count)


def _sums(key: np.ndarray, count: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, summed counts, least places)."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else order
    if not len(key):
        return key, count, place
    return key[first], np.add.reduceat(count[order], first), np.minimum.reduceat(place[order], first)


def _written(batches):
    """Rows (wrank, n, word) as blocks."""
    for batch in batches:
        if not batch.num_rows:
            continue
        word = batch.column("word").cast(pa.large_binary())
        size = np.array([len(w) for w in word.to_pylist()], np.int64)
        data = np.frombuffer(b"".join(word.to_pylist()), np.uint8).astype(np.int64)
        number = np.repeat(np.arange(len(size)), size)
        start = np.concatenate([[0], np.cumsum(size)])[:-1]
        yield _block(Words(data, number, np.arange(len(data)) - start[number], batch.column("wrank").to_numpy(),
                           batch.column("n").to_numpy()))


def _block(words: Words) -> pa.RecordBatch:
    """Words of two symbols or more; offsets follow from the symbols' lengths, so they are not written."""
    size = np.bincount(words.word, minlength=len(words.rank))
    words = words.kept(size > 1)
    parts = (words.rank.astype("<i8"), words.count.astype("<i8"),
             np.bincount(words.word, minlength=len(words.rank)).astype("<i4"), words.symbol.astype("<i4"))
    return pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts],
                                      ["ranks", "counts", "sizes", "symbols"])


def _reads(batches, lengths: np.ndarray):
    """The blocks of all batches, some at a time: as many as hold at most ``SYMBOLS`` symbols, or one."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("symbols")).to_numpy()) // 4
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + SYMBOLS, "right")))
            yield _read(batch.slice(at, to - at), lengths)
            at = to


def _read(batch: pa.RecordBatch, lengths: np.ndarray) -> Words:
    """All blocks of a batch as one."""
    part = [np.frombuffer(b"".join(batch.column(k).to_pylist()), kind).astype(np.int64)
            for k, kind in enumerate(("<i8", "<i8", "<i4", "<i4"))]
    rank, count, size, symbol = part
    word = np.repeat(np.arange(len(size)), size)
    long = lengths[symbol]
    end = np.cumsum(long)
    start = np.concatenate([[0], end])[:-1]
    first = np.concatenate([[0], np.cumsum(size)])[:-1]
    return Words(symbol, word, start - (start[first[word]] if len(word) else start), rank, count)


def _touched(words: Words, merges: list[tuple[int, int]]) -> np.ndarray:
    """The words that some of the merges may change: those that hold one of the pairs now. A pair with a symbol
    that one of the merges makes can only come to be in such a word."""
    out = np.zeros(len(words.rank), bool)
    out[words.word[words.holding(np.unique(np.array([p for p, _ in merges], np.int64)))[0]]] = True
    return out


def _advanced(words: Words, merges: list[tuple[int, int]], shift: int, report=None, from_step: int = 0) -> Words:
    """The touched words after all merges; ``report(step, ...)`` of the steps from ``from_step`` on."""
    chain = Chain(words.kept(_touched(words, merges)), merges, shift)
    for step, (pair, new) in enumerate(merges):
        tell = None if report is None or step < from_step else (
            lambda kind, *what, s=step - from_step: report(s, kind, *what))
        chain.merge(pair, new, tell)
    return chain.merged()


_NEWS = "step int, kind int, pair long, n long, first long"


def _news(rows: list[tuple]) -> pa.RecordBatch:
    """(step, kind, pair, n, first) of reported arrays, summed by step, kind and pair."""
    by: dict[tuple, list] = {}
    for step, kind, *what in rows:
        by.setdefault((step, kind), []).append(what)
    out = []
    for (step, kind), some in by.items():
        key, n, first = _sums(*(np.concatenate([s[k] for s in some]) for k in range(3)))
        out.append((np.full(len(key), step, np.int32), np.full(len(key), kind, np.int32), key, n, first))
    columns = [np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k in range(5)]
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                      ["step", "kind", "pair", "n", "first"])


class Forecast:
    """What the merges of a batch that were not decided would change, with the symbols they were tried under."""

    def __init__(self, base: int, names: list[tuple[int, int]], steps: list[tuple[dict, dict]]):
        self.base, self.names, self.steps = base, names, steps
        self.now: dict[int, int] = {}      # tried symbol -> symbol of the present guess
        self.place: dict[int, int] = {}    # pair of the present guess -> step
        self._settle()

    def _symbol(self, symbol: int) -> int | None:
        return symbol if symbol < self.base else self.now.get(symbol)

    def _pair(self, pair: int) -> int | None:
        a, b = (self._symbol(s) for s in divmod(pair, int(_PAIR)))
        return None if a is None or b is None else a * int(_PAIR) + b

    def _settle(self) -> None:
        for k, (pair, _) in enumerate(self.names):
            found = self._pair(pair)
            if found is not None:
                self.place.setdefault(found, k)

    def of(self, pair: int, symbol: int) -> list[tuple[int, int, int]] | None:
        """(pair, difference in count, least place) of merging ``pair`` to ``symbol``; None when it was not tried."""
        k = self.place.get(pair)
        if k is None:
            return None
        self.now[self.names[k][1]] = symbol
        self._settle()
        out = []
        for sign, part in zip((-1, 1), self.steps[k]):
            for other, (n, first) in part.items():
                found = self._pair(other)
                if found is not None:
                    out.append((found, sign * n, first))
        return out


class PairIndex:
    """The best pairs in order, exact in count; the first place may lag behind (then it is too early)."""

    def __init__(self, hot: int):
        self.hot, self.floor = hot, None
        self.count: dict[int, int] = {}
        self.first: dict[int, int] = {}
        self.lags: set[int] = set()
        self.heap: list[tuple[int, int, int]] = []

    def fill(self, rows, complete: bool) -> None:
        """Rows (pair, n, first) in order; unless ``complete``, others lie behind the last."""
        self.count = {p: n for p, n, _ in rows}
        self.first = {p: f for p, _, f in rows}
        self.lags = set()
        self.heap = [(-n, f, p) for p, n, f in rows]
        self.floor = None if complete else (-rows[-1][1], rows[-1][2])

    def top(self) -> tuple[int, int, int] | None:
        """(-count, first, pair) that leads, or None."""
        while self.heap:
            n, first, pair = self.heap[0]
            if self.count.get(pair) == -n and self.first[pair] == first:
                return self.heap[0]
            heapq.heappop(self.heap)
        return None

    def exhausted(self) -> bool:
        """Whether pairs that were left out might lead by now."""
        top = self.top()
        return self.floor is not None and (top is None or top[:2] > self.floor)

    def undecided(self) -> bool:
        """Whether the lead rests on a place that lags: a tie in the count, and the leader's place is too early."""
        top = self.top()
        if top is None or top[2] not in self.lags:
            return False
        heapq.heappop(self.heap)
        second = self.top()
        heapq.heappush(self.heap, top)
        return second is not None and second[0] == top[0] or self.floor is not None and self.floor[0] == top[0]

    def put(self, pair: int, n: int, first: int) -> None:
        if n:
            self.count[pair], self.first[pair] = n, first
            heapq.heappush(self.heap, (-n, first, pair))
        else:
            self.count.pop(pair, None)
            self.first.pop(pair, None)
            self.lags.discard(pair)

    def placed(self, pair: int, first: int) -> None:
        """The exact place of a pair that lagged."""
        self.lags.discard(pair)
        if pair in self.count and first != self.first[pair]:
            self.put(pair, self.count[pair], first)

    def differ(self, gone: dict, come: dict) -> None:
        """Differences {pair: (count, least place)} of one merge."""
        for pair, (n, first) in come.items():
            # a pair has all its occurrences from one step; what the same step takes away again is in ``gone``
            if pair in self.count:
                self.put(pair, self.count[pair] + n, min(first, self.first[pair]))
            else:
                self.put(pair, n, first)
        for pair, (n, first) in gone.items():
            if pair in self.count:
                left = self.count[pair] - n
                if left and first <= self.first[pair]:
                    self.lags.add(pair)
                self.put(pair, left, self.first[pair])
        if len(self.count) > 4 * self.hot:
            best = heapq.nsmallest(self.hot, ((-n, self.first[p], p) for p, n in self.count.items()))
            lags, floor = self.lags, self.floor
            self.fill([(p, -n, f) for n, f, p in best], False)
            self.lags = lags & self.count.keys()
            self.floor = min(f for f in (self.floor, floor) if f is not None)

    def expected(self, most: int, base: int, forecast: Forecast) -> list[int]:
        """Pairs that may be merged next, in order, as symbols from ``base`` on: a guess.

        What a merge changes is known roughly when the last batch tried it in vain (``forecast``). After a merge that is
        new, pairs that it shortens are taken to fall back.
        """
        out: list[int] = []
        changed: dict[int, tuple[int, int]] = {}
        more: list[tuple[int, int, int]] = []
        taken, lefts, rights = [], set(), set()

        def change(pair: int, n: int, first: int) -> None:
            had, place = changed.get(pair) or (self.count.get(pair, 0), self.first.get(pair, first))
            changed[pair] = (had + n, min(place, first) if n > 0 else place)
            heapq.heappush(more, (-changed[pair][0], changed[pair][1], pair))

        while len(out) < most:
            while (top := self.top()) is not None and top[2] in changed:
                taken.append(heapq.heappop(self.heap))
            while more and changed[more[0][2]] != (-more[0][0], more[0][1]):
                heapq.heappop(more)
            if more and (top is None or more[0] < top):
                top = heapq.heappop(more)
            elif top is not None:
                taken.append(heapq.heappop(self.heap))
            if top is None or not top[0] or self.floor is not None and top[:2] > self.floor:
                break
            pair = top[2]
            a, b = divmod(pair, int(_PAIR))
            changed[pair] = (0, top[1])
            if a in rights or b in lefts:
                continue
            out.append(pair)
            known = forecast.of(pair, base + len(out) - 1)
            if known is None:
                lefts.add(a)
                rights.add(b)
                continue
            for other, n, first in known:
                if other != pair:
                    change(other, n, first)
        for entry in taken:
            heapq.heappush(self.heap, entry)
        return out

    def asked(self, most: int) -> list[int]:
        """Pairs whose places lag, the leading ones."""
        return heapq.nsmallest(most, self.lags, key=lambda p: (-self.count[p], self.first[p]))


def _all_pairs(blocks: DataFrame, merges, lengths, shift: int, hot: int) -> tuple[list[tuple], bool]:
    """The ``hot`` best (pair, n, first) after ``merges``, in order, and whether these are all."""
    def run(batches):
        for words in _reads(batches, lengths):
            touched = _touched(words, merges)
            for part in (words.kept(~touched), _advanced(words, merges, shift)):
                at = np.flatnonzero(part.beside())
                key = part.symbol[at] * _PAIR + part.symbol[at + 1]
                yield _news([(0, 0, key, part.count[part.word[at]], part.places(shift)[at])])

    found = (blocks.mapInArrow(run, _NEWS).groupBy("pair").agg(F.sum("n").alias("n"), F.min("first").alias("first"))
             .orderBy(F.desc("n"), "first").limit(hot + 1).toArrow())
    rows = list(zip(*(found.column(c).to_pylist() for c in ("pair", "n", "first"))))
    return rows[:hot], len(rows) <= hot


def _tried(blocks: DataFrame, done, batch, asked, lengths, shift: int) -> tuple[list[tuple[dict, dict]], dict]:
    """Differences of each step of the batch, [(gone, come)], and the exact places of the asked pairs before it."""
    want = np.array(sorted(asked), np.int64)
    merges = [*done, *batch]

    def run(batches):
        for words in _reads(batches, lengths):
            news: list[tuple] = []
            if len(want):
                # words that the merges so far touch are as they are now, the others as they are stored
                touched = _touched(words, done)
                for part in (words.kept(~touched), _advanced(words, done, shift)):
                    at, key = part.holding(want)
                    news.append((-1, 0, key, part.count[part.word[at]], part.places(shift)[at]))
            _advanced(words, merges, shift, lambda step, kind, *what: news.append((step, kind, *what)), len(done))
            yield _news(news)

    got = (blocks.mapInArrow(run, _NEWS).groupBy("step", "kind", "pair")
           .agg(F.sum("n").alias("n"), F.min("first").alias("first")).toArrow())
    steps: list[tuple[dict, dict]] = [({}, {}) for _ in batch]
    places = {}
    for step, kind, pair, n, first in zip(*(got.column(c).to_pylist() for c in ("step", "kind", "pair", "n", "first"))):
        if step < 0:
            places[pair] = first
        else:
            steps[step][kind][pair] = (n, first)
    return steps, places


def _rewritten(blocks: DataFrame, done, lengths, shift: int) -> tuple[DataFrame, str]:
    def run(batches):
        for words in _reads(batches, lengths):
            touched = _touched(words, done)
            yield _block(words.kept(~touched))
            yield _block(_advanced(words, done, shift))

    return stored(blocks.mapInArrow(run, _BLOCK), "bpe-blocks")


def train_indexed(state: DataFrame, num_merges: int | None = None, vocab_size: int = DEFAULT_VOCAB_SIZE,
                  n_special: int = len(SPECIAL_TOKENS), batch: int = BATCH, rewrite: int = REWRITE, hot: int = HOT,
                  progress=None) -> TrainResult:
    """H1: the merges of ``bpe.train`` on the same state (word, n, wrank), from an index of pairs.

    ``TrainResult.state`` stays empty; ``rounds`` counts the jobs that tried a batch.
    """
    spark = state.sparkSession
    limit = vocab_size - BASE_BYTES - n_special if num_merges is None else num_merges
    if BASE_BYTES + limit - 1 > min(MAX_SYMBOL_ID, int(_PAIR) - 1):
        raise ValueError("vocabulary too large for one-character symbols")
    octets = F.octet_length("word")
    sizes = state.agg(F.max("wrank").alias("r"), F.max(octets).alias("n"), F.sum(octets).alias("all")).first()
    shift = int(sizes["n"] or 0).bit_length()
    if (sizes["r"] or 0) >> (62 - shift):
        raise ValueError("too many or too long words for a place of 63 bits")
    files = max(spark.sparkContext.defaultParallelism, -(-int(sizes["all"] or 0) // FILE_BYTES))
    blocks, path = stored(state.select(F.col("wrank").cast("long").alias("wrank"), F.col("n").cast("long").alias("n"),
                                       "word").filter(octets > 1).repartition(files, "wrank")
                          .mapInArrow(_written, _BLOCK), "bpe-blocks")
    res, index, done = TrainResult(), PairIndex(hot), []
    lengths = np.ones(BASE_BYTES + limit, np.int64)
    index.fill(*_all_pairs(blocks, done, lengths, shift, hot))
    size, forecast = batch, Forecast(BASE_BYTES, [], [])
    while len(res.merges) < limit:
        if index.exhausted():
            index.fill(*_all_pairs(blocks, done, lengths, shift, hot))
        base = BASE_BYTES + len(res.merges)
        expected = index.expected(min(size, limit - len(res.merges)), base, forecast)
        if not expected:
            break
        names = [(p, base + k) for k, p in enumerate(expected)]
        steps, places = _tried(blocks, done, names, index.asked(ASK), lengths, shift)
        for pair, first in places.items():
            index.placed(pair, first)
        good = 0
        for (pair, new), (gone, come) in zip(names, steps):
            if index.exhausted() or index.undecided():
                break
            top = index.top()
            if top is None or top[2] != pair:
                break
            a, b = divmod(pair, int(_PAIR))
            res.merges.append((a, b, new, index.count[pair]))
            lengths[new] = lengths[a] + lengths[b]
            index.differ(gone, come)
            good += 1
        done += names[:good]
        res.rounds += 1
        forecast = Forecast(base + good, names[good:], steps[good:])
        size = min(batch, max(32, 3 * good))
        if min(rewrite, max(REWRITE_FIRST, len(res.merges) // 4)) <= len(done) and len(res.merges) < limit:
            old = path
            blocks, path = _rewritten(blocks, done, lengths, shift)
            drop_stored(spark, old)
            done = []
        if progress is not None:
            progress(res.rounds, len(res.merges))
    drop_stored(spark, path)
    return res
