"""Token counts of whole texts by rank-synchronous merging of arrays.

The tokenizer is a BPE model with scored pieces and byte fallback: a text gets one space in front, a space is
written as a mark, and of all neighbours that together are a piece the pair with the best score merges, the
leftmost of equals, until no two neighbours are a piece. A symbol that is no piece counts its UTF-8 bytes.

1. Two characters that stand side by side in no piece can never be joined, so a text is cut between them; the cuts
   follow from the pieces alone (before a space after a letter, between most ideographs).
2. The pre-tokens of a slice are dictionary-encoded by Arrow; the distinct ones are held as one flat array of
   symbols with the number of their sequence.
3. In every round each sequence finds its lowest rank and merges that pair, all sequences at once. All places of the
   pair merge together, from the left, where its piece is in no piece of the same or a lower rank; else a merge
   could make a better pair than the next place, so the leftmost place alone merges. Finished sequences
   leave the arrays.
4. A sequence's count is that of its surviving symbols; a text's is the sum over its pre-tokens.

Sequences of more than ``LONG`` symbols (endless runs without a cut) merge with a heap over a linked list
instead, whose time does not grow with the square of the length. Texts of more than a slice are cut before a
space into parts, so memory is bounded by the longest stretch that has no such place.

Edge cases: null and empty texts have no token. Rows that repeat an id, or have none, are counted row by
row. An empty table gives no rows. Extra columns are never read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tokloom.llm import bytetext as B
from tokloom.llm.common import named_rows

DEFAULT_FILE = "piece_bpe_32k.model"
LIMIT = 4096
LONG = 1024
MARK = "▁"
_NONE = np.iinfo(np.int32).max


class Tables:
    """Lookup arrays of a list of (piece, score): symbols, merges and the pairs of characters to cut at."""

    def __init__(self, pieces: list[tuple[str, float]]):
        names = [p for p, _ in pieces]
        known = set(names)
        chars = sorted({c for p in names for c in p})
        # four symbols for characters of no piece, by their number of UTF-8 bytes
        self.symbol = {s: i + 4 for i, s in enumerate([*chars, *sorted(p for p in known if len(p) > 1)])}
        self.weight = np.array([1, 2, 3, 4] + [1 if s in known else len(s.encode()) for s in self.symbol],
                               np.int64)
        order = {s: k for k, s in enumerate(sorted({-score for _, score in pieces}))}
        rank = {p: order[-score] for p, score in pieces}
        shared = np.bincount([rank[p] for p in names])
        alone = {p: shared[rank[p]] == 1 for p in names}
        n = self.size = len(self.weight)
        merges = []
        for p in names:
            for k in range(1, len(p)):
                a, b = self.symbol.get(p[:k]), self.symbol.get(p[k:])
                if a is None or b is None:
                    continue
                merges.append((a * n + b, rank[p], self.symbol[p]))
                for part in (p[:k], p[k:]):
                    if part in rank and rank[p] <= rank[part]:
                        alone[part] = False
        merges = np.array(sorted(set(merges)) or [(-1, 0, 0)], np.int64)
        self.key, self.rank, self.result = merges[:, 0].copy(), merges[:, 1].astype(np.int32), merges[:, 2].copy()
        self.together = np.zeros(n, bool)  # all places of the pair may merge at once
        for p in names:
            self.together[self.symbol[p]] = alone[p]
        # the symbol and the class of every code point; class 0 stands beside nothing
        code = np.arange(0x110000)
        self.of_code = np.where(code < 0x80, 0, np.where(code < 0x800, 1, np.where(code < 0x10000, 2, 3))
                                ).astype(np.int32)
        for c in chars:
            self.of_code[ord(c)] = self.symbol[c]
        near = {(p[k], p[k + 1]) for p in names for k in range(len(p) - 1)}
        sides = sorted({c for pair in near for c in pair})
        number = {c: k + 1 for k, c in enumerate(sides)}
        self.side = np.zeros(0x110000, np.int32)
        for c, k in number.items():
            self.side[ord(c)] = k
        self.near = np.zeros((len(sides) + 1, len(sides) + 1), bool)
        for a, b in near:
            self.near[number[a], number[b]] = True
        if MARK in self.symbol:
            self.of_code[0x20], self.side[0x20] = self.of_code[ord(MARK)], self.side[ord(MARK)]
        #: whether a text may always be cut before a space that follows something else than a space
        mark = self.side[0x20]
        self.cut_at_space = not self.near[np.arange(len(self.near)) != mark, mark].any()

    def lookup(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, symbol) of the merge of each pair of symbols; rank _NONE where there is none."""
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        hit = self.key[at] == key
        return np.where(hit, self.rank[at], _NONE).astype(np.int32), self.result[at]

    def merge_of(self, a: int, b: int) -> tuple[int, int] | None:
        key = a * self.size + b
        at = int(np.searchsorted(self.key, key))
        return (int(self.rank[at]), int(self.result[at])) if at < len(self.key) and self.key[at] == key else None


def merged_counts(symbol: np.ndarray, starts: np.ndarray, tables: Tables) -> np.ndarray:
    """Tokens of each sequence of symbols; ``starts`` are the sequences' places, plus the end."""
    size = np.diff(starts)
    out = np.zeros(len(size), np.int64)
    for i in np.flatnonzero(size > LONG):
        out[i] = _heap_count(symbol[starts[i]:starts[i + 1]].tolist(), tables)
    short = np.flatnonzero((size > 0) & (size <= LONG))
    sym = symbol[np.repeat(size <= LONG, size)].astype(np.int64)
    seq = np.repeat(np.arange(len(short)), size[short])  # numbers of the sequences still at work
    name = short
    last = np.ones(len(seq), bool)
    last[:-1] = seq[:-1] != seq[1:]
    rank = np.full(len(seq), _NONE, np.int32)
    result = np.zeros(len(seq), np.int64)
    at = np.flatnonzero(~last)
    rank[at], result[at] = tables.lookup(sym[at], sym[at + 1])
    while len(seq):
        first = np.flatnonzero(np.concatenate([[True], last[:-1]]))
        least = np.minimum.reduceat(rank, first)
        done = least == _NONE
        if done.any():
            out[name[done]] = np.add.reduceat(tables.weight[sym], first)[done]
            stay = np.repeat(~done, np.diff(np.append(first, len(seq))))
            sym, seq, last, rank, result = sym[stay], seq[stay], last[stay], rank[stay], result[stay]
            name, least = name[~done], least[~done]
            if not len(sym):
                break
            seq = np.concatenate([[0], np.cumsum(last)[:-1]])
        place = np.flatnonzero(rank == least[seq])
        fresh = np.concatenate([[True], (place[1:] != place[:-1] + 1)])
        order = np.arange(len(place)) - np.maximum.accumulate(np.where(fresh, np.arange(len(place)), 0))
        leftmost = np.concatenate([[True], seq[place[1:]] != seq[place[:-1]]])
        place = place[np.where(tables.together[result[place]], order % 2 == 0, leftmost)]
        sym[place] = result[place]
        last[place] = last[place + 1]
        stay = np.ones(len(sym), bool)
        stay[place + 1] = False
        moved = place - np.arange(len(place))  # each earlier merge took one symbol away
        sym, seq, last, rank, result = sym[stay], seq[stay], last[stay], rank[stay], result[stay]
        before = moved[moved > 0] - 1
        new = np.unique(np.concatenate([moved, before[~last[before]]]))
        rank[new] = _NONE
        new = new[~last[new]]
        rank[new], result[new] = tables.lookup(sym[new], sym[new + 1])
    return out


def _heap_count(symbol: list[int], tables: Tables) -> int:
    """Tokens of one long sequence: best pair first, leftmost of equals, from a heap over a linked list."""
    n = len(symbol)
    after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    flat = np.array(symbol, np.int64)
    rank, result = tables.lookup(flat[:-1], flat[1:])
    heap = [(r, i, symbol[i], symbol[i + 1], s) for i, (r, s) in enumerate(zip(rank.tolist(), result.tolist()))
            if r != _NONE]
    heapq.heapify(heap)

    def offer(i: int) -> None:
        j = after[i]
        got = tables.merge_of(symbol[i], symbol[j]) if j < n else None
        if got:
            heapq.heappush(heap, (got[0], i, symbol[i], symbol[j], got[1]))

    while heap:
        _, i, a, b, s = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or symbol[i] != a or j >= n or symbol[j] != b:
            continue
        symbol[i], alive[j], after[i] = s, False, after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return int(tables.weight[[s for s, there in zip(symbol, alive) if there]].sum())


def _pre_tokens(text: pa.Array, tables: Tables) -> tuple[pa.Array, np.ndarray]:
    """All pre-tokens of a column without nulls, and where each text's begin, plus the end."""
    raw, starts = B.flat(text)
    data = raw.tobytes()
    code = np.frombuffer(data.decode().encode("utf-32-le"), "<u4")
    first_byte = np.flatnonzero((raw & 0xC0) != 0x80)
    side = tables.side[code]
    cut = np.ones(len(code), bool)
    cut[1:] = ~tables.near[side[:-1], side[1:]]
    begins = np.searchsorted(first_byte, starts)  # the first character of each text
    cut[begins[:-1][begins[:-1] < len(code)]] = True
    at = first_byte[cut]
    offsets = np.append(at, len(raw)).astype(np.int64)
    return (pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)),
            np.searchsorted(at, starts))


def token_counts(text: pa.Array, tables: Tables) -> np.ndarray:
    """Tokens of each text of an Arrow column."""
    text = pc.fill_null(text.cast(pa.large_string()), "")
    lead = pc.if_else(pc.equal(pc.binary_length(text), 0), "", " ").cast(pa.large_string())
    tokens, bounds = _pre_tokens(pc.binary_join_element_wise(lead, text, pa.scalar("", pa.large_string())), tables)
    coded = tokens.dictionary_encode()
    raw, starts = B.flat(coded.dictionary)
    code = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), "<u4")
    chars = np.append(0, np.cumsum((raw & 0xC0) != 0x80))[starts]
    each = merged_counts(tables.of_code[code], chars, tables)
    total = np.append(0, np.cumsum(each[coded.indices.to_numpy()]))
    return total[bounds[1:]] - total[bounds[:-1]]


def _parts(text: str, limit: int) -> list[str]:
    """A long text in parts that begin with a space after another character; the first space of
    each part but the first stands for the one that every text gets in front."""
    out, at = [], 0
    while len(text) - at > limit:
        to = at + limit
        while (to := text.find(" ", to)) > 0 and text[to - 1] in (" ", MARK):
            to += 1
        if to < 0:
            break
        out.append(text[at:to])
        at = to + 1
    return [*out, text[at:]]


def _long_count(text: str, tables: Tables, limit: int) -> int:
    if not tables.cut_at_space:
        return int(token_counts(pa.array([text], pa.large_string()), tables)[0])
    total = 0
    for part in _parts(text, limit):
        # an empty part is a text's last space alone
        total += int(token_counts(pa.array([part], pa.large_string()), tables)[0]) if part else \
            int(tables.weight[tables.of_code[0x20]])
    return total


def slice_counts(text: pa.Array, tables: Tables, limit: int = B.SLICE_BYTES) -> np.ndarray:
    """``token_counts`` with bounded memory also for a single text of more than ``limit`` bytes."""
    if len(text) == 1 and text[0].is_valid and B.lengths(text)[0] > limit:
        return np.array([_long_count(text[0].as_py(), tables, limit)])
    return token_counts(text, tables)


def scored_pieces(path: str | None = None) -> list[tuple[str, float]]:
    """(piece, score) of the model's ordinary pieces; control, unknown and byte pieces never match text.

    The method covers models that neither normalise texts nor have unused pieces; another is refused.
    """
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(DEFAULT_FILE)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    if any(model.is_unused(i) for i in ids) or model.normalize(" ﬁ  é") != f"{MARK * 2}ﬁ{MARK * 2}é":
        raise ValueError(f"{path}: a model that normalises texts or has unused pieces")
    return [(model.id_to_piece(i), model.get_score(i)) for i in ids
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


_LOADED: dict[int, Tables] = {}


def _tables(pieces) -> Tables:
    key = hash(tuple(pieces[:: max(1, len(pieces) // 64)])) ^ len(pieces)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Tables(pieces)
    return _LOADED[key]


def count_tokens(spark: SparkSession, docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row; only the pieces travel to the executors."""
    pieces = spark.sparkContext.broadcast(scored_pieces(path))

    def run(batches):
        tables = _tables(pieces.value)
        for batch in batches:
            for part in B.slices(batch, "text"):
                text = part.column("text")
                n = slice_counts(text, tables)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(B.lengths(text)), pa.array(n), pa.array(n > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return named_rows(docs, doc_id="long", text="string").mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean").select(
        "doc_id", "n_bytes", "n_tokens", "over_limit")
