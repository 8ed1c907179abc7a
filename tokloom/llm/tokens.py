"""Token ids of whole texts by a public tokenizer file.

The tokenizer's own pattern never joins characters across white space and drops the white space, so the
ids of a text are the ids of its space-separated words in turn. Words of Latin letters and a tail of marks
are cut in two, as its pattern would cut them, and their letters lower-cased; numpy does so for all bytes of
a column of texts at once. Arrow gives the distinct parts, each is looked up once, and the ids of all texts
are gathered with numpy. The tokenizer sees a part once per Python worker, and parts of letters many at a time.
The memo of parts lies in flat arrays and is bounded: a full one keeps what the texts at hand hold, which changes
the time, not the ids.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

from tokloom.functions.arrow_lists import gather
from tokloom.llm import bytetext as B

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

DEFAULT_FILE = "word_bpe_49k.json"
END_ID = 1
WORD_END = "</w>"   # of the tokens that end a word
SLICE_BYTES = 1 << 20  # of text that is cut and looked up at once
MEMO_PARTS = 300_000
MEMO_WORDS = 1_000  # words of letters that the tokenizer is asked for at a time, as one text

#: Lower-case letters that composing leaves alone.
_LETTERS = re.compile("[a-zß-öø-ÿ]+")
_SPACE, _LETTER, _MARK, _OTHER = range(4)
#: Of each byte; one from U+00C0 to U+00FF is a letter but for two, see ``_parts``.
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[B.IS_SPACE] = _SPACE
_KIND[[*range(65, 91), *range(97, 123), 0xC3, *range(0x80, 0xC0)]] = _LETTER
_KIND[list(b".,!?;:|#*$%&()")] = _MARK
_LOADED: dict[int, tuple] = {}


def tokenizer_file(spark: SparkSession, path: str | None = None):
    """The tokenizer's JSON as a broadcast variable: executors need no file of their own."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(DEFAULT_FILE)
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def _loaded(source) -> tuple:
    key = hash(source)
    if key not in _LOADED:
        from tokenizers import Tokenizer

        _LOADED.clear()
        tokenizer = Tokenizer.from_str(source)
        _LOADED[key] = (tokenizer, Memo(tokenizer))
    return _LOADED[key]


class Memo:
    """Distinct parts of words and their ids end to end: those of part i are ``ids[first[i]:first[i] + size[i]]``."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)  # ids that end a word
        self.last[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.clear()

    def clear(self) -> None:
        self.parts = pa.array([], pa.large_string())
        self.ids = np.zeros(0, "<u4")
        self.first, self.size = np.zeros((2, 0), np.int64)

    def add(self, parts: pa.Array, ids: np.ndarray, size: np.ndarray) -> None:
        self.parts = pa.concat_arrays([self.parts, parts])
        self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, ids])

    def keep(self, places: np.ndarray) -> None:
        """Forget all parts but these, which become the first ones in turn."""
        parts, size = self.parts.take(pa.array(places)), self.size[places]
        ids, _ = gather(self.ids, self.first[places], size)
        self.clear()
        self.add(parts, ids, size)

    def find(self, parts: pa.Array) -> np.ndarray:
        """The places of distinct parts; new ones are told to the tokenizer and kept."""
        at = pc.fill_null(pc.index_in(parts, value_set=self.parts), -1).to_numpy().astype(np.int64)
        new = at < 0
        if new.any():
            told = parts.filter(pa.array(new))
            if len(self.parts) + len(told) > MEMO_PARTS:
                self.keep(at[~new])
                at[~new] = np.arange(len(self.parts))
            at[new] = len(self.parts) + np.arange(len(told))
            self.add(told, *self.encoded(told.to_pylist()))
        return at

    def encoded(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all parts end to end, and how many each has."""
        letters = np.fromiter((_LETTERS.fullmatch(p) is not None for p in parts), bool, len(parts))
        size, some = np.zeros(len(parts), np.int64), []
        for kind, encode in ((True, self._joined), (False, self._apart)):
            places = np.flatnonzero(letters == kind)
            ids, size[places] = encode([parts[i] for i in places.tolist()])
            some.append((places, ids))
        first = np.cumsum(size) - size
        out = np.zeros(size.sum(), "<u4")
        for places, ids in some:
            n = size[places]
            out[np.arange(len(ids)) + np.repeat(first[places] - (np.cumsum(n) - n), n)] = ids
        return out, size

    def _apart(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, size = [np.zeros(0, "<u4")], []
        for at in range(0, len(parts), 10_000):
            for got in self.tokenizer.encode_batch_fast(parts[at:at + 10_000], add_special_tokens=False):
                ids.append(np.array(got.ids, "<u4"))
                size.append(len(ids[-1]))
        return np.concatenate(ids), np.array(size, np.int64)

    def _joined(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_apart``, for words of letters: a text of many of them, cut again behind the ids that end a word."""
        ids, size = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for at in range(0, len(parts), MEMO_WORDS):
            some = parts[at:at + MEMO_WORDS]
            got = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0]
            told = np.array(got.ids, "<u4")
            ends = np.flatnonzero(self.last[told]) + 1
            if len(ends) == len(some) and ends[-1] == len(told):
                n = np.diff(ends, prepend=0)
            else:  # a tokenizer that doesn't mark a word's end
                told, n = self._apart(some)
            ids.append(told)
            size.append(n)
        return np.concatenate(ids), np.concatenate(size)


def _parts(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The parts of all words of a column of texts, and where each text's begin, plus the end."""
    raw, starts = B.flat(text)
    kind = _KIND[raw]
    wide = np.flatnonzero(raw == 0xC3)
    kind[wide[np.isin(raw[wide + 1], (0x97, 0xB7))]] = _OTHER  # the signs for times and divided by
    inside = kind != _SPACE
    begin, end, first = B.runs(inside, starts)
    if not len(begin):
        return pa.array([], pa.large_string()), first

    def word(places):
        return np.searchsorted(begin, places, "right") - 1

    # a word is cut where its letters end; one with other characters, or letters behind marks, stays as it is
    change = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    before, after = kind[change - 1], kind[change]
    cut, back = change[(before == _LETTER) & (after == _MARK)], change[(before == _MARK) & (after == _LETTER)]
    of_cut, of_back = word(cut), word(back)
    whole = kind[begin] == _MARK
    whole[word(np.flatnonzero(kind == _OTHER))] = True
    whole[of_back[back > begin[of_back]]] = True
    cut, of_cut = (x[(cut > begin[of_cut]) & ~whole[of_cut]] for x in (cut, of_cut))

    low = B.LOWER[raw]
    wide = wide[low[wide + 1] <= 0x9E] + 1
    low[wide] += 0x20
    n = (end - begin)[whole]
    as_is = np.arange(n.sum()) + np.repeat(begin[whole] - (np.cumsum(n) - n), n)
    low[as_is] = raw[as_is]

    two = np.zeros(len(begin), np.int64)
    two[of_cut] = 1
    place = np.arange(len(begin)) + np.cumsum(two) - two
    size = np.empty(len(begin) + len(cut), np.int64)
    size[place + two] = end - begin
    size[place[of_cut]] = cut - begin[of_cut]
    size[place[of_cut] + 1] = end[of_cut] - cut
    bounds = np.concatenate([[0], np.cumsum(size)])
    parts = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(bounds), pa.py_buffer(low[inside]))
    return parts, np.append(place, len(size))[first]


def token_ids(text: pa.Array, source: str, end_id: int | None = END_ID
              ) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of texts (uint32) and where each text's begin, plus the end.

    Null counts as empty; ``end_id`` follows each text.
    """
    memo = _loaded(source)[1]
    parts, bounds = _parts(text)
    coded = parts.dictionary_encode()
    place = memo.find(coded.dictionary)[coded.indices.to_numpy()]
    stream, at = gather(memo.ids, memo.first[place], memo.size[place])
    starts = at[bounds]
    if end_id is None:
        return stream, starts
    starts = starts + np.arange(len(starts))
    out = np.full(starts[-1], end_id, "<u4")
    inside = np.ones(len(out), bool)
    inside[starts[1:] - 1] = False
    out[inside] = stream
    return out, starts


def largest_id(source: str) -> int:
    return max(_loaded(source)[0].get_vocab(with_added_tokens=True).values(), default=0)
