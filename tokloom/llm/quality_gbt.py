"""Quality rules: gradient-boosted trees over document statistics.

The statistics of a whole text are counted with numpy passes over its bytes. The trees are fitted on the
driver on at most ``SAMPLE_DOCS`` labelled rows (the documented bound), drawn by a seeded hash, and flattened
into node arrays (feature, threshold, children, value), which score a batch of documents by stepping all
documents through all trees at once. On the features in ``MONOTONE`` the verdict is monotonic: more symbols,
repeated words, duplicate lines or capitals never raise a score. A split that would break this is not
taken, and the values below a split stay on their side of its middle.

Edge cases: a null text has no words and fails the base rules, like an empty one. Rows with a null or
repeated id are judged row by row; of labels that repeat an id the least counts, and labels with a null id or
label are not learned. If the learnable rows lack a class, the base rules alone decide. Extra columns are
never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tokloom.llm import bytetext as B
from tokloom.llm.common import named_rows

SAMPLE_DOCS = 20_000
TREES, DEPTH, BINS = 60, 4, 64
RATE, RIDGE, LEAST_LEAF = 0.15, 1.0, 10
SEED = 17
LEAST_WORDS, MOST_REPEATED = 50, 50

#: Base statistics, in the order of the result's columns.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "word_length", "symbols_a_word", "duplicate_lines", "repeated_words",
            "capitals", "digits", "marks", "short_words", "distinct_words", "words_a_line", "sentence_ends")
#: Sign of a feature's allowed effect.
MONOTONE = {"symbols_a_word": -1, "duplicate_lines": -1, "repeated_words": -1, "capitals": -1}
_SIGN = np.array([MONOTONE.get(f, 0) for f in FEATURES])


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL, _UPPER, _NUMBER = _table(b"#*$%&|<>"), _table(bytes(range(65, 91))), _table(b"0123456789")
_MARK, _END = _table(b"!?\"'(){}[]=/\\_~^+@;:-"), _table(b".!?")


def _repeated(key: np.ndarray) -> np.ndarray:
    """Which elements occur twice or more."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def statistics(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Base statistics (texts x BASE) and features (texts x FEATURES) of an Arrow column."""
    raw, starts = B.flat(text)
    n = len(text)
    space = B.IS_SPACE[raw]
    begin, end, first = B.runs(~space, starts)
    words = B.run_hashes(raw, begin, end)
    doc = np.repeat(np.arange(n), np.diff(first))
    salt = B.mix(np.arange(n, dtype=np.uint64) + np.uint64(1))

    def per_text(flags, bounds):
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[bounds[1:]] - total[bounds[:-1]]

    n_words = np.diff(first)
    chars = per_text(~space & ((raw & 0xC0) != 0x80), starts)
    count = {k: per_text(t[raw], starts) for k, t in (("symbol", _SYMBOL), ("upper", _UPPER),
                                                       ("digit", _NUMBER), ("mark", _MARK))}
    # words in repeated windows of three
    covered = np.zeros(len(words) + 2, bool)
    if len(words) >= 3:
        window = B.joined_hashes(words, 3) ^ salt[doc[:-2]]
        own = np.flatnonzero(doc[:-2] == doc[2:])
        at = own[_repeated(window[own])]
        for k in range(3):
            covered[at + k] = True
    n_repeat = per_text(covered[:len(words)], first)
    # lines with a word, equal to an earlier one
    line_begin, line_end, line_first = B.runs(raw != 10, starts)
    has_word = np.searchsorted(begin, line_end, "left") > np.searchsorted(begin, line_begin, "left")
    line_doc = np.repeat(np.arange(n), np.diff(line_first))[has_word]
    lines = B.run_hashes(raw, line_begin, line_end)[has_word] ^ salt[line_doc]
    _, earliest = np.unique(lines, return_index=True)
    n_lines = np.bincount(line_doc, minlength=n)
    n_dup = n_lines - np.bincount(line_doc[earliest], minlength=n)
    base = np.stack([n_words, chars, count["symbol"], n_dup, n_repeat], axis=1)

    _, once = np.unique(words ^ salt[doc], return_index=True)
    distinct = np.bincount(doc[once], minlength=n)
    short = per_text(end - begin <= 3, first)
    ends = per_text(_END[raw[end - 1]] if len(end) else np.zeros(0, bool), first)
    w, c, l = np.maximum(n_words, 1), np.maximum(chars, 1), np.maximum(n_lines, 1)
    return base, np.stack([
        np.log1p(n_words), chars / w, count["symbol"] / w, n_dup / l, n_repeat / w, count["upper"] / c,
        count["digit"] / c, count["mark"] / c, short / w, distinct / w, n_words / l, ends / w], axis=1)


@dataclass
class Trees:
    """All trees in one set of node arrays; a leaf is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def raw_score(self, x: np.ndarray) -> np.ndarray:
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            node = np.where(x[rows, self.feature[node]] <= self.threshold[node],
                            self.left[node], self.right[node])
        return self.base + self.value[node].sum(axis=1)


def train(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosting on the logistic loss over quantile bins."""
    n, d = x.shape
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(d)]
    bins = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    rate = y.mean()
    base = float(np.log(rate / (1 - rate)))
    score = np.full(n, base)
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots = []

    def leaf(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(-g / (h + RIDGE), low, high))

    def grow(rows: np.ndarray, depth: int, low: float, high: float) -> int:
        me = len(nodes)
        g, h = grad[rows], hess[rows]
        value = leaf(g.sum(), h.sum(), low, high)
        nodes.append([0, np.inf, me, me, value * RATE])
        best = (1e-6, None)
        if depth < DEPTH and len(rows) >= 2 * LEAST_LEAF:
            whole = g.sum() ** 2 / (h.sum() + RIDGE)
            for f in range(d):
                k = len(cuts[f]) + 1
                if k < 2:
                    continue
                gs = np.cumsum(np.bincount(bins[rows, f], weights=g, minlength=k))
                hs = np.cumsum(np.bincount(bins[rows, f], weights=h, minlength=k))
                ns = np.cumsum(np.bincount(bins[rows, f], minlength=k))
                gl, hl, nl = gs[:-1], hs[:-1], ns[:-1]
                gr, hr, nr = gs[-1] - gl, hs[-1] - hl, ns[-1] - nl
                vl, vr = -gl / (hl + RIDGE), -gr / (hr + RIDGE)
                gain = gl ** 2 / (hl + RIDGE) + gr ** 2 / (hr + RIDGE) - whole
                gain[(nl < LEAST_LEAF) | (nr < LEAST_LEAF)
                     | (_SIGN[f] * (np.clip(vr, low, high) - np.clip(vl, low, high)) < 0)] = -1
                at = int(gain.argmax())
                if gain[at] > best[0]:
                    best = (gain[at], (f, at, vl[at], vr[at]))
        if best[1] is None:
            leaves.append((rows, value))
            return me
        f, at, vl, vr = best[1]
        middle = float(np.clip((np.clip(vl, low, high) + np.clip(vr, low, high)) / 2, low, high))
        lower, upper = ((low, middle), (middle, high)) if _SIGN[f] >= 0 else ((middle, high), (low, middle))
        if _SIGN[f] == 0:
            lower = upper = (low, high)
        goes_left = bins[rows, f] <= at
        a = grow(rows[goes_left], depth + 1, *lower)
        b = grow(rows[~goes_left], depth + 1, *upper)
        nodes[me] = [f, cuts[f][at], a, b, 0.0]
        return me

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        grad, hess = p - y, p * (1 - p)
        leaves: list[tuple[np.ndarray, float]] = []
        roots.append(grow(np.arange(n), 0, -np.inf, np.inf))
        for rows, value in leaves:
            score[rows] += RATE * value
    f, t, a, b, v = map(np.array, zip(*nodes))
    return Trees(f.astype(int), t.astype(float), a.astype(int), b.astype(int), v.astype(float),
                 np.array(roots), base)


def _measured(batches):
    for batch in batches:
        for part in B.slices(batch, "text"):
            _, x = statistics(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("label"), pa.ListArray.from_arrays(
                    pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]),
                    pa.array(x.reshape(-1)))], ["label", "x"])


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Trees | None:
    """Fit on at most ``sample_docs`` labelled rows; None when they lack a class."""
    marks = (named_rows(labels, doc_id="long", quality="int").dropna()
             .groupBy("doc_id").agg(F.min("quality").alias("label")))
    total = marks.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 40)) / float(1 << 40)
    got = (named_rows(docs, doc_id="long", text="string")
           .join(marks.filter(draw < min(1.0, sample_docs / max(1, total))), "doc_id")
           .select("label", "text").mapInArrow(_measured, "label int, x array<double>")
           .limit(sample_docs + sample_docs // 20).toArrow())
    y = np.array(got.column("label").to_pylist(), float)
    if not 0 < y.sum() < len(y):
        return None
    x = np.array(got.column("x").to_pylist())
    order = np.lexsort((y, *x.T))  # not the order of arrival
    return train(x[order], y[order])


def judge(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """(doc_id, base statistics, base_failed, kept, score) of every row."""
    def run(batches):
        for batch in batches:
            for part in B.slices(batch, "text"):
                base, x = statistics(part.column("text"))
                failed = (base[:, 0] < LEAST_WORDS) | (100 * base[:, 4] > MOST_REPEATED * base[:, 0])
                score = (np.ones(len(x)) if trees is None
                         else 1 / (1 + np.exp(-np.clip(trees.raw_score(x), -700, 700))))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c) for c in base.T.copy()),
                     pa.array(failed), pa.array(~failed & (score >= 0.5)), pa.array(score)],
                    ["doc_id", *BASE, "base_failed", "kept", "score"])

    return named_rows(docs, doc_id="long", text="string").mapInArrow(
        run, "doc_id long, " + ", ".join(f"{c} long" for c in BASE)
             + ", base_failed boolean, kept boolean, score double")


def op7_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, fit(docs, labels))
