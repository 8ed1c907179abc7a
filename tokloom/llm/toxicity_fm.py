"""Toxicity by a factorization machine over hashed terms.

A text is a set of hashed terms: its lower-cased letter runs, their beginnings (a stem may have
many endings), and either again when it occurs often. The score is the logistic of a bias, a weight per
term, and for each two terms that occur together the product of their factor vectors, so a pair such as an
insult and the mention of a group counts beyond its two words; additive weights cannot say that. The pair sum
costs one pass: half of (sum of vectors)^2 - sum of squared vectors.

The model is fitted on the driver on at most ``SAMPLE_DOCS`` labelled rows (the documented bound): of each class the
half of them with the least seeded hash of the id, found by broadcasting their ids; of rows that repeat an id, one
text is learned. Terms are chosen by what they say of a class, not by a test that gets stricter as the sample
grows: a term counts that is in ``LEAST_DOCS`` texts and ``RATIO`` times likelier in one class than in the other,
and so do both parts of a pair that is as much likelier together, and ``BEYOND`` times more than its parts explain. Only counts
of terms and the sample's lists of such terms reach the driver; every document is scored on its whole text by
the executors.

Edge cases: null and empty texts have no term and score the bias. Rows with a null or repeated id are scored
row by row; labels with a null id or label are not learned, and of labels that repeat an id the
largest counts. If the learnable rows lack a class, or there are none, the score is the share of label 1
(0 without rows). Extra columns are never read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tokloom.llm import bytetext as B
from tokloom.llm.common import crc32_of_id, named_rows, stored

SAMPLE_DOCS = 6_000
BITS = 20
PREFIXES = (5, 6, 7, 8)
OFTEN = (2, 4)
TERMS = 4096
FACTORS = 8
LEAST_DOCS = 8
RATIO = 8.0
#: Pairs are sought among so many terms, likelier by at least this ratio and in this share of label 1; the best are taken.
PAIR_TERMS, PAIR_RATIO, PAIR_SHARE, PAIRS, BEYOND = 1000, 1.5, 0.01, 256, 4.0
STEPS = 150
SEED = 5

_LETTER = np.zeros(256, bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True


@dataclass
class Model:
    bias: float
    term_of: np.ndarray  # of each hash: the term's number, or -1
    weight: np.ndarray
    factors: np.ndarray


def hashed_terms(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text number, term hash), distinct and ascending: letter runs, their beginnings of PREFIXES
    bytes, and both again as terms of their own where they occur at least OFTEN times in the text."""
    raw, starts = B.flat(text)
    raw = B.LOWER[raw]
    capital = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)) + 1
    raw[capital] += 32  # À to Þ
    begin, end, first = B.runs(_LETTER[raw], starts)
    doc = np.repeat(np.arange(len(text)), np.diff(first))
    if not len(doc):
        return doc, doc
    hashed = B.RunHasher(raw)
    docs, hashes = [doc], [hashed(begin, end)]
    for k in PREFIXES:
        longer = end - begin > k
        docs.append(doc[longer])
        hashes.append(hashed(begin[longer], begin[longer] + k) ^ np.uint64(k << 40))
    h = (np.concatenate(hashes) >> np.uint64(64 - BITS)).astype(np.int64)
    both, n = np.unique(np.concatenate(docs) << BITS | h, return_counts=True)
    often = [((both[n >= k] & (1 << BITS) - 1) * 40503 + k) % (1 << BITS) | both[n >= k] >> BITS << BITS
             for k in OFTEN]
    both = np.unique(np.concatenate([both, *often]))
    return both >> BITS, both & (1 << BITS) - 1


def _terms_of(batches, keep: np.ndarray | None = None):
    """(text number in the part, hash, part) of the texts; only hashes that ``keep`` marks."""
    for batch in batches:
        for part in B.slices(batch, "text"):
            doc, h = hashed_terms(part.column("text"))
            if keep is not None:
                doc, h = doc[keep[h]], h[keep[h]]
            yield doc, h, part


def _term_counts(batches):
    """(term, n, hit): texts of this partition that hold the term, and those of label 1."""
    seen, hit = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
    for doc, h, part in _terms_of(batches):
        label = part.column("label").to_numpy()
        seen += np.bincount(h, minlength=1 << BITS)
        hit += np.bincount(h[label[doc] == 1], minlength=1 << BITS)
    term = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(term.astype(np.int32)), pa.array(seen[term]), pa.array(hit[term])],
                                     ["term", "n", "hit"])


def _term_lists(batches, keep: np.ndarray):
    for doc, h, part in _terms_of(batches, keep):
        ends = np.searchsorted(doc, np.arange(part.num_rows + 1))
        yield pa.RecordBatch.from_arrays(
            [part.column("label"), pa.ListArray.from_arrays(
                pa.array(ends.astype(np.int32)), pa.array(h.astype(np.int32)))], ["label", "terms"])


def _ratio(hit, miss, pos: float, neg: float):
    """How much likelier in texts of label 1 than of 0, as a smoothed ratio of shares."""
    return ((hit + 0.5) / (pos + 1)) / ((miss + 0.5) / (neg + 1))


def _best(score: np.ndarray, most: int) -> np.ndarray:
    """The places of the highest scores above 0, ascending; of equals the first."""
    best = np.lexsort((np.arange(len(score)), -score))[:most]
    return np.sort(best[score[best] > 0])


def _candidates(seen: np.ndarray, hit: np.ndarray, n: int, pos: float) -> tuple[np.ndarray, np.ndarray]:
    """Terms that count alone, the most telling ``TERMS``, and terms that may count in a pair."""
    neg = n - pos
    miss = seen - hit
    ratio = _ratio(hit, miss, pos, neg)
    part = ratio / (1 + ratio)
    # information about the class in a text, were both classes equally frequent
    gain = (hit / pos + miss / neg) * (part * np.log(2 * part) + (1 - part) * np.log(2 * (1 - part)))
    often = seen >= LEAST_DOCS
    alone = _best(np.where(often & (np.maximum(ratio, 1 / ratio) >= RATIO), gain, 0), TERMS)
    paired = often & (hit >= PAIR_SHARE * pos) & (ratio >= PAIR_RATIO) & (ratio < RATIO)
    return alone, _best(np.where(paired, gain, 0), PAIR_TERMS)


def _pair_terms(doc: np.ndarray, h: np.ndarray, y: np.ndarray, among: np.ndarray) -> np.ndarray:
    """The terms of the pairs that tell label 1 much better than their parts."""
    place = np.full(1 << BITS, -1, np.int32)
    place[among] = np.arange(len(among))
    keep = place[h] >= 0
    x = np.zeros((len(y), len(among)), np.float32)
    x[doc[keep], place[h[keep]]] = 1
    hit, miss = x[y > 0].T @ x[y > 0], x[y == 0].T @ x[y == 0]
    pos, neg = y.sum(), len(y) - y.sum()
    ratio = _ratio(hit, miss, pos, neg)
    single = np.diag(ratio)
    fit = ((hit + miss >= LEAST_DOCS) & (hit >= PAIR_SHARE * pos)
           & (ratio >= np.maximum(RATIO, BEYOND * single[:, None] * single)))
    score = np.where(np.triu(fit, 1), ratio * hit, 0).reshape(-1)
    best = _best(score, PAIRS)
    return among[np.unique(np.concatenate([best // len(among), best % len(among)]))] if len(best) else among[:0]


def _chosen(doc: np.ndarray, h: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Term number of each hash; the terms are those that tell the classes apart alone or in a pair."""
    seen = np.bincount(h, minlength=1 << BITS).astype(float)
    hit = np.bincount(h[(y > 0)[doc]], minlength=1 << BITS).astype(float)
    alone, paired = _candidates(seen, hit, len(y), y.sum())
    best = np.union1d(alone, _pair_terms(doc, h, y, paired))
    term_of = np.full(1 << BITS, -1, np.int32)
    term_of[best] = np.arange(len(best))
    return term_of


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of ``values`` in each [ends[i], ends[i + 1]), also when that is empty."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=float)])
    return total[ends[1:]] - total[ends[:-1]]


def raw_scores(bias, weight, factors, term: np.ndarray, ends: np.ndarray) -> np.ndarray:
    v = factors[term]
    pairs = (_sums(v, ends) ** 2 - _sums(v * v, ends)).sum(axis=1) / 2
    return bias + _sums(weight[term], ends) + pairs


def train(doc: np.ndarray, h: np.ndarray, y: np.ndarray, share: np.ndarray) -> Model:
    """Full-batch Adam on the logistic loss with weight decay; ``doc`` ascends, and ``share`` is the
    weight of each row, which makes up for the rate at which its class was drawn."""
    term_of = _chosen(doc, h, y)
    keep = term_of[h] >= 0
    doc, term = doc[keep], term_of[h[keep]].astype(np.int64)
    n, m = len(y), max(1, int(term_of.max()) + 1)
    ends = np.searchsorted(doc, np.arange(n + 1))
    by_term = np.argsort(term, kind="stable")
    term_ends = np.searchsorted(term[by_term], np.arange(m + 1))
    doc_by_term = doc[by_term]
    rng = np.random.default_rng(SEED)
    share = share / share.sum()
    rate = (y * share).sum()
    w = np.zeros((m, FACTORS + 1))
    w[:, 1:] = rng.normal(0, 0.02, (m, FACTORS))
    bias = float(np.log(rate / (1 - rate)))
    m1, m2 = np.zeros_like(w), np.zeros_like(w)
    b1 = b2 = 0.0
    decay = np.concatenate([[2e-4], np.full(FACTORS, 1e-3)])
    for t in range(1, STEPS + 1):
        v = w[term, 1:]
        s = _sums(v, ends)
        score = bias + _sums(w[term, 0], ends) + (s ** 2 - _sums(v * v, ends)).sum(axis=1) / 2
        gap = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - y) * share
        g = np.empty_like(w)
        of = gap[doc_by_term]
        g[:, 0] = _sums(of, term_ends)
        g[:, 1:] = _sums(of[:, None] * s[doc_by_term], term_ends) - w[:, 1:] * g[:, :1]
        g += decay * w
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        step = 0.1 if t < STEPS * 2 // 3 else 0.03
        w -= step * (m1 / (1 - 0.9 ** t)) / (np.sqrt(m2 / (1 - 0.99 ** t)) + 1e-6)
        gb = gap.sum()
        b1, b2 = 0.9 * b1 + 0.1 * gb, 0.99 * b2 + 0.01 * gb * gb
        bias -= step * (b1 / (1 - 0.9 ** t)) / (np.sqrt(b2 / (1 - 0.99 ** t)) + 1e-6)
    return Model(bias, term_of, w[:, 0].copy(), w[:, 1:].copy())


def _constant(rate: float) -> Model:
    bias = np.log(rate / (1 - rate)) if 0 < rate < 1 else np.inf if rate else -np.inf
    return Model(float(bias), np.full(1 << BITS, -1, np.int32), np.zeros(1), np.zeros((1, FACTORS)))


def _drawn(marks: DataFrame, sample_docs: int) -> list[tuple[int, int]]:
    """(doc_id, label) of at most half of ``sample_docs`` ids of each label, those with the least draw."""
    counts = {r["label"]: r["n"] for r in marks.groupBy("label").agg(F.count("*").alias("n")).collect()}
    half = sample_docs // 2
    # enough that fewer than half are drawn by chance never; the cut is exact
    chance = {k: min(1.0, (half + 8 * half ** 0.5 + 8) / n) for k, n in counts.items()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 40)) / float(1 << 40)
    rows = marks.withColumn("draw", draw).filter(F.col("draw") < F.when(
        F.col("label") == 1, chance.get(1, 0.0)).otherwise(chance.get(0, 0.0))).collect()
    rows.sort(key=lambda r: (r["draw"], r["doc_id"]))
    return [(r["doc_id"], k) for k in (0, 1) for r in [r for r in rows if r["label"] == k][:half]]


def fit(docs: DataFrame, labels: DataFrame, learnable, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit on at most ``sample_docs`` of the labelled rows that meet ``learnable`` (on doc_id)."""
    spark = docs.sparkSession
    marks = stored(named_rows(labels, doc_id="long", toxic="int").dropna().filter(learnable)
                   .groupBy("doc_id").agg(F.max("toxic").alias("label")).filter("label in (0, 1)"), "marks")
    drawn = spark.createDataFrame(_drawn(marks, sample_docs), "doc_id long, label int")
    sample = stored(named_rows(docs, doc_id="long", text="string").join(F.broadcast(drawn), "doc_id")
                    .groupBy("doc_id").agg(F.first("label").alias("label"),
                                           F.min_by("text", F.xxhash64("text")).alias("text"))
                    .select("label", "text"), "sample")
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n = sum(sizes.values())
    if len(sizes) < 2:
        return _constant(sizes.get(1, 0) / n if n else 0.0)
    counted = (sample.mapInArrow(_term_counts, "term int, n long, hit long").groupBy("term")
               .agg(F.sum("n").alias("n"), F.sum("hit").alias("hit")).filter(F.col("n") >= LEAST_DOCS).toArrow())
    seen, hit = np.zeros((2, 1 << BITS))
    term = counted.column("term").to_numpy()
    seen[term], hit[term] = counted.column("n").to_numpy(), counted.column("hit").to_numpy()
    keep = np.zeros(1 << BITS, bool)
    keep[np.concatenate(_candidates(seen, hit, n, sizes[1]))] = True
    kept = spark.sparkContext.broadcast(keep)
    got = sample.mapInArrow(lambda b: _term_lists(b, kept.value), "label int, terms array<int>").toArrow()
    got = got.combine_chunks()
    y = got.column("label").to_numpy().astype(float)
    lists = got.column("terms").combine_chunks()
    h = lists.values.to_numpy()
    size = np.diff(lists.offsets.to_numpy())
    # an order of its own, so the sums don't depend on the order of arrival
    starts = lists.offsets.to_numpy()[:-1]
    order = np.lexsort((y, [zlib.crc32(h[a:a + k].tobytes()) for a, k in zip(starts, size)]))
    h = np.concatenate([h[starts[i]:starts[i] + size[i]] for i in order])
    y = y[order]
    all_of = {r["label"]: r["n"] for r in marks.groupBy("label").agg(F.count("*").alias("n")).collect()}
    return train(np.repeat(np.arange(len(y), dtype=np.int32), size[order]), h, y,
                 np.where(y == 1, all_of[1] / sizes[1], all_of[0] / sizes[0]))


def score_texts(text: pa.Array, model: Model) -> np.ndarray:
    """Score (0 to 1) of each text of an Arrow column."""
    doc, h = hashed_terms(text)
    term = model.term_of[h]
    keep = term >= 0
    ends = np.searchsorted(doc[keep], np.arange(len(text) + 1))
    raw = raw_scores(model.bias, model.weight, model.factors, term[keep], ends)
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-raw))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of every row."""
    def run(batches):
        for batch in batches:
            for part in B.slices(batch, "text"):
                s = score_texts(part.column("text"), model)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                    ["doc_id", "score", "predicted"])

    return named_rows(docs, doc_id="long", text="string").mapInArrow(
        run, "doc_id long, score double, predicted int")


def op5_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted); held out: crc32 of the id's text modulo 5 is 0."""
    model = fit(docs, labels, crc32_of_id() % 5 != 0)
    return score(docs, model).select(
        "doc_id", F.coalesce(crc32_of_id() % 5 == 0, F.lit(False)).alias("held_out"),
        "score", "predicted")
