"""Hierarchical language identification.

The family of a language is predicted first (one linear SVM per family against the
rest); inside the winning family, one-versus-one linear SVMs separate the closely related
languages. Features are hashed byte 2-, 3- and 4-grams of the lower-cased whole text, divided by
their number, so a score is the mean of one weight per n-gram and a batch is scored with numpy passes.

Edge cases: a null text, or one without any letter, is ``und`` with score 0. Rows with a null or
repeated id are predicted like any other, row by row. Without a single learnable row, everything is
``und``. A language that is alone in its family gets that family's probability. Equal votes go to the
language that sorts first. Extra columns are never read.

The score is the family's probability against the rest times the mean vote for the language against each of
its relatives. Neither shrinks with the number of families or languages, so one bound serves any corpus.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tokloom.llm import bytetext as B
from tokloom.llm.common import crc32_of_id, named_rows

#: Families of common languages; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es pt it ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk tt",
    "indic": "hi bn mr ne gu pa ur",
    "semitic": "ar he mt am",
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs.split()}

BUCKETS = 1 << 13
NGRAMS = (2, 3, 4)
SAMPLE_DOCS = 3000
MAX_LANGS = 500
UNKNOWN = "und"

_FOLD = B.LOWER.copy()
_FOLD[:65] = 0x20
_FOLD[91:97] = 0x20
_FOLD[123:128] = 0x20
_MUL = np.uint32(0x9E3779B1)


@dataclass
class Model:
    """``weights`` has a row per linear separator and one column per bucket; a bias follows."""

    families: list[str] = field(default_factory=list)
    langs: dict[str, list[str]] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, BUCKETS)))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))
    slope: np.ndarray = field(default_factory=lambda: np.zeros(0))
    pairs: list[tuple[str, str]] = field(default_factory=list)


def _buckets(raw: np.ndarray, starts: np.ndarray):
    """For each n-gram width: bucket of every position, and per text the first and past-last position."""
    b = _FOLD[raw].astype(np.uint32)
    code = b.copy()
    for width in range(2, max(NGRAMS) + 1):
        if len(b) < width:
            break
        code = (code[:-1] << np.uint32(8)) | b[width - 1:]
        if width in NGRAMS:
            slot = ((code + np.uint32(width)) * _MUL) >> np.uint32(32 - 13)
            lo = np.minimum(starts[:-1], len(slot))
            yield slot, lo, np.maximum(np.minimum(starts[1:] - width + 1, len(slot)), lo)


def _shares(text: pa.Array):
    """For each text in turn: the share of its n-grams that fall in each bucket."""
    raw, starts = B.flat(text)
    grams = list(_buckets(raw, starts))
    for i in range(len(text)):
        n = np.zeros(BUCKETS)
        for slot, lo, hi in grams:
            n += np.bincount(slot[lo[i]:hi[i]], minlength=BUCKETS)
        yield n / max(1.0, n.sum())


def margins(text: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Mean weight of the n-grams of each text, per separator (texts x separators)."""
    out = np.zeros((len(text), len(weights)))
    for i, share in enumerate(_shares(text)):
        out[i] = weights @ share
    return out


def _counts(batches):
    """Sparse bucket shares of each text, for fitting."""
    for batch in batches:
        for part in B.slices(batch, "text"):
            rows = [(np.flatnonzero(s).astype(np.int32), s[s > 0].astype(np.float32))
                    for s in _shares(part.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [part.column("lang"), pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                 pa.array([r[1] for r in rows], pa.list_(pa.float32()))], ["lang", "at", "share"])


def _svm(x: np.ndarray, y: np.ndarray, steps: int = 120, decay: float = 1e-4
         ) -> tuple[np.ndarray, float, float]:
    """Squared-hinge linear SVM by accelerated gradient descent; classes weigh the same.

    Returns weights, bias and the slope of the logistic curve that maps a margin to a probability.
    """
    n, d = x.shape
    y = y.astype(np.float32)  # all in 32 bits: a mixed product would copy the matrix each time
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()),
                      0.5 / max(1, (y < 0).sum())).astype(np.float32)
    v = np.full(d + 1, 1 / np.sqrt(d + 1), np.float32)
    for _ in range(8):
        u = x @ v[:d] + v[d]
        v = np.append(x.T @ (weight * u), (weight * u).sum())
        size = max(float(np.linalg.norm(v)), 1e-12)
        v /= np.float32(size)
    step, decay = np.float32(1.0 / (2.2 * size + decay)), np.float32(decay)
    w, last = np.zeros(d + 1, np.float32), np.zeros(d + 1, np.float32)
    for t in range(steps):
        z = w + np.float32(t / (t + 3)) * (w - last)
        gap = np.maximum(0, 1 - y * (x @ z[:d] + z[d])) * weight * y
        last, w = w, z + step * (2 * np.append(x.T @ gap, gap.sum()) - decay * np.append(z[:d], np.float32(0)))
    m, slope = (x @ w[:d] + w[d]).astype(float), 3.0
    for _ in range(25):  # one-dimensional logistic fit
        p = 1 / (1 + np.exp(-np.clip(slope * m, -30, 30)))
        g = (weight * m * ((y > 0) - p)).sum() - 0.002 * slope
        slope += g / ((weight * m * m * p * (1 - p)).sum() + 0.002)
    return w[:d].astype(float), float(w[d]), float(np.clip(slope, 0.5, 20))


def _in_order(x: np.ndarray, order: np.ndarray, some: int = 256) -> np.ndarray:
    """Put the rows of a matrix in order, without a copy of it; the squared size of each row."""
    for at in range(0, x.shape[1], some):
        x[:, at:at + some] = x[order, at:at + some]
    return np.concatenate([(x[at:at + some] ** 2).sum(1) for at in range(0, max(1, len(x)), some)])


def fit(docs: DataFrame, learnable, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit on about ``sample_docs`` rows (the documented bound of the sample), spread evenly over languages.

    ``learnable`` is the condition on (doc_id, text, lang) of rows that may be learned from. The sample
    takes the rows whose seeded hash of id and text is below their language's share, so it doesn't depend on
    partitioning. Of more than ``MAX_LANGS`` values of lang the most frequent are learned (of equals the first).
    """
    rows = named_rows(docs, doc_id="long", text="string", lang="string").filter(
        learnable & F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n"))
              .orderBy(F.desc("n"), "lang").limit(MAX_LANGS).collect()}
    if not counts:
        return Model()
    each = sample_docs / len(counts)
    chance = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, each / n))])
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(11)), F.lit(1 << 40)) / float(1 << 40)
    got = (rows.filter(draw < chance[F.col("lang")])
           .mapInArrow(_counts, "lang string, at array<int>, share array<float>")
           .limit(2 * sample_docs + 100).toArrow())
    langs = np.array(got.column("lang").to_pylist(), object)
    x = np.zeros((len(langs), BUCKETS), np.float32)
    for i, (at, share) in enumerate(zip(got.column("at"), got.column("share"))):
        x[i, at.values.to_numpy()] = share.values.to_numpy()
    del got
    order = np.lexsort((x @ np.arange(BUCKETS, dtype=np.float32), langs.astype(str)))
    langs = langs[order]
    scale = 1.0 / max(1e-9, float(np.sqrt(_in_order(x, order)).mean()))
    x *= np.float32(scale)
    family = np.array([FAMILY_OF.get(v, v) for v in langs], object)
    model = Model(sorted(set(family)), {f: sorted(set(langs[family == f])) for f in set(family)})
    found = []
    if len(model.families) > 1:
        found += [_svm(x, np.where(family == f, 1.0, -1.0)) for f in model.families]
    for f in model.families:
        for i, a in enumerate(model.langs[f]):
            for b in model.langs[f][i + 1:]:
                both = (langs == a) | (langs == b)
                found.append(_svm(x[both], np.where(langs[both] == a, 1.0, -1.0)))
                model.pairs.append((a, b))
    if found:
        model.weights = np.stack([w for w, _, _ in found]) * scale
        model.bias = np.array([b for _, b, _ in found])
        model.slope = np.array([s for _, _, s in found])
    return model


def classify(text: pa.Array, model: Model) -> tuple[list[str], np.ndarray]:
    """Predicted language and score of each text of an Arrow column."""
    n = len(text)
    has_letter = pc.fill_null(pc.match_substring_regex(text, r"\pL"), False).to_numpy(
        zero_copy_only=False)
    if not model.families:
        return [UNKNOWN] * n, np.zeros(n)
    m = margins(text, model.weights) + model.bias
    p = 1 / (1 + np.exp(-np.clip(m * model.slope, -30, 30)))
    k = len(model.families) if len(model.families) > 1 else 0
    of_family = p[:, :k] if k else np.ones((n, 1))
    best = of_family.argmax(1)
    lang, score = np.full(n, UNKNOWN, object), np.zeros(n)
    for f, name in enumerate(model.families):
        here = np.flatnonzero((best == f) & has_letter)
        names = model.langs[name]
        vote = np.zeros((len(here), len(names)))
        for j, (a, b) in enumerate(model.pairs):
            if a in names and b in names:
                vote[:, names.index(a)] += p[here, k + j]
                vote[:, names.index(b)] += 1 - p[here, k + j]
        share = vote / (len(names) - 1) if len(names) > 1 else np.ones((len(here), 1))
        win = share.argmax(1)
        lang[here] = np.array(names, object)[win]
        score[here] = of_family[here, f] * share[np.arange(len(here)), win]
    return lang.tolist(), score


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every row, from its whole text."""
    def run(batches):
        for batch in batches:
            for part in B.slices(batch, "text"):
                lang, score = classify(part.column("text"), model)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                    ["doc_id", "lang_pred", "score"])

    return named_rows(docs, doc_id="long", text="string").mapInArrow(
        run, "doc_id long, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model, least_score: float = 0.0) -> DataFrame:
    """Rows, with all their columns, whose language is known with more than ``least_score``."""
    def run(batches):
        for batch in batches:
            for part in B.slices(batch, "text"):
                lang, score = classify(part.column("text").cast(pa.string()), model)
                keep = (np.array(lang, object) != UNKNOWN) & (score > least_score)
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def learnable_rows():
    """Rows to learn from: the crc32 of the id's text, modulo 3, is not 1 (null ids may be learned)."""
    return F.coalesce(crc32_of_id() % 3 != 1, F.lit(True))


def op6_language_id(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): see the module; a null id is never held out."""
    model = fit(docs, learnable_rows())
    return predict(docs, model).select(
        "doc_id", F.coalesce(crc32_of_id() % 3 == 1, F.lit(False)).alias("held_out"),
        "lang_pred", "score")
