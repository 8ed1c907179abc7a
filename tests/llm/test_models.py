"""Language, toxicity and quality: held-out accuracy, brute-force statistics, odd rows."""

import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from odd_rows import ROWS
from tokloom.llm import lang_id as L, quality_gbt as Q, queries, toxicity_fm as T
from tokloom.llm.common import table

SF = "/root/testdata/sf0.01"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- language

def test_language_held_out(spark):
    out = queries.QUERIES["op6_language_id"](spark, SF)
    both = out.join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").toPandas()
    held = both[both.held_out]
    assert len(both) == 1000
    assert set(held.doc_id) == {i for i in both.doc_id if zlib.crc32(str(i).encode()) % 3 == 1}
    assert (held.lang == held.lang_pred).mean() > 0.98 and both.score.between(0, 1).all()


def test_language_ignores_what_it_must(spark):
    docs = table(spark, SF, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    other = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang"))).withColumn(
        "source", F.lit(None).cast("string"))
    assert rows_of(L.op6_language_id(docs)) == rows_of(L.op6_language_id(other))


def test_language_odd_rows(spark, odd_docs, no_docs):
    out = rows_of(L.op6_language_id(odd_docs))
    assert len(out) == len(ROWS)
    for doc, held, lang, score in out:
        assert held == (doc is not None and zlib.crc32(str(doc).encode()) % 3 == 1) and 0 <= score <= 1
    und = Counter(r[0] for r in out if r[2] == "und")
    assert und == Counter([5, 6, 7, 11, None])
    assert L.op6_language_id(no_docs).count() == 0
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r[2:] for r in rows_of(L.op6_language_id(unlabelled))} == {("und", 0.0)}
    kept = L.keep_known(odd_docs, L.fit(odd_docs, L.learnable_rows()))
    assert kept.columns == odd_docs.columns and kept.count() == len(ROWS) - 5


def test_one_language_and_lonely_families(spark):
    rows = [(i, f"palabra{i} casa mesa perro", "es") for i in range(20)]
    assert {r[2] for r in rows_of(L.op6_language_id(
        spark.createDataFrame(rows, "doc_id long, text string, lang string")))} == {"es"}
    rows += [(100 + i, "слово дом стол собака", "ru") for i in range(20)] + [(200 + i, "語 家 机 犬", "ja") for i in range(20)]
    out = rows_of(L.op6_language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    assert all(r[2] == ("es" if r[0] < 100 else "ru" if r[0] < 200 else "ja") for r in out)


def test_prediction_by_brute_force():
    """Shares of byte n-grams, margins, family, votes: a step at a time, on random separators."""
    import math
    import random
    import re

    rng, rnd = np.random.default_rng(8), random.Random(8)
    langs = {"germanic": ["de", "en", "nl"], "romance": ["es", "fr"], "xx": ["xx"]}
    pairs = [(a, b) for names in langs.values() for i, a in enumerate(names) for b in names[i + 1:]]
    rows = len(langs) + len(pairs)
    model = L.Model(list(langs), langs, rng.normal(size=(rows, L.BUCKETS)) * 30, rng.normal(size=rows),
                    rng.uniform(0.5, 3, rows), pairs)

    def slow(text):
        if not re.search(r"[^\W\d_]", text or ""):
            return "und", 0.0
        raw = [32 if x < 65 or 91 <= x < 97 or 123 <= x < 128 else x + 32 if 65 <= x < 91 else x for x in text.encode()]
        seen = {}
        for width in (2, 3, 4):
            for i in range(len(raw) - width + 1):
                code = int.from_bytes(bytes(raw[i:i + width]), "big")
                slot = ((code + width) * 0x9E3779B1 % 2**32) >> 19
                seen[slot] = seen.get(slot, 0) + 1
        total = sum(seen.values())
        sure = []
        for w, b, s in zip(model.weights, model.bias, model.slope):
            m = b + sum(w[k] * n for k, n in seen.items()) / max(1, total)
            sure.append(1 / (1 + math.exp(-min(30, max(-30, m * s)))))
        family = max(range(3), key=lambda f: (sure[f], -f))
        names = langs[model.families[family]]
        vote = dict.fromkeys(names, 0.0)
        for (a, b), p in zip(pairs, sure[3:]):
            if a in vote:
                vote[a] += p
                vote[b] += 1 - p
        best = max(names, key=lambda v: (vote[v], -names.index(v)))
        return best, sure[family] * (vote[best] / (len(names) - 1) if len(names) > 1 else 1)

    texts = ["", None, "1 2 !", "a", "Straße É", "x" * 500] + [
        "".join(rnd.choices("abc DEF éß日. 12", k=rnd.randrange(1, 80))) for _ in range(300)]
    got, score = L.classify(pa.array(texts, pa.large_string()), model)
    want = [slow(t) for t in texts]
    assert got == [w for w, _ in want]
    assert np.allclose(score, [s for _, s in want], rtol=1e-9)


def test_the_most_frequent_languages_are_learned(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_LANGS", 2)
    rows = [(i, "слово дом стол собака", "ru") for i in range(30)] + [(40 + i, "語 家 机 犬", "ja") for i in range(30)]
    rows += [(90 + i, "the house and the dog", f"dirty {i}") for i in range(9)]
    out = rows_of(L.op6_language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    assert {r[2] for r in out} <= {"ru", "ja", "und"} and {r[2] for r in out if r[0] < 30} == {"ru"}


# --- toxicity

def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    out = queries.QUERIES["op5_toxicity"](spark, sf)
    both = out.join(table(spark, sf, "labels"), "doc_id").toPandas()
    held = both[both.held_out]
    assert set(held.doc_id) == {i for i in both.doc_id if zlib.crc32(str(i).encode()) % 5 == 0}
    assert ((held.predicted == 1) == (held.score >= 0.5)).all() and both.score.between(0, 1).all()
    toxic = held[held.toxic == 1]
    assert toxic.predicted.mean() > 0.8 and held[held.toxic == 0].predicted.mean() < 0.01


def test_toxicity_does_not_see_held_out_labels(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert rows_of(T.op5_toxicity(docs, labels)) == rows_of(T.op5_toxicity(docs, flipped))


def test_pairs_count_beyond_their_words():
    """Neither word is toxic alone; both together are."""
    rng = np.random.default_rng(0)
    texts, y = [], []
    for i in range(1200):
        a, b = rng.random(2) < 0.5
        texts.append(" ".join((["insulting"] if a else []) + (["groupname"] if b else [])
                              + [f"filler{rng.integers(50)}" for _ in range(10)]))
        y.append(float(a and b))
    doc, h = T.hashed_terms(pa.array(texts))
    m = T.train(doc, h, np.array(y), np.ones(len(y)))
    s = T.score_texts(pa.array(["insulting filler1", "groupname filler1", "insulting groupname filler1", ""]), m)
    assert s[2] > 0.5 > max(s[0], s[1], s[3])


def test_machine_by_brute_force():
    rng = np.random.default_rng(1)
    w, v = rng.normal(size=9), rng.normal(size=(9, 3))
    sets = [[0, 3, 8], [], [5], list(range(9))]
    term = np.array([t for s in sets for t in s])
    ends = np.cumsum([0, *map(len, sets)])
    slow = [0.3 + sum(w[i] for i in s) + sum(v[i] @ v[j] for k, i in enumerate(s) for j in s[k + 1:])
            for s in sets]
    assert np.allclose(T.raw_scores(0.3, w, v, term, ends), slow)


def test_toxicity_odd_rows(spark, odd_docs, no_docs, few_labels):
    out = rows_of(T.op5_toxicity(odd_docs, few_labels))
    assert len(out) == len(ROWS) and all(0 <= r[2] <= 1 for r in out)
    empty = {r[2] for r in out if r[0] in (5, 6, 7)}
    assert len(empty) == 1
    assert T.op5_toxicity(no_docs, few_labels).count() == 0
    assert {r[2] for r in rows_of(T.op5_toxicity(odd_docs, few_labels.limit(0)))} == {0.0}


# --- quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {k + d for k in range(len(w) - 2) for d in range(3) if windows[(w[k], w[k + 1], w[k + 2])] > 1}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered))


@pytest.mark.parametrize("seed", range(3))
def test_statistics_by_brute_force(seed):
    rng = np.random.default_rng(seed)
    texts = ["".join(rng.choice(list("ab é#|\n\n\t \r"), rng.integers(0, 80))) for _ in range(400)]
    texts += [None, "", "a\na\na", "a b c a b c", "x x x x", " \n \n", "a\r\na\r\n", "a a\n a a"]
    got, _ = Q.statistics(pa.array(texts, pa.string()))
    assert [tuple(r) for r in got] == [base(t) for t in texts]


def test_quality_held_out_and_monotonic():
    import pyarrow.parquet as pq

    docs = pq.read_table(f"{SF}/documents.parquet").to_pandas().merge(
        pq.read_table(f"{SF}/labels.parquet").to_pandas(), on="doc_id")
    _, x = Q.statistics(pa.array(docs.text.tolist()))
    y = docs.quality.to_numpy(float)
    held = docs.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 0).to_numpy()
    trees = Q.train(x[~held], y[~held])
    assert ((trees.raw_score(x[held]) >= 0) == y[held]).mean() > 0.95
    rng = np.random.default_rng(4)
    for f, sign in Q.MONOTONE.items():
        k = Q.FEATURES.index(f)
        more = x.copy()
        more[:, k] += rng.random(len(x)) * rng.choice([0.01, 0.1, 2], len(x))
        assert (sign * (trees.raw_score(more) - trees.raw_score(x)) >= -1e-9).all()


def test_quality_rows(spark, odd_docs, no_docs, few_labels):
    out = Q.op7_quality(odd_docs, few_labels)
    assert out.columns[:8] == ["doc_id", *Q.BASE, "base_failed", "kept"]
    wanted = []
    for r in ROWS:
        b = base(r[1])
        wanted.append((r[0], *b, b[0] < 50 or 100 * b[4] > 50 * b[0]))
    assert sorted((tuple(r)[:7] for r in out.collect()), key=str) == sorted(wanted, key=str)
    assert out.filter("base_failed and kept").count() == 0
    assert Q.op7_quality(no_docs, few_labels).count() == 0
    rules = Q.op7_quality(odd_docs, few_labels.limit(0))
    assert rules.filter("kept = base_failed").count() == 0


def test_rows_are_put_in_order_without_a_copy_of_the_matrix():
    rng = np.random.default_rng(1)
    x, order = rng.random((2000, L.BUCKETS), np.float32), rng.permutation(2000)
    expected, sizes = x[order], (x[order] ** 2).sum(1)
    tracemalloc.start()
    got = L._in_order(x, order)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(x, expected) and np.array_equal(got, sizes)
    assert most < x.nbytes / 3
