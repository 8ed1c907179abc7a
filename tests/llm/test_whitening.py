"""Whitening by contour integration against numpy's own eigenvectors and exact integers."""

import numpy as np
import pytest
from pyspark.sql import types as T

from tokloom.llm import feast_whiten as W
from tokloom.llm.common import table


def random_covariance(rows, dim, seed):
    a = np.random.default_rng(seed).normal(size=(rows, dim))
    return a.T @ a / rows


CASES = {
    "full": random_covariance(500, 64, 0), "low rank": random_covariance(10, 64, 1), "small": random_covariance(50, 3, 2),
    "one": np.array([[2.0]]), "ties": np.diag([5.0] * 20 + [3.0] * 10 + [1.0] * 10), "identity": np.eye(30) * 3,
    "near ties": np.diag([2.0, 2.0 - 1e-9, 2.0 - 2e-9, *np.linspace(0.1, 1, 37)]),
    "falling": np.diag(10.0 ** -np.arange(40.0)),
}


@pytest.mark.parametrize("name", CASES)
def test_leading_components(name):
    v = CASES[name]
    value, vector = W.leading(v)
    want = np.linalg.eigvalsh(v)[::-1][:16]
    want = want[want > 1e-12 * want[0]]
    assert np.allclose(value, want, rtol=1e-12, atol=1e-14 * want[0])
    assert np.abs(vector.T @ vector - np.eye(len(value))).max() < 1e-12
    assert np.abs(v @ vector - vector * value).max() < 1e-11 * want[0]


def test_inertia_counts():
    v = random_covariance(80, 40, 3)
    value, inertia = np.linalg.eigvalsh(v), W.Inertia(v)
    for place in [*np.linspace(-1, value[-1] + 1, 57), *((value[1:] + value[:-1]) / 2)]:
        assert inertia.above(place) == (value > place).sum()


def test_too_small_a_subspace_is_noticed():
    v = random_covariance(300, 40, 4)
    low = (lambda e: (e[-9] + e[-8]) / 2)(np.linalg.eigvalsh(v))
    top = W.Inertia(v).top
    assert W._one_interval(v, low, top, 8, 4) is None
    assert W._one_interval(v, low, top, 8, 20).shape == (40, 8)


def by_hand(rows):
    """{position in rows: [(component, n, deviation, |whitened|, explained)]}"""
    fine = [i for i, (_, v) in enumerate(rows)
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in rows[i][1]] for i in fine])
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    off = (n * x - total).astype(float) / n
    centred = (n * fit - total).astype(float) / n
    value, vector = np.linalg.eigh(centred.T @ centred / n)
    value, vector = value[::-1][:16], vector[:, ::-1][:, :16]
    white = off @ vector / np.sqrt(value)
    exact = ((n * x - total) ** 2).sum(axis=1)
    return {i: [(k + 1, n, int(exact[p]), abs(white[p, k]), value[k] / (centred ** 2).sum() * n)
                for k in range(len(value))] for p, i in enumerate(fine)}


def check(rows, got):
    want = by_hand(rows)
    assert len(got) == sum(map(len, want.values()))
    key = lambda r: (str(r[0]), r[1], r[2], r[3], round(r[4], 6))
    got_rows = sorted(((r["vec_id"], r["component"], r["n"], r["deviation"], abs(r["whitened"]), r["explained"])
                       for r in got), key=key)
    want_rows = sorted(((rows[i][0], *w) for i, each in want.items() for w in each), key=key)
    for g, w in zip(got_rows, want_rows):
        assert g[:4] == w[:4] and g[4:] == pytest.approx(w[4:], rel=1e-8, abs=1e-8)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_whole_table(spark, sf_small):
    vectors = table(spark, sf_small, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    check(rows, W.whiten(spark, vectors).collect())


KIND = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                     *[T.StructField(c, T.StringType()) for c in ("key", "dim", "n", "component", "i", "v")]])


def frame(spark, rows):
    return spark.createDataFrame([(*r, *"abcdef") for r in rows], KIND).repartition(3)


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.normal(size=5)]) for i in range(40)]
    rows += [rows[0], rows[0], (None, rows[1][1]), (None, None), (7, None), (100, [None] + [1.0] * 4),
             (101, [float("nan")] + [1.0] * 4), (102, [float("-inf")] + [1.0] * 4), (103, [1.0] * 3), (104, [])]
    got = W.whiten(spark, frame(spark, rows)).collect()
    check([r for r in rows if r[0] not in (103, 104)], got)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(k, [1.0, 2.0]) for k in range(9)]])
def test_nothing_to_whiten(spark, rows):
    assert W.whiten(spark, frame(spark, rows)).collect() == []


def test_huge_entries_are_held(spark):
    rows = [(k, [float(np.float32(3e38)) if k == 0 else float(k), float(k % 3)]) for k in range(12)]
    got = W.whiten(spark, frame(spark, rows)).collect()
    assert {r["vec_id"] for r in got if r["deviation"] is None} == {r[0] for r in rows}
    assert all(np.isfinite(r["whitened"]) for r in got)
