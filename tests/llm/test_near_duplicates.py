"""b-bit MinHash against brute force on sets of shingles."""

import random
import re

import numpy as np
import pyarrow as pa

from odd_rows import ROWS
from tokloom.llm import bbit_minhash as M, bytetext as B
from tokloom.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = WORD.findall(low)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(rows, percent=85):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for k, (i, s) in enumerate(sets):
        for j, t in sets[k + 1:]:
            if i is not None and j is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    out = []
    for i, s in sets:
        c = i if i is None or not s else find(i)
        out.append((i, len(s), c, True if i is None else i == c))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_odd_rows(odd_docs, no_docs):
    expected = brute([(r[0], r[1]) for r in ROWS])
    assert got(M.near_duplicates(odd_docs)) == expected
    assert got(M.near_duplicates(no_docs)) == []


def test_groups_of_edited_copies(spark):
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(6):
        base = rnd.choices(vocabulary, k=120)
        for k in range(25):
            text = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 2, 3, 4, 8])):
                text[rnd.randrange(len(text))] = f"e{rnd.randrange(10**6)}"
            rows.append((len(rows) * 7 % 151, " ".join(text)))
    rows += [(1000 + i, " ".join(rnd.choices(vocabulary, k=80))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(M.near_duplicates(df)) == brute(rows)


def test_keep_one_row_of_each_group(odd_docs, no_docs):
    kept = M.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    # 2 copies 1; 4 is near 3 by one of its texts; 9 is 8 in other case; rows without an id stay
    assert ids == sorted(map(str, [1, 3, 5, 6, 7, 8, 10, 11, -12, None, None]))
    assert M.keep_one(no_docs).count() == 0


def test_shared_passage_links_nobody(spark):
    passage = " ".join(f"shared{i}" for i in range(60))
    rows = [(i, " ".join(f"own{i}x{k}" for k in range(40)) + " " + passage) for i in range(300)]
    out = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert out.filter("not kept").count() == 0


def test_estimate_follows_the_similarity():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.85, 0.95):
        n = 2000
        common = rng.integers(0, 2**63, int(n * share), dtype=np.uint64)
        sets = [np.concatenate([common, rng.integers(0, 2**63, n - len(common), dtype=np.uint64)])
                for _ in range(2)]
        j = len(common) / (2 * n - len(common))
        a, b = (M.packed(M.minima(s)[None, :])[0].view(np.uint64) for s in sets)
        off = sum(bin(int((a[k] ^ b[k]) | (a[k + M.PLANE] ^ b[k + M.PLANE]))).count("1")
                  for k in range(M.PLANE))
        assert abs((1 - off / M.HASHES - 0.25) / 0.75 - j) < 0.1


def test_bits_of_short_texts_are_drawn_anew_by_each_function():
    """No pair of six of seven common shingles (0.857) is lost by the bit counts."""
    rng = np.random.default_rng(2)
    n, limit = 30_000, M.most_mismatches(85)
    sets = rng.integers(0, 2**63, (n, 7), dtype=np.uint64)
    sides = [M.packed(np.stack([M.minima(s) for s in part])).view(np.uint64) for part in (sets[:, :6], sets)]
    x = sides[0] ^ sides[1]
    off = np.bitwise_count(x[:, :M.PLANE] | x[:, M.PLANE:]).sum(axis=1)
    assert (off > limit).sum() == 0


def test_pairs_with_band_keys_alike_in_their_upper_bits(spark):
    """Band 0 differs in its low bits only; the pair is taken in band 1."""
    sig, bands = [0] * (2 * M.PLANE), [[(1 << 40) + i, 7] for i in range(2)]
    reps = spark.createDataFrame([(i, sig, 1, bands[i]) for i in range(2)],
                                 "rep long, sig array<long>, n_shingles long, bands array<long>")
    rows = spark.createDataFrame([(no, bands[i][no], i, i) for i in range(2) for no in range(2)],
                                 "no int, band long, rep long, g_rep long")
    texts = spark.createDataFrame([(0, "a b"), (1, "a b")], "doc_id long, text string")
    alike = M.mismatches("sig_a", "sig_b") <= 0
    assert [r[:2] for r in got(M._apart(rows, reps, texts, alike, 85))] == [(1, 0)]


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (7, 300)]
    out = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert {out[i] for i in range(41)} == {0} and out[300] == 0
    assert {out[100 + i] for i in range(30)} == {100} and 200 not in out


def test_word_hashes_by_brute_force():
    texts = ["a b  c\td", None, "", "ä ö\nü", " x ", "A a", "b\x0bc\x0cd\re"]
    raw, begin, end, h, first = B.words(pa.array(texts))
    words = [WORD.findall((t or "").lower()) for t in texts]
    assert np.diff(first).tolist() == list(map(len, words))
    flat = [w for ws in words for w in ws]
    assert [bytes(raw[a:b]).decode() for a, b in zip(begin, end)] == flat
    assert len(set(h.tolist())) == len(set(flat))
    assert len({(w, x) for w, x in zip(flat, h.tolist())}) == len(set(flat))
