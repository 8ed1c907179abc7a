"""Tokens, best-fit packing and training order: exact round trips."""

import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from odd_rows import ROWS
from tokloom.llm import best_fit_pack as P, tokens, training_order as O
from tokloom.llm.common import shared_folder


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def whole(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def ids_of(texts, source):
    ids, starts = tokens.token_ids(pa.array(texts, pa.string()), source)
    return [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])]


STRANGE = ["", " ", None, "Don't stop; it's 3 o'clock\tand\n\nWE'LL go", "a<|endoftext|>b <|startoftext|>",
           "é́ café ́x", "tab\x0bvt\x0cff\x1cfs\x85nel nbsp em", "İstanbul ΣΑΣ ΑΣ Σ",
           "日本語 テスト １２３", "x" * 5000, "!!!???...", "🙂🙃 ‍", "a\r\nb"]


def test_words_give_the_ids_of_the_whole_text(tokenizer):
    source = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    rnd = random.Random(2)
    pool = "abcXYZéÉßΣσς'’.,!<|>0129 \t\n ́ \x1c日🙂"
    texts = STRANGE + ["".join(rnd.choices(pool, k=rnd.randrange(1, 60))) for _ in range(500)]
    assert ids_of(texts, source) == [whole(tokenizer, t) for t in texts]


def test_memo_bound_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_PARTS", 5)
    monkeypatch.setattr(tokens, "MEMO_WORDS", 4)
    source = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    texts = ["one two three", "four five six seven eight nine ten", "one two"]
    for _ in range(2):
        assert ids_of(texts, source) == [whole(tokenizer, t) for t in texts]


def words_of(n):
    rnd = random.Random(3)
    return list({"".join(rnd.choices("abcdefghijklmnoé", k=9)) for _ in range(n)})


def test_memo_takes_little_room(tokenizer):
    source = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    tokens._LOADED.clear()
    tokens.token_ids(pa.array(["one two"]), source)
    words = words_of(20_000)
    text = pa.array([" ".join(words)])
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    tokens.token_ids(text, source)
    held = tracemalloc.get_traced_memory()[0] - before
    tracemalloc.stop()
    tokens._LOADED.clear()
    assert held < 100 * len(words)  # a Python string and bytes for each take several times this


def test_words_of_letters_are_told_many_at_a_time(tokenizer):
    class Counting:
        asked = 0

        def get_vocab(self, **how):
            return tokenizer.get_vocab(**how)

        def encode_batch_fast(self, texts, **how):
            self.asked += len(texts)
            return tokenizer.encode_batch_fast(texts, **how)

    words, counting = words_of(3_000), Counting()
    ids, size = tokens.Memo(counting).encoded(words)
    assert counting.asked < 10
    each = np.split(ids, np.cumsum(size)[:-1])
    assert [e.tolist() for e in each] == [tokenizer.encode(w, add_special_tokens=False).ids for w in words]



def check_packing(rows, docs, tokenizer):
    """rows: (doc_id, piece, start, length, crc, sequence, offset)."""
    wanted = []
    for doc, text in docs:
        ids = np.array(whole(tokenizer, text), "<u4")
        wanted += [(doc, k, k * 4096, len(ids[k * 4096:][:4096]),
                    zlib.crc32(ids[k * 4096:][:4096].tobytes())) for k in range(-(-len(ids) // 4096))]
    assert sorted([r[:5] for r in rows], key=str) == sorted(wanted, key=str)
    sequences = {}
    for r in rows:
        sequences.setdefault(r[5], []).append((r[6], r[3]))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 4096
    return len(sequences)


def test_pack_odd_rows(odd_docs, no_docs, tokenizer):
    rows = [tuple(r) for r in P.pack_documents(odd_docs).collect()]
    check_packing(rows, [(r[0], r[1]) for r in ROWS], tokenizer)
    assert P.pack_documents(no_docs).count() == 0


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for x in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= x]
        if fits:
            gaps.remove(min(fits))
            if min(fits) > x:
                gaps.append(min(fits) - x)
        else:
            gaps.append(capacity - x) if capacity > x else gaps.append(0)
            best_fit_decreasing.opened += 1
    return best_fit_decreasing.opened


@pytest.mark.parametrize("seed", range(6))
def test_rounds_equal_best_fit_decreasing(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([10, 64, 100])
    lengths = [rnd.randrange(1, capacity + 1) if seed % 2 else min(capacity, int(rnd.expovariate(0.1)) + 1)
               for _ in range(rnd.randrange(1, 400))]
    counts = {x: lengths.count(x) for x in set(lengths)}
    plan = P.placements(counts, capacity)
    used = {}
    for length in counts:
        runs = sorted(r for r in plan.tolist() if r[0] == length)
        for (_, rank, first, offset), end in zip(runs, [r[1] for r in runs[1:]] + [counts[length]]):
            for k in range(end - rank):
                used.setdefault(first + k, []).append((offset, length))
    for placed in used.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    best_fit_decreasing.opened = 0
    assert sum(map(len, used.values())) == len(lengths)
    assert len(used) == best_fit_decreasing(lengths, capacity)


def test_a_length_shared_by_most_is_spread(spark, tokenizer):
    docs = [(i, "same words here again") for i in range(500)] + [(900 + i, "x " * i) for i in range(40)]
    rows = [tuple(r) for r in P.pack_documents(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()]
    total = sum(r[3] for r in rows)
    assert check_packing(rows, docs, tokenizer) == -(-total // 4096)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 1000, 4097])
def test_permutation_is_a_bijection(n):
    order = O.Permutation(n, 99)
    slots = order.slot(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert (order.number(slots) == np.arange(n)).all()
    if n > 900:
        assert (O.Permutation(n, 100).slot(np.arange(n)) != slots).mean() > 0.9
        assert abs(np.corrcoef(slots, np.arange(n))[0, 1]) < 0.1


def test_shards_round_trip(spark, odd_docs, no_docs, tokenizer, tmp_path_factory):
    folder = shared_folder(spark, "order-test")
    path = str(tmp_path_factory.mktemp("in") / "t")
    odd_docs.write.parquet(path)
    table = spark.read.parquet(path)
    shards = O.materialise(table, folder, length=64, shard_bytes=150_000)
    rows = {r["slot"]: r for r in O.read(spark, shards).collect()}
    assert sorted(rows) == list(range(shards.sequences)) and len(shards.sizes) > 2
    wanted = []
    for r in ROWS:
        ids = whole(tokenizer, r[1])
        wanted += [(r[0], k, ids[64 * k:64 * k + 64]) for k in range(-(-len(ids) // 64))]
    assert sorted(((r["doc_id"], r["piece"], r["ids"]) for r in rows.values()), key=str) == \
        sorted(wanted, key=str)
    for s, r in rows.items():
        assert s == shards.starts[r["shard"]] + r["record"] and r["length"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    # resumed in the middle of a shard
    later = {r["slot"]: r["ids"] for r in O.read(spark, shards, 50).collect()}
    assert later == {s: r["ids"] for s, r in rows.items() if s >= 50}
    # written again: the same bytes
    again = O.materialise(table, shared_folder(spark, "order-test"), length=64, shard_bytes=150_000)
    assert {r["slot"]: r["ids"] for r in O.read(spark, again).collect()} == \
        {s: r["ids"] for s, r in rows.items()}
    assert O.training_order(no_docs).count() == 0
