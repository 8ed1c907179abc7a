"""Conversation repair against a plain dynamic programme over all edits."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from tokloom.llm import chat_repair as R
from tokloom.llm.common import table

SPACE = " \t\n\x0b\x0c\r"


def cheapest(codes):
    """(cost, letters) by value iteration from the end; the structure is a regular expression."""
    moves = {("0", "s"): "1", ("0", "u"): "2", ("1", "u"): "2", ("2", "a"): "3", ("3", "u"): "2"}
    best = {q: (0, "") if q in "03" else None for q in "0123"}
    for i in range(len(codes), -1, -1):
        if i < len(codes):
            c, now = codes[i], {q: None for q in "0123"}
            for q in "0123":
                ways = [(2 + best[q][0], "D" + best[q][1])] if best[q] else []
                for role in "sua" if c != "-" else "":
                    to = moves.get((q, role))
                    if to is None or not best[to]:
                        continue
                    late = 5 if c.isupper() else 0
                    if c.lower() == role:
                        ways.append((late + best[to][0], "K" + best[to][1]))
                    if role in "ua":
                        ways.append((late + 1 + best[to][0], "R" + best[to][1]))
                now[q] = min(ways, default=None)
            best = now
        for _ in range(6):  # insertions lead to other states of the same row
            for q in "0123":
                for role in "ua":
                    to = moves.get((q, role))
                    if to and best[to]:
                        way = (5 + best[to][0], "I" + best[to][1])
                        best[q] = min(best[q] or way, way)
    return best["0"]


def by_hand(rows):
    """{conv_id: result row} of (conv_id, turn, role, text) rows."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        kept = convs[conv]
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, codes, faults = set(), "", [0, 0, 0]
        for _, role, text in kept:
            bare = text.rstrip(SPACE)
            initial = role[:1] if role[:1] in tuple("sua") else "x"
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                faults[fault] += 1
            codes += "-" if fault in (0, 1) else initial.upper() if fault == 2 else initial
        turns = {t for t, _, _ in kept if t is not None}
        cost, letters = cheapest(codes)
        lines, last, i = [], "", 0
        for c in letters:
            role = "assistant" if last == "u" else "user"
            if c == "I":
                lines.append(f"{role}:")
                last = role[0]
                continue
            if c != "D":
                role = kept[i][1] if c == "K" else role
                lines.append(f"{role}:{kept[i][2]}")
                last = role[0]
            i += 1
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))
        firsts = [r[1][:1] for r in kept]
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *faults,
                     sum(x + y not in ("su", "ua", "au") for x, y in zip(firsts, firsts[1:])), cost, letters,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def results(df):
    rows = df.collect()
    got = {r["conv_id"]: tuple(r)[1:] for r in rows}
    assert len(got) == len(rows)
    return got


def random_codes(rnd, most=12):
    return "".join(rnd.choice("suaUAX-xsua") for _ in range(rnd.randrange(most)))


def test_search_is_cheapest_and_least():
    rnd = random.Random(1)
    for _ in range(4000):
        codes = random_codes(rnd)
        assert R.search(codes) == cheapest(codes), codes
    for codes in ("ua" * 400, "u" * 120, "a" * 120, "su" * 60, "-" * 300, "U" * 60, "x" * 90):
        assert R.search(codes) == cheapest(codes)


def test_joined_segments_are_one_search():
    rnd = random.Random(2)
    for _ in range(800):
        codes = random_codes(rnd, 24) or "u"
        cuts = sorted({0, len(codes), *(rnd.randrange(1, len(codes) + 1) for _ in range(4))})
        parts = [codes[a:b] for a, b in zip(cuts, cuts[1:])]
        found = [{(b, e): (c, p) for b, e, c, p in R.segment_searches(x)} for x in parts]
        segments = [([f[b, e][0] if (b, e) in f else -1 for b in range(4) for e in range(4)],
                     [sorted(f[b, x][1] for x in range(4) if (b, x) in f).index(f[b, e][1]) if (b, e) in f else 0
                      for b in range(4) for e in range(4)]) for f in found]
        cost, states = R.join_segments(segments)
        letters = "".join(f[b, e][1] for f, b, e in zip(found, states, states[1:]))
        assert (cost, letters + "I" * R.CLOSING[states[-1]]) == cheapest(codes), (codes, parts)


KIND = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                     T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                     *[T.StructField(c, T.StringType()) for c in ("copies", "blank", "part", "of", "rows", "audit")]])


def frame(spark, rows):
    return spark.createDataFrame([(*r, *"abcdef") for r in rows], KIND).repartition(3)


def odd_rows():
    rnd = random.Random(3)
    texts = ["Yes.", "No", "", None, " \t", "a.", "Why? \n", "Zoë!", "x" * 5000 + ".", "no . end", "1", ". "]
    rows = [(c, rnd.choice([None, *range(-2, 9)]), rnd.choice(["system", "user", "assistant", "tool", "", None, "User"]),
             rnd.choice(texts)) for c in [None, *range(60)] for _ in range(rnd.randrange(1, 9))]
    rows += [(100, k, ["user", "assistant"][k % 2], f"turn {k}.") for k in range(90)]
    rows += [(101, 5, "user", "the same.")] * 70 + [(102, None, None, None)] * 30
    # conversations that lose every row
    lost = [c for c in range(200, 400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    return rows + [(c, 0, "user", "gone.") for c in lost]


@pytest.mark.parametrize("long_rows, segment", [(1000, 256), (0, 1), (0, 7), (4, 3)])
def test_odd_rows(spark, long_rows, segment):
    rows = odd_rows()
    assert results(R.repair(frame(spark, rows), long_rows, segment=segment)) == by_hand(rows)


def test_long_by_bytes(spark):
    rows = odd_rows()
    assert results(R.repair(frame(spark, rows), long_bytes=4000, segment=5)) == by_hand(rows)


def test_nothing(spark):
    assert R.repair(frame(spark, [])).collect() == []


def test_whole_table(spark, sf_small):
    chats = table(spark, sf_small, "conversations")
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in chats.collect()]
    assert results(R.repair(chats)) == by_hand(rows)
