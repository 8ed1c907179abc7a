import hashlib
import random
import re

import pyarrow as pa
import pytest

from odd_rows import ROWS
from tokloom.llm import pii_offsets as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(d[::-1])) % 10 == 0


def plain(text):
    d = lambda s: re.sub(r"[^0-9]", "", s)
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 13 <= len(d(m[0])) <= 19 and luhn(d(m[0]))],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(d(m[0])) <= 15]}


def found(text):
    return next(P.all_spans(pa.array([text], pa.string())))


def test_plain_spans_by_brute_force():
    rnd = random.Random(5)
    for _ in range(4000):
        text = "".join(rnd.choices("ab.@-+ 0123456789()é\n%", k=rnd.randrange(0, 40)))
        assert P.plain_spans(text) == plain(text), text
    for _ in range(300):
        digits = "".join(rnd.choices("0123456789", k=rnd.randrange(12, 21)))
        text = " ".join(digits[i:i + 4] for i in range(0, len(digits), 4))
        assert P.plain_spans(text) == plain(text)


@pytest.mark.parametrize("said, kind, value", [
    ("write to john.doe [at] example [dot] com today", "email", "john.doe [at] example [dot] com"),
    ("write to john at example dot com today", "email", "john at example dot com"),
    ("john(at)example.org", "email", "john(at)example.org"),
    ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
    ("write ab@exa​mple.com", "email", "ab@exa​mple.com"),
    ("call plus one four one five five five five one two one two ok", "phone",
     "plus one four one five five five five one two one two"),
    ("ip 192[.]168[.]0[.]1 here", "ip", "192[.]168[.]0[.]1"),
    ("from one two seven dot zero dot zero dot one on", "ip", "one two seven dot zero dot zero dot one"),
    ("card ４１１１ １１１１ １１１１ １１１１.", "card", "４１１１ １１１１ １１１１ １１１１"),
    ("four one one one one one one one one one one one one one one one", "card",
     "four one one one one one one one one one one one one one one one"),
    ("vier eins eins eins eins eins eins eins eins eins eins eins eins eins eins eins", "card",
     "vier eins eins eins eins eins eins eins eins eins eins eins eins eins eins eins"),
    ("quatre " + "un " * 14 + "un", "card", "quatre " + "un " * 14 + "un"),
    ("four triple one " + "one " * 11 + "one", "card", "four triple one " + "one " * 11 + "one"),
])
def test_disguises(said, kind, value):
    text, base, added = found(said)
    assert not any(base.values())
    assert [text[lo:hi] for lo, hi in added[kind]] == [value]
    assert sum(map(len, added.values())) == 1


@pytest.mark.parametrize("said", [
    "look at example.com", "meet me at the dot", "one two three four", "point one is at hand", "(at) home",
    "at at dot dot", "un deux trois quatre cinq", "naïve café – déjà", "x [.] y", "five dot five dot five",
    "the address 1.2.3 dot", "", " ",
])
def test_clean_texts_stay_clean(said):
    text, base, added = found(said)
    assert not any(base.values()) and not any(added.values())


def test_plain_spans_stay_and_win():
    text, base, added = found("a@b.cd and c [at] d.ef, 10.0.0.1 and 10 dot 0 dot 0 dot 2")
    assert [text[a:b] for a, b in base["email"] + added["email"]] == ["a@b.cd", "c [at] d.ef"]
    assert [text[a:b] for a, b in base["ip"] + added["ip"]] == ["10.0.0.1", "10 dot 0 dot 0 dot 2"]


def test_odd_rows(odd_docs, no_docs):
    out = sorted((tuple(r) for r in P.spans(odd_docs).collect()), key=str)
    wanted = []
    for r in ROWS:
        p = plain(r[1] or "")
        told = ",".join(f"{k}:{a}:{b}" for k in P.KINDS for a, b in p[k])
        wanted.append((r[0], *(len(p[k]) for k in P.KINDS), hashlib.sha256(told.encode()).hexdigest(), told, 0))
    assert out == sorted(wanted, key=str)
    assert P.spans(no_docs).count() == 0


def test_redaction_keeps_rows_and_columns(spark, odd_docs, no_docs):
    out = P.redact(odd_docs)
    assert out.columns == odd_docs.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, odd_docs.collect()))
    docs = spark.createDataFrame([(1, "mail a@b.cd or x at y dot com, +1 (017) 555-7713 ok", 99, "k"),
                                  (2, None, 5, "k")], "doc_id long, text string, n_chars int, spans string")
    rows = P.redact(docs).orderBy("doc_id").collect()
    assert rows[0]["text"] == "mail <EMAIL> or <EMAIL>, <PHONE> ok"
    assert rows[0]["n_chars"] == len(rows[0]["text"]) and tuple(rows[1]) == (2, None, 5, "k")
    assert P.redact(no_docs).count() == 0


@pytest.mark.parametrize("text", ["1" * 300_000, "a@" * 100_000, "one " * 60_000, "x at " * 50_000 + "[at]",
                                  "+1 " + "(" * 200_000, "1 dot " * 50_000, "a." * 100_000])
def test_long_texts_take_linear_time(text):
    import time

    t = time.process_time()
    found(text)
    assert time.process_time() - t < 20
