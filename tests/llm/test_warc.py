import gzip
import hashlib
import io
import json

import pytest

from tokloom.llm import warc_normalise as W
from tokloom.llm.common import shared_folder
from tokloom.llm.files import Folder


def brute(pages):
    groups = {}
    for i, _, html in pages:
        p = (html or "").encode()
        groups.setdefault(p, []).append(i)
    out = []
    for i, _, html in pages:
        p = (html or "").encode()
        top = max((x for x in groups[p] if x is not None), default=None)
        refers = top if len(p) >= 1000 and i != top else None
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


BIG = "<html>" + "é line\r\n\r\nWARC/1.1\r\n" * 200
PAGES = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, None, BIG), (3, "http://a/3", BIG), (4, "http://a/4", "x"),
         (5, "http://a/\r\n5", "x"), (6, "u", None), (7, "u", ""), (None, "u", BIG), (None, "u", "y" * 1000),
         (None, None, "y" * 1000), (8, "u", "z" * 999), (9, "u", "z" * 999), (10, "u", "w" * 3_000_000)]


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "k", 1) for r in rows],
                                 "page_id long, url string, html string, digest string, response int")


def test_odd_rows(spark):
    df = pages_of(spark, PAGES).repartition(3)
    assert sorted((tuple(r) for r in W.page_archives(spark, df).collect()), key=str) == brute(PAGES)
    assert W.page_archives(spark, df.limit(0)).count() == 0


def test_each_member_opens_alone_and_holds_the_same_record(spark):
    mono, to = shared_folder(spark, "mono"), shared_folder(spark, "norm")
    names = W.write_archives(pages_of(spark, PAGES).coalesce(1), mono, archive_bytes=5_000)
    done = W.normalise(names, mono, to)
    assert sum(r["records"] for r in done.collect()) == len(PAGES)
    assert names.count() > 1  # archives are cut by size
    for name in [r["name"] for r in names.collect()]:
        whole = gzip.decompress(Folder(mono).read(name).read())
        data = Folder(to).read(name).read()
        index = [json.loads(x) for x in Folder(to).read(f"{name}.index").read().splitlines()]
        parts = [gzip.decompress(data[x["offset"]:x["offset"] + x["size"]]) for x in index]
        assert b"".join(parts) == whole and sum(x["size"] for x in index) == len(data)
        assert [len(p) for p in parts] == [x["length"] for x in index]
        assert all(p.startswith(b"WARC/1.1\r\n") for p in parts)
        assert all((x["type"] == "revisit") == ("refers_to" in x) for x in index)


def test_archives_of_several_members_and_small_chunks(monkeypatch):
    records = [W.record(i, "u", b"p" * (i * 7000), "d", None) for i in range(6)]
    data = gzip.compress(b"".join(records[:2])) + b"".join(map(gzip.compress, records[2:]))
    for chunk in (1 << 20, 64, 5):
        monkeypatch.setattr(W, "CHUNK", chunk)
        got, r = [], W.Records(io.BytesIO(data))
        while (head := r.head()) is not None:
            got.append(head + b"".join(r.body(int(W.fields(head)["content-length"]) + 4)))
        assert got == records


def test_broken_archives_raise():
    data = gzip.compress(W.record(1, "u", b"p" * 9000, "d", None))
    for broken in (data[:-20], gzip.compress(W.record(1, "u", b"p" * 9000, "d", None)[:-100])):
        r = W.Records(io.BytesIO(broken))
        with pytest.raises(ValueError):
            head = r.head()
            list(r.body(int(W.fields(head)["content-length"]) + 4))
            r.head()
    with pytest.raises(ValueError):
        W.fields(b"HTTP/1.1 200 OK\r\n\r\n")
