import random
import re
import zlib

import corpus_pipeline as C
import pytest
from odd_rows import ROWS
from tokloom.llm import license_scan as S, queries
from tokloom.llm.common import stored, table

SF = "/root/testdata/sf0.001"


def test_headers_files_and_ancestors(spark):
    mit = "Released under the MIT License."
    files = [("a/LICENSE", "preface\n" + mit), ("a/x.py", "code"), ("a/b/c/y.py", "code"),
             ("a/b/COPYING.txt", dict(S.TEMPLATES)["GPL-3.0"]), ("a/b/z.py", "code\n# Licensed under CC BY 4.0."),
             ("other/w.py", "code of the license"), ("top.py", None), ("a/n.py", mit), ("a/b/c/LICENSE-x", "no"),
             (None, mit), (None, None), ("a/x.py", "code"), ("ab/v.py", ""), ("d/LICENCE", mit), ("d/NOTICE", mit + "!"),
             ("d/e/", "text")]
    df = spark.createDataFrame([(*f, "k", 1) for f in files], "path string, text string, license string, dir int")
    out = {r["path"]: (r["license"], r["origin"], r["from_dir"]) for r in S.scan(df).collect()}
    assert out == {
        "a/LICENSE": ("MIT", "own", None), "a/x.py": ("MIT", "inherited", "a"),
        "a/b/c/y.py": ("GPL-3.0", "inherited", "a/b"), "a/b/COPYING.txt": ("GPL-3.0", "own", None),
        "a/b/z.py": ("CC-BY-4.0", "own", None), "other/w.py": (None, None, None), "top.py": (None, None, None),
        "a/n.py": ("MIT", "own", None), "a/b/c/LICENSE-x": ("GPL-3.0", "inherited", "a/b"),
        None: ("MIT", "own", None), "ab/v.py": (None, None, None), "d/LICENCE": ("MIT", "own", None),
        "d/NOTICE": ("MIT", "own", None), "d/e/": ("MIT", "inherited", "d")}
    assert S.scan(df.limit(0)).count() == 0


def test_embedded_and_wrapped_notices(spark):
    import textwrap

    mit, gpl = "Released under the MIT License.", max((t for k, t in S.TEMPLATES if k == "GPL-3.0"), key=len)
    code = " ".join(f"word{i}" for i in range(200))
    files = [("a", "Copyright (c) 2020 Example Industries Incorporated. All rights reserved. " + mit),
             ("b", f"{code} {mit} {code}"), ("d", code), ("e", None), ("f", ""), ("g", "Released"),
             ("c", code + "\n" + "\n".join("# " + x for x in textwrap.wrap(gpl, 40)) + "\n" + code)]
    out = S.scan(spark.createDataFrame(files, "path string, text string")).collect()
    assert {(r["path"], r["license"], r["cosine"]) for r in out} == {
        ("a", "MIT", 1.0), ("b", "MIT", 1.0), ("c", "GPL-3.0", 1.0), ("d", None, None), ("e", None, None),
        ("f", None, None), ("g", None, None)}


def test_license_odd_rows(odd_docs):
    out = S.op3_licenses(odd_docs).collect()
    ids = {r[0] for r in ROWS}
    assert {r["doc_id"] for r in out} >= {i for i in ids if i is not None and i > 0}


def test_stages_take_effect_on_all_rows(spark):
    docs = table(spark, SF, "documents")
    names, counts = docs.columns, [docs.count()]
    assert [n for n, _ in C.STAGES] == ["language_id", "near_dedup", "decontamination", "pii", "packing"]
    for name, stage in C.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), name)
        assert docs.columns == names
        counts.append(docs.count())
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    source = table(spark, SF, "documents")
    from tokloom.llm import bbit_minhash, decontam, pii_offsets

    kept = {r["doc_id"] for r in bbit_minhash.near_duplicates(source, 80).filter("kept").collect()}
    held = {r["doc_id"] for r in decontam.matches(source, table(spark, SF, "benchmark")).collect()}
    assert ids == kept - held  # no document of these tables is without a language
    left = pii_offsets.spans(docs).filter("spans <> ''")
    assert left.count() == 0
    rows = C.run(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == ids
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in by.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 4096


@pytest.mark.parametrize("k", range(4))
def test_stages_on_odd_rows(spark, odd_docs, no_docs, k):
    stage = C.STAGES[k][1]
    out = stage(spark, odd_docs, SF)
    assert out.columns == odd_docs.columns and 0 < out.count() <= len(ROWS)
    assert stage(spark, no_docs, SF).count() == 0


def test_language_stage_keeps_clean_texts_of_many_languages(spark):
    """A dozen languages in one family, beside a dozen families of one."""
    from tokloom.llm.lang_id import FAMILIES

    rnd = random.Random(4)
    rows = []
    for lang in [*FAMILIES["slavic"].split(), *(f"x{i}" for i in range(12))]:
        own = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randint(3, 8))) for _ in range(60)]
        rows += [(len(rows) + i, " ".join(rnd.choices(own, k=60)), lang) for i in range(25)]
    docs = spark.createDataFrame([*rows, (-1, "12 34", "ru")], "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in C.language(spark, docs, SF).collect()}
    assert kept == {r[0] for r in rows}


def test_near_duplicates_from_four_fifths(spark):
    """One changed word in the middle of 50 shingles: 45 of 55 shared, 0.82; two changed: 40 of 60."""
    from tokloom.llm import bbit_minhash as M

    text = lambda g, edits: " ".join(f"e{g}x{i}" if i in edits else f"w{g}x{i}" for i in range(54))
    rows = [(3 * g + k, text(g, e)) for g in range(100) for k, e in enumerate(([], [27], [15, 40]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in M.keep_one(docs, 80).collect()}
    assert kept == {i for i, _ in rows if i % 3 != 1}
    assert M.near_duplicates(docs).filter("not kept").count() == 0  # op2's contract
    assert (M.rows_of_band(85), M.rows_of_band(80)) == (8, 6)


def test_last_stage_on_odd_rows(spark, odd_docs, no_docs):
    assert C.STAGES[4][1](spark, odd_docs, SF).count() >= len(ROWS)
    assert C.STAGES[4][1](spark, no_docs, SF).count() == 0


def test_every_operator_has_a_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES)
    assert numbers == list(range(1, 11))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_hash_of_ids(spark):
    from tokloom.llm.common import crc32_of_id

    rows = spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", crc32_of_id().alias("c")).collect()
    assert all(r["c"] == zlib.crc32(str(r["doc_id"]).encode()) for r in rows)
