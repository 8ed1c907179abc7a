from odd_rows import LONG, PASSAGE
from tokloom.llm import decontam as D


def brute(docs, items, percent=80):
    import re

    def sh(text):
        w = re.findall(r"[^\W_]+", (text or "").lower())
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

    united, wanted = {}, {}
    for i, t in docs:
        united.setdefault(i, set()).update(sh(t))
    for i, t in items:
        wanted.setdefault(i, set()).update(sh(t))
    return sorted(((d, i, len(s), len(s & x)) for d, x in united.items() for i, s in wanted.items()
                   if s and i is not None and 100 * len(s & x) >= percent * len(s)), key=str)


def test_odd_rows(spark, odd_docs, no_docs):
    items = [(1, " ".join(LONG.split()[500:540])), (2, PASSAGE.upper() + "!"), (3, "too short item"), (4, None),
             (5, ""), (None, PASSAGE), (6, "fox jumps over the lazy dog and runs"), (2, PASSAGE.upper() + "!")]
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, h string")
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    out = sorted((tuple(r) for r in D.matches(odd_docs, bench).collect()), key=str)
    assert out == brute(docs, items) and len(out) > 4
    assert D.matches(no_docs, bench).count() == 0
    assert D.matches(odd_docs, bench.limit(0)).count() == 0
    clean = D.clean(odd_docs, bench)
    assert clean.columns == odd_docs.columns
    # the ids that hold an item go, with the rows without an id, which are one document; the others stay
    assert {r[0] for r in clean.select("doc_id").collect()} == {5, 6, 7, 8, 9, 11, -12}


def test_edited_items_in_long_documents(spark):
    item = [f"q{i}" for i in range(40)]
    filler = [f"f{i}" for i in range(5000)]
    rows = []
    for k, edits in enumerate(([], [3], [3, 30], [20], [0, 39], [8, 16, 24])):
        text = list(item)
        for e in edits:
            text[e] = "changed"
        rows.append((k, " ".join(filler[:2500] + text + filler[2500:])))
    out = D.matches(spark.createDataFrame(rows, "doc_id long, text string"),
                    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"))
    found = sorted(tuple(r) for r in out.collect())
    assert found == brute(rows, [(1, " ".join(item))])
    assert {r[0] for r in found} >= {0, 1, 3, 4}


def test_sketch_is_long_enough(spark):
    """Every way to lose a fifth of an item's shingles leaves a sketch hash: by counting."""
    items = spark.createDataFrame([(n, " ".join(f"{n}w{i}" for i in range(n + 4))) for n in range(1, 70)],
                                  "item_id long, text string")
    sizes = dict(D.sketches(items, 80).groupBy("item_id").count().collect())
    assert all(sizes[n] >= n - -(-n * 80 // 100) + 1 for n in range(1, 70))


def test_short_items_and_scripts_without_spaces(spark):
    han = "机器学习模型需要大量干净的文本数据"
    items = [(1, "Xylophone!"), (2, "to be, or not"), (3, han), (4, "日本"), (5, "สวัสดีครับผมชื่อ"), (6, "... ?"),
             (7, "one two three four five six")]
    docs = [(1, "a xylophone plays"), (2, "xylophones to be or not, that"), (3, "我们知道" + han + "才能训练"),
            (4, "日 x 本"), (5, "在日本人"), (6, "ว่าสวัสดีครับผมชื่อนาย"), (7, "to be or never"), (8, han[:9]),
            (9, "to be"), (10, "so one two three four five six"), (11, None)]
    out = D.matches(spark.createDataFrame(docs, "doc_id long, text string"),
                    spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r[0], r[1]) for r in out.collect()) == [(1, 1), (2, 2), (3, 3), (5, 4), (6, 5), (10, 7)]
    assert {r[2:] for r in out.filter("item_id in (1, 2, 4)").collect()} == {(1, 1)}


def test_rows_are_judged_apart(spark):
    item = " ".join(f"q{i}" for i in range(40))
    half = [" ".join(f"q{i}" for i in r) for r in (range(24), range(20, 40))]
    rows = [(None, item), (None, "clean text of one row"), (None, None), (None, ""), (None, half[0]), (None, half[1]),
            (7, "x " + item), (7, "another text"), (8, half[0]), (8, half[1])]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, held_id int")
    kept = D.clean_rows(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert kept.columns == docs.columns
    assert {r["held_id"] for r in kept.collect()} == set(range(10)) - {0, 6}
