"""Benchmark decontamination: which documents hold which test items.

DataFrame functions only. Words are runs of letters and digits of the lower-cased text; each character of a
script without spaces is a word of its own. Sets are distinct five-word shingles; an item of fewer words is one
shingle, its whole word sequence. A document holds an item when it has at least ``percent`` of the item's
shingles.

Items are short and documents long, so their Jaccard similarity says little. Items are partitioned by the
size of their set, in powers of two; each partition has its own MinHash sketch length: so many of
an item's smallest shingle hashes that a document which reaches the containment must hold one of
them (u - ceil(u * percent / 100) + 1 for the partition's largest size u). Every shingle of every document,
of five words and of the smaller numbers that items have, is held against the sketches; the candidates are then
verified on the shingles themselves.

Sketches and item shingles are held against the documents in blocks of at most ``BLOCK`` rows, each broadcast: so
documents are read once a block, but neither their shingles nor their texts are ever shuffled, and a passage
that a third of them share is no hot key. The documents of candidates are found again by a broadcast of their keys while
those are no more than ``KEYS``, else by a join.

Edge cases: null and empty texts, and items without a word, have no shingle and match nothing.
Rows that repeat a document id (or have none) count as one document whose sets are united, and rows that
repeat an item id as one item; items without id are left out. ``clean_rows`` judges row by row. Extra columns
are never read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tokloom.llm.common import named_rows, stored

WIDTH = 5
PERCENT = 80
#: Rows of a broadcast: of sketches or item shingles, and of keys of documents.
BLOCK, KEYS = 500_000, 2_000_000
#: Scripts that put no spaces between words.
UNSPACED = (r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
            r"&&[\p{L}\p{N}]]")


#: Ranges that hold all of them, to tell quickly that a text needs no spaces.
_NEAR_UNSPACED = (r"[\x{e00}-\x{109f}\x{1780}-\x{19ff}\x{2e80}-\x{9fff}\x{a9e0}-\x{aaff}\x{f900}-\x{faff}"
                  r"\x{ff00}-\x{ffef}\x{16f00}-\x{16fff}\x{1b000}-\x{1b2ff}\x{20000}-\x{3ffff}]")


def words(text) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    plain = F.octet_length(low) == F.length(low)  # ASCII, for which a simpler pattern says the same
    return F.array_remove(F.when(plain, F.split(low, "[^a-z0-9]+")).otherwise(F.split(low, r"[^\p{L}\p{N}]+")), "")


def _apart(text: Column) -> Column:
    """``text`` with spaces around each character of a script that has none."""
    may = (F.octet_length(text) > F.length(text)) & text.rlike(_NEAR_UNSPACED)
    return F.when(may, F.regexp_replace(text, UNSPACED, " $0 ")).otherwise(text)


def _words(df: DataFrame, key: str) -> DataFrame:
    """(key, w): the words of each text. No filter on their number: it would be pushed down, and the words be made
    once for it and once more."""
    return df.select(key, words(_apart(F.col("text"))).alias("w"))


def _shingles(df: DataFrame, key: str, widths: list[int], of) -> DataFrame:
    """(key, s): ``of(words)`` of every run of as many words as one of ``widths``."""
    w = _words(df, key)
    last = F.size("w") - min(widths)
    at = w.select(key, "w", F.explode(F.when(last >= 0, F.sequence(F.lit(0), last))).alias("i"))
    part = lambda k: of([F.get("w", F.col("i") + j) for j in range(k)])
    if len(widths) == 1:
        return at.select(key, part(widths[0]).alias("s"))
    each = F.array(*[F.when(F.col("i") + k <= F.size("w"), part(k)) for k in widths])
    return at.select(key, F.explode(each).alias("s")).filter("s is not null")


def _item_shingles(items: DataFrame, of) -> DataFrame:
    """(item_id, s): five words each, or all words of an item that has fewer."""
    w = _words(items, "item_id")
    last = F.greatest(F.size("w") - WIDTH, F.lit(0))
    at = w.select("item_id", "w", F.explode(F.when(F.size("w") > 0, F.sequence(F.lit(0), last))).alias("i"))
    part = lambda k: of([F.get("w", F.col("i") + j) for j in range(k)])
    own = part(WIDTH)
    for k in range(1, WIDTH):
        own = F.when(F.size("w") == k, part(k)).otherwise(own)
    return at.select("item_id", own.alias("s"))


def _hash(parts: list[Column]) -> Column:
    return F.xxhash64(*parts)


def _joined(parts: list[Column]) -> Column:
    return F.concat_ws(" ", *parts)


def _widths(items: DataFrame) -> list[int]:
    """The numbers of words, at most five, that the items' shingles have."""
    found = (_words(items, "item_id").select(F.least(F.size("w"), F.lit(WIDTH)).alias("k"))
             .distinct().collect())
    return sorted(r["k"] for r in found if r["k"]) or [WIDTH]


def _blocks(rows: DataFrame, by: str) -> list[DataFrame]:
    """A stored table in parts of about ``BLOCK`` rows, each for a broadcast; rows equal in ``by`` share a part."""
    n = -(-rows.count() // BLOCK)
    return [F.broadcast(rows if n == 1 else rows.filter(F.pmod(F.xxhash64(by), F.lit(n)) == k)) for k in range(n)]


def _small(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.limit(KEYS + 1).count() <= KEYS else keys


def sketches(items: DataFrame, percent: int) -> DataFrame:
    """(h, item_id): the sketch of each item, its smallest hashes."""
    sets = (_item_shingles(items, _hash).groupBy("item_id")
            .agg(F.array_sort(F.collect_set("s")).alias("hashes")))
    n = F.size("hashes")
    largest = F.pow(F.lit(2), F.length(F.bin(n))).cast("int") - 1  # the largest of as many binary digits
    needed = lambda size: F.ceil(size * F.lit(percent) / F.lit(100))
    length = (largest - needed(largest) + 1).cast("int")
    return sets.select(F.explode(F.slice("hashes", 1, F.least(length, n))).alias("h"), "item_id")


def _matches(docs: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """``matches`` of documents (doc_id of any type, text) and items (item_id, text) with an id."""
    widths = _widths(items)
    shingles = stored(_item_shingles(items, _joined).distinct().withColumn("h", F.xxhash64("s")), "item-shingles")
    sketch = stored(sketches(items, percent), "sketches")
    hashes = _shingles(docs, "doc_id", widths, _hash).withColumnRenamed("s", "h")
    none = hashes.select("doc_id", F.lit(0).cast("long").alias("item_id")).limit(0)
    found = reduce(DataFrame.unionByName, [hashes.join(part, "h").select("doc_id", "item_id")
                                           for part in _blocks(sketch, "h")], none)
    candidates = stored(found.distinct(), "candidates")
    suspects = _small(stored(candidates.select(F.col("doc_id").alias("suspect")).distinct(), "suspects"))
    texts = stored(docs.join(suspects, F.col("doc_id").eqNullSafe(F.col("suspect")), "left_semi"), "suspect-texts")
    said = _shingles(texts, "doc_id", widths, _joined).withColumn("h", F.xxhash64("s"))
    # a document's shingle counts once an item, however many rows have the document's id
    shared = reduce(DataFrame.unionByName, [
        said.join(part.withColumnRenamed("s", "own"), "h").filter("s = own").select("doc_id", "item_id", "h", "s")
        for part in _blocks(shingles, "h")], said.select("doc_id", F.lit(0).cast("long").alias("item_id"), "h", "s").limit(0))
    shared = shared.distinct().groupBy("doc_id", "item_id").agg(F.count("*").alias("n_shared"))
    sizes = shingles.groupBy("item_id").agg(F.count("*").alias("n_item"))
    pairs = candidates.select(F.col("doc_id").alias("c_doc"), F.col("item_id").alias("c_item"))
    return (shared.join(pairs, F.col("doc_id").eqNullSafe(F.col("c_doc"))
                        & (F.col("item_id") == F.col("c_item")), "left_semi")
            .join(sizes, "item_id").filter(F.col("n_shared") * 100 >= F.col("n_item") * percent)
            .select("doc_id", "item_id", "n_item", "n_shared"))


def _items(benchmark: DataFrame) -> DataFrame:
    return named_rows(benchmark, item_id="long", text="string").filter("item_id is not null")


def matches(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared) of every document that holds an item."""
    return _matches(named_rows(docs, doc_id="long", text="string"), _items(benchmark), percent)


def clean(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of documents that hold no item, with all their columns."""
    held = stored(matches(docs, benchmark, percent).select(F.col("doc_id").alias("held_id"))
                  .distinct(), "contaminated")
    return docs.join(_small(held), docs["doc_id"].eqNullSafe(held["held_id"]), "left_anti")


def clean_rows(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows whose own text holds no item, with all their columns, whatever ids they have or lack.

    Rows are told apart by 128 bits of hash of their text, so equal texts are judged once.
    """
    digest = lambda c: F.struct(F.xxhash64(F.lit(1), c.cast("string")), F.xxhash64(c.cast("string")))
    texts = named_rows(docs, text="string").select(digest(F.col("text")).alias("doc_id"), "text")
    held = stored(_matches(texts, _items(benchmark), percent).select(F.col("doc_id").alias("held_id"))
                  .distinct(), "contaminated")
    return docs.join(_small(held), digest(docs["text"]) == held["held_id"], "left_anti")
