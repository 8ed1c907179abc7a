"""Near-duplicate documents by b-bit MinHash.

1. Each text gives its set of distinct word shingles, the minima of it under 384 hash functions, 48 band
   keys of 8 minima each (lower similarities take shorter bands), and the lowest two bits of every minimum, packed as two bit planes.
2. Texts with equal sets form one class with one representative; only representatives go on.
3. Representatives that share a band key are candidates. In each bucket they are first paired with the
   bucket's leader only, the member that meets most others; a representative keeps the leader with the
   most equal bits. Then the leaders of the components that a bucket still has are paired with its leader. Buckets whose
   members then lie in one component are finished, however large they are.
4. The members of other buckets go through an inverted index. Each set is sorted by how rare its shingles are among
   them; two sets of the similarity share a shingle of their beginnings, and the first they share stands where enough
   are left behind it. Members of one component are never paired: of the sets that begin with a shingle, those
   outside the component that has most are held against all. The bit counts, corrected for chance collisions,
   thin the pairs out. The most similar pair of two components is confirmed first; the rest only while the
   components stay apart.
5. A link counts only when the full sets confirm it; components come from links alone.

A pair at similarity 0.85 shares no band with probability (1 - 0.85^8)^48 = 2e-7 (at 0.80, with 64 bands of
6, 4e-9) and is lost by the bit
counts with less than 1e-6 (five standard deviations).

Edge cases: texts without words (null, empty, blank) have an empty set and are linked with nothing.
Rows that repeat an id are one node: the id is linked when one of its texts is. Rows without an id are
linked with nothing and kept. Extra columns are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tokloom.llm import bytetext as B
from tokloom.llm.common import named_rows, small, stored
from tokloom.llm.graph import components

WIDTH = 5
BANDS, ROWS = 48, 8
HASHES = BANDS * ROWS
PLANE = HASHES // 64
SIGMAS = 5.0
#: Slots of the histogram by which shingles count as rare, and parts that the sets of one shingle are dealt to.
SLOT_BITS = 20
SALTS = 8
#: Bytes of text and rows of minima that a task holds at a time.
SLICE, ROWS_AT_ONCE = 1 << 20, 1024

_rng = np.random.default_rng(7)
_A = (_rng.integers(0, 2**31, (HASHES, 1), dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _rng.integers(0, 2**32, (HASHES, 1), dtype=np.uint32)

_FEATURES = ("doc_id long, n_shingles long, set_a long, set_b long, sig array<long>, "
             "bands array<long>")


def minima(shingles: np.ndarray) -> np.ndarray:
    """Minimum of the set under each hash function."""
    values = (shingles >> np.uint64(32)).astype(np.uint32)[None, :]
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, values.shape[1], 4096):
        np.minimum(out, (_A * values[:, at:at + 4096] + _B).min(axis=1), out=out)
    return out


def rows_of_band(percent: int) -> int:
    """The longest bands of which a pair at the threshold misses all with less than 1e-6."""
    return max(r for r in range(1, HASHES + 1) if HASHES % r == 0
               and (r == 1 or (1 - (percent / 100) ** r) ** (HASHES // r) < 1e-6))


def band_keys(least: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """64-bit key of each band of each row of minima (texts x HASHES)."""
    parts = least.reshape(len(least), HASHES // rows, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, HASHES // rows + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(rows):
        key = B.mix(key ^ parts[:, :, k])
    return key


def packed(least: np.ndarray) -> np.ndarray:
    """The lowest bit of all minima, then the second lowest: 2 * PLANE words of 64 bits a text.

    The low bits of A * x + B depend on those of x alone, so two minima would differ in them under all
    hash functions or none; each minimum is therefore mixed with the number of its function first.
    """
    own = np.arange(1, HASHES + 1, dtype=np.uint64) << np.uint64(32)
    mixed = B.mix(least.astype(np.uint64) | own)
    planes = [np.packbits(((mixed >> np.uint64(k)) & np.uint64(1)).astype(np.uint8), axis=1)
              for k in (0, 1)]
    return np.ascontiguousarray(np.concatenate(planes, axis=1)).view(np.int64)


def _lists(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width),
                                    pa.array(rows.reshape(-1)))


def _features(batches, rows: int):
    for batch in batches:
        for part in B.slices(batch, "text", SLICE):
            _, _, _, h, first = B.words(part.column("text"))
            for at in range(0, part.num_rows, ROWS_AT_ONCE):
                some = part.slice(at, ROWS_AT_ONCE)
                n = some.num_rows
                least = np.zeros((n, HASHES), np.uint32)
                size, digest = np.zeros(n, np.int64), np.zeros((2, n), np.uint64)
                for i in range(n):
                    s = B.shingles(h[first[at + i]:first[at + i + 1]], WIDTH)
                    size[i] = len(s)
                    if len(s):
                        least[i] = minima(s)
                        digest[0, i] = B.mix(s).sum()
                        digest[1, i] = B.mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum()
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), pa.array(size), pa.array(digest[0].view(np.int64)),
                     pa.array(digest[1].view(np.int64)), _lists(packed(least)),
                     _lists(band_keys(least, rows).view(np.int64))],
                    ["doc_id", "n_shingles", "set_a", "set_b", "sig", "bands"])


def mismatches(a: str, b: str):
    """Number of minima whose kept bits differ."""
    return sum(F.bit_count(
        F.col(a)[k].bitwiseXOR(F.col(b)[k]).bitwiseOR(
            F.col(a)[k + PLANE].bitwiseXOR(F.col(b)[k + PLANE]))) for k in range(PLANE))


def most_mismatches(percent: int) -> int:
    """Bound that a pair at the threshold passes with probability 1 - 3e-7.

    Minima differ with probability 1 - J, and then two kept bits differ in 3 of 4 cases.
    """
    p = (1 - percent / 100) * 0.75
    return int(np.ceil(HASHES * p + SIGMAS * np.sqrt(HASHES * p * (1 - p)) + 1))


def _shared(batches):
    for batch in batches:
        for part in B.slices(batch, "text_a", SLICE):
            sets = []
            for c in ("text_a", "text_b"):
                _, _, _, h, first = B.words(part.column(c))
                sets.append([B.shingles(h[first[i]:first[i + 1]], WIDTH)
                             for i in range(part.num_rows)])
            both = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*sets)]
            total = [len(x) + len(y) - n for x, y, n in zip(*sets, both)]
            yield pa.RecordBatch.from_arrays(
                [part.column("a"), part.column("b"), pa.array(both, pa.int64()),
                 pa.array(total, pa.int64())], ["a", "b", "n_both", "n_union"])


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the similarity."""
    of = lambda side: texts.select(F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}"))
    return (pairs.select("a", "b").join(of("a"), "a").join(of("b"), "b")
            .select("a", "b", "text_a", "text_b")
            .mapInArrow(_shared, "a long, b long, n_both long, n_union long")
            .filter(F.col("n_both") * 100 >= F.col("n_union") * percent).select("a", "b"))


def links(docs: DataFrame, reps: DataFrame, ties: DataFrame, percent: int) -> DataFrame:
    """(node, component) of the representatives that have links; ``ties`` are links known before."""
    limit = most_mismatches(percent)
    bands = reps.select(F.posexplode("bands").alias("no", "band"), F.col("rep"))
    buckets = stored(bands.groupBy("band").agg(F.count("*").alias("members")).filter("members > 1"), "shared-bands")
    live = stored(bands.select("band", "rep").join(small(buckets), "band"), "buckets")
    ids = stored(live.select(F.col("rep").alias("doc_id")).distinct(), "live")
    texts = stored(docs.join(small(ids), "doc_id"), "texts")
    reps = stored(reps.select("rep", "sig", "n_shingles")
                  .join(small(ids.withColumnRenamed("doc_id", "rep")), "rep"), "signatures")
    alike = ((F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
             & (mismatches("sig_a", "sig_b") <= limit))
    middle = live.groupBy("rep").agg(F.sum("members").alias("met"))
    leaders = stored(live.select("band", "rep").join(middle, "rep").groupBy("band")
                     .agg(F.min(F.struct(-F.col("met"), F.col("rep"))).alias("first"))
                     .select("band", F.col("first.rep").alias("b")), "leaders")
    stars = (_alike(live.select("band", F.col("rep").alias("a")).join(small(leaders), "band").filter("a <> b")
                    .select("a", "b").distinct(), reps, alike)
             .groupBy("a").agg(F.min_by("b", F.struct("off", "b")).alias("b")))
    found = stored(confirmed(stars, texts, percent).unionByName(ties), "confirmed")
    groups = stored(components(found), "groups")
    # one member of each component that a bucket still has, with the bucket's leader
    parts = (_grouped(live.select("band", "rep"), groups, "rep").groupBy("band", "g_rep")
             .agg(F.min("rep").alias("a")))
    apart = _grouped(parts.join(small(leaders), "band").select(F.col("g_rep").alias("g_a"), "a", "b"), groups, "b")
    more = _alike(apart.filter("g_a <> g_b").select("a", "b").distinct(), reps, alike)
    found = stored(found.unionByName(confirmed(stored(more, "chosen"), texts, percent)), "confirmed")
    groups = stored(components(found), "groups")
    pairs = stored(_apart(_grouped(live, groups, "rep"), reps, texts, alike, percent), "pairs")
    for best_only in (True, False):
        apart = _grouped(_grouped(pairs, groups, "a"), groups, "b").filter("g_a <> g_b")
        chosen = stored(_nearest(apart) if best_only else apart.select("a", "b"), "chosen")
        if chosen.isEmpty():
            break
        more = stored(confirmed(chosen, texts, percent), "confirmed")
        pairs = stored(apart.select("a", "b", "off").join(chosen, ["a", "b"], "left_anti"), "pairs")
        if not more.isEmpty():
            found = found.unionByName(more)
            groups = stored(components(found), "groups")
    return groups


def _alike(pairs: DataFrame, reps: DataFrame, alike) -> DataFrame:
    """The pairs (a, b) that ``alike`` allows, by columns n_ and sig_ of either, with the bits that differ (off)."""
    side = lambda c: reps.select(F.col("rep").alias(c), F.col("sig").alias(f"sig_{c}"),
                                 F.col("n_shingles").alias(f"n_{c}"))
    return (pairs.join(side("a"), "a").join(side("b"), "b").filter(alike)
            .select("a", "b", mismatches("sig_a", "sig_b").alias("off")))


def _grouped(rows: DataFrame, groups: DataFrame, node: str) -> DataFrame:
    """``rows`` with the component of column ``node`` as ``g_<node>``."""
    of = groups.select(F.col("node").alias(node), F.col("component").alias(f"g_{node}"))
    return rows.join(of, node, "left").withColumn(f"g_{node}", F.coalesce(f"g_{node}", node))


def _nearest(apart: DataFrame) -> DataFrame:
    """The most similar pair (a, b) of each two components."""
    return (apart.groupBy(F.least("g_a", "g_b").alias("g"), F.greatest("g_a", "g_b").alias("h"))
            .agg(F.min(F.struct("off", "a", "b")).alias("p")).select("p.a", "p.b"))


def _sets(batches):
    """(rows, set of shingle hashes of each row's text), a slice at a time."""
    for batch in batches:
        for part in B.slices(batch, "text", SLICE):
            _, _, _, h, first = B.words(part.column("text"))
            sets = [B.shingles(h[first[i]:first[i + 1]], WIDTH) for i in range(part.num_rows)]
            yield part, sets


def _slots(batches):
    """(slot, n): how many sets of this partition have a shingle in each slot of hashes, about."""
    seen = np.zeros(1 << SLOT_BITS, np.int64)
    for _, sets in _sets(batches):
        all_of = np.concatenate(sets)
        seen += np.bincount((all_of >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=len(seen))
    slot = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(seen[slot])], ["slot", "n"])


def _beginnings(batches, often: np.ndarray, percent: int):
    """(h, pos, rep, g, n): the beginning of each set in the order of rareness, as long as two sets of the
    similarity need to share a shingle of it."""
    for part, sets in _sets(batches):
        out = []
        for s in sets:
            order = np.lexsort((s, often[(s >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]))
            out.append(s[order[:len(s) - -(-len(s) * percent // 100) + 1]])
        size = [len(x) for x in out]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(out).view(np.int64)), pa.array(np.concatenate([np.arange(n) for n in size])),
             pa.array(np.repeat(part.column("doc_id").to_numpy(), size)),
             pa.array(np.repeat(part.column("g_rep").to_numpy(), size)),
             pa.array(np.repeat([len(s) for s in sets], size))], ["h", "pos", "rep", "g", "n"])


def _apart(rows: DataFrame, reps: DataFrame, texts: DataFrame, alike, percent: int) -> DataFrame:
    """Pairs (a, b, off) of texts in buckets of several components that can reach the similarity, in different components.

    The first shingle that two sets share, in the common order, bounds what they share at all: no more than is
    left of either from there on. The order may be any, as long as it is one for all; rareness makes it cheap,
    and a histogram of hashed slots (2^SLOT_BITS numbers, whatever the corpus) says it well enough.
    """
    mixed = stored(rows.groupBy("band").agg(F.min("g_rep").alias("lo"), F.max("g_rep").alias("hi"))
                   .filter("lo < hi").select("band"), "mixed")
    nodes = stored(rows.select("band", "rep", "g_rep").join(small(mixed), "band").select("rep", "g_rep").distinct(), "mixed")
    sets = stored(texts.join(small(nodes.withColumnRenamed("rep", "doc_id")), "doc_id").select("doc_id", "g_rep", "text"),
                  "mixed-texts")
    often = np.zeros(1 << SLOT_BITS, np.int64)
    counted = (sets.mapInArrow(_slots, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow())
    often[counted.column("slot").to_numpy()] = counted.column("n").to_numpy()
    rare = sets.sparkSession.sparkContext.broadcast(often)
    index = stored(sets.mapInArrow(lambda b: _beginnings(b, rare.value, percent),
                                   "h long, pos long, rep long, g long, n long"), "index")
    most = (index.groupBy("h", "g").agg(F.count("*").alias("c")).groupBy("h")
            .agg(F.max_by("g", F.struct("c", "g")).alias("most"), F.count("*").alias("parts"))
            .filter("parts > 1").select("h", "most"))
    shared = stored(index.join(small(stored(most, "mixed-shingles")), "h"), "index")
    x = shared.filter("g <> most").select(
        "h", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
        *[F.col(c).alias(f"{c}_x") for c in ("pos", "rep", "g", "n")])
    y = shared.select("h", F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int").alias("salt"),
                      *[F.col(c).alias(f"{c}_y") for c in ("pos", "rep", "g", "n")])
    left = F.least(F.col("n_x") - F.col("pos_x"), F.col("n_y") - F.col("pos_y"))
    fits = (F.col("g_x") != F.col("g_y")) & (left * 100 >= (F.col("n_x") + F.col("n_y") - left) * percent)
    found = (x.join(y, ["h", "salt"]).filter(fits)
             .select(F.greatest("rep_x", "rep_y").alias("a"), F.least("rep_x", "rep_y").alias("b")).distinct())
    return _alike(found, reps, alike)


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``.

    Links texts with 100 * shared shingles >= percent * shingles of either.
    """
    docs = named_rows(docs, doc_id="long", text="string")
    width = rows_of_band(percent)
    rows = stored(docs.mapInArrow(lambda b: _features(b, width), _FEATURES), "features")
    linkable = F.col("n_shingles") > 0
    sets = rows.filter(linkable & F.col("doc_id").isNotNull())
    key = ["set_a", "set_b", "n_shingles"]
    classes = stored(sets.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"),
                                            F.first("bands").alias("bands")), "classes")
    member = stored(sets.select("doc_id", *key).join(classes.select("rep", *key), key)
                    .select("doc_id", "n_shingles", "rep"), "members")
    # an id seen with several sets ties their classes together
    ties = (member.groupBy("doc_id").agg(F.max("rep").alias("a"), F.min("rep").alias("b"))
            .filter("a > b").select("a", "b"))
    groups = links(docs, classes, ties, percent).withColumnRenamed("node", "rep")
    linked = member.join(groups, "rep", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    alone = rows.filter(~linkable | F.col("doc_id").isNull()).select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row, with all its columns, of each group of near-duplicates: the one with the least id.

    Of rows that repeat that id, the one with the least text stays. Rows without an id stay.
    """
    judged = near_duplicates(docs, percent)
    gone = stored(judged.filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct(),
                  "dropped")
    left = docs.join(small(gone), docs["doc_id"] == gone["gone_id"], "left_anti")
    again = stored(docs.groupBy(F.col("doc_id").alias("again_id")).agg(F.count("*").alias("rows"))
                   .filter("rows > 1 and again_id is not null").select("again_id"), "repeated-ids")
    if again.isEmpty():
        return left
    repeated = left.join(again, left["doc_id"] == again["again_id"], "left_semi")
    number = "row" + max(docs.columns, key=len)  # longer than any name that the table has
    first = (repeated.withColumn(number, F.row_number().over(
                 Window.partitionBy("doc_id").orderBy(
                     "text", F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])))))
             .filter(F.col(number) == 1).drop(number))
    return left.join(again, left["doc_id"] == again["again_id"], "left_anti").unionByName(first)
