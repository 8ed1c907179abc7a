"""Byte-pair-encoding training on the distinct-word frequency table.

State: ``(sym, n, first_pos)`` -- one row per distinct word, ``sym`` one
character per symbol (see ``functions.symbols``). Each round is a small Spark
job: pair statistics (D3, an exploded hash aggregate), the best pair(s) (F1, a
top-k), and the native ``replace`` merge (H2). Only the chosen pairs (a few
rows) reach the driver; the merge table it accumulates is bounded by the
vocabulary size.

Order semantics: the best pair has the largest weighted count; ties go to the
pair seen first -- earliest word by first occurrence, then leftmost position.

Batched rounds (exact): after taking the best pair ``(a, b)``, the next pair in
order is also final if it shares no symbol with any accepted pair and its count
is strictly above every count a new symbol could reach, which is at most the
largest count of a pair ending in ``a`` or starting with ``b``. Every pair that
could block candidate ``j`` has a count >= ``c_j`` and so is inside the sorted
top-``k`` list (unless the list ends in a tie at ``c_j``, which stops the
round) -- one aggregation and one top-k per round decide the whole batch.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tokloom.functions.pattern import BASE_BYTES, DEFAULT_VOCAB_SIZE, SPECIAL_TOKENS
from tokloom.functions.symbols import MAX_SYMBOL_ID, char_id, id_char
from tokloom.operators.scan import global_row_number, quantile_buckets
from tokloom.session import drop_stored, stored

MERGE_SCHEMA = T.StructType([
    T.StructField("rank", T.IntegerType()),
    T.StructField("left", T.IntegerType()),
    T.StructField("right", T.IntegerType()),
    T.StructField("new_id", T.IntegerType()),
    T.StructField("c", T.LongType()),
])


def pair_stats(state: DataFrame, wide: bool = True) -> DataFrame:
    """D3: ``(p, c, first, left, right)`` over adjacent symbol pairs.

    Overlaps count (``aaa`` has two ``aa``). Words of one symbol are filtered
    before ``sequence`` (which would otherwise count down). ``first`` is the
    exact key ``wrank * 2^31 + i`` (first word, then leftmost position), so
    both aggregates stay hash-based with map-side combine. It is a ``bigint``
    when ``wide`` is false (valid while ``wrank < 2^32``), else a
    ``DECIMAL(38,0)``.
    """
    multi = state.filter(F.length("sym") > 1)
    occ = multi.select("n", "wrank", "sym",
                       F.explode(F.sequence(F.lit(1), F.length("sym") - 1)).alias("i"))
    if wide:
        d = "decimal(38,0)"
        at = (F.col("wrank").cast(d) * F.lit(1 << 31).cast(d) + F.col("i").cast(d)).cast(d)
    else:
        at = F.col("wrank").cast("bigint") * F.lit(1 << 31) + F.col("i")
    occ = occ.select(F.substring("sym", F.col("i"), 2).alias("p"), "n", at.alias("at"))
    return (occ.groupBy("p")
            .agg(F.sum("n").cast("bigint").alias("c"), F.min("at").alias("first"))
            .withColumn("left", char_id(F.substring("p", 1, 1)))
            .withColumn("right", char_id(F.substring("p", 2, 1))))


def best_pairs(stats: DataFrame, k: int = 1) -> DataFrame:
    """the first ``k`` pairs in (count desc, first seen asc) order."""
    return stats.orderBy(F.desc("c"), F.asc("first")).limit(k)


def apply_merges(sym, merges: list[tuple[int, int, int]]):
    """H2: ordered native replacements (greedy, left-to-right, non-overlapping)."""
    for a, b, new in merges:
        sym = F.replace(sym, F.lit(id_char(a) + id_char(b)), F.lit(id_char(new)))
    return sym


def training_state(freq: DataFrame, exclude_special: bool = False,
                   specials: dict[str, int] | None = None) -> DataFrame:
    """Frequency table -> BPE state ``(word, sym, n, first_pos, wrank)``.

    ``wrank`` is the dense first-occurrence rank of each distinct word (a
    two-phase global row number, no single-task sort). Specials count as
    ordinary words unless excluded.
    """
    st = freq
    if exclude_special:
        st = st.filter(~F.col("word").isin(list((specials or SPECIAL_TOKENS).keys())))
    st = st.select("word", "sym", "n", "first_pos")
    return global_row_number(quantile_buckets(st, "first_pos"), ["first_pos"], "wrank")


def choose_batch(rows, room: int, complete: bool) -> list:
    """Longest prefix of the sorted candidates that strict rounds would also pick.

    ``rows`` are the top pairs in (count desc, first asc) order; ``complete``
    says the list holds every pair. Candidate ``j`` is accepted when it shares
    no symbol with an accepted pair, and no listed pair with count >= ``c_j``
    ends in an accepted left symbol or starts with an accepted right symbol.
    """
    chosen, used, lefts, rights = [], set(), set(), set()
    for j, r in enumerate(rows):
        if len(chosen) >= room:
            break
        if chosen:
            c = r["c"]
            if r["left"] in used or r["right"] in used:
                break
            if not complete and rows[-1]["c"] >= c:
                break
            if any(p["c"] >= c and (p["right"] in lefts or p["left"] in rights)
                   for p in rows):
                break
        chosen.append(r)
        used.update((r["left"], r["right"]))
        lefts.add(r["left"])
        rights.add(r["right"])
    return chosen


@dataclass
class TrainResult:
    merges: list[tuple[int, int, int, int]] = field(default_factory=list)   # (a, b, new, c)
    rounds: int = 0
    state: DataFrame | None = None

    def merge_table(self, spark: SparkSession) -> DataFrame:
        rows = [(r, a, b, new, c) for r, (a, b, new, c) in enumerate(self.merges)]
        return spark.createDataFrame(rows, MERGE_SCHEMA)


def train(state: DataFrame, num_merges: int | None = None, vocab_size: int = DEFAULT_VOCAB_SIZE,
          n_special: int = len(SPECIAL_TOKENS), batched: bool = True, candidates: int = 64,
          checkpoint_every: int = 16, progress=None) -> TrainResult:
    """H1: learn up to ``num_merges`` merges (default ``vocab_size - 256 - n_special``).

    Stops early when no pair is left. Lineage is cut by writing the state to
    the checkpoint folder once ``checkpoint_every`` replacements have been
    chained, and the state before it is deleted, so at most two are alive; at
    each cut, words already reduced to one symbol leave the working state
    (``TrainResult.state`` therefore holds only the still-divisible words).
    """
    spark = state.sparkSession
    limit = vocab_size - BASE_BYTES - n_special if num_merges is None else num_merges
    if BASE_BYTES + limit - 1 > MAX_SYMBOL_ID:
        raise ValueError("vocabulary too large for one-character symbols")
    res = TrainResult()
    cur, path = stored(state.select("word", "sym", "n", "first_pos", "wrank")
                       .filter(F.length("sym") > 1), "bpe-state")
    max_rank = cur.agg(F.max("wrank")).first()[0] or 0
    wide = max_rank >= (1 << 32)          # bigint position keys while they fit
    pending = 0
    while len(res.merges) < limit:
        k = candidates if batched else 1
        rows = (best_pairs(pair_stats(cur, wide), k)
                .select("left", "right", "c", "first").collect())
        if not rows:
            break
        rows.sort(key=lambda r: (-r["c"], r["first"]))
        chosen = choose_batch(rows, limit - len(res.merges), complete=len(rows) < k)
        step = []
        for r in chosen:
            new_id = BASE_BYTES + len(res.merges)
            res.merges.append((r["left"], r["right"], new_id, r["c"]))
            step.append((r["left"], r["right"], new_id))
        res.rounds += 1
        cur = cur.withColumn("sym", apply_merges(F.col("sym"), step))
        pending += len(step)
        if pending >= checkpoint_every:
            # words that became one symbol can never form a pair again
            old = path
            cur, path = stored(cur.filter(F.length("sym") > 1), "bpe-state")
            drop_stored(spark, old)
            pending = 0
        if progress is not None:
            progress(res.rounds, len(res.merges))
    res.state = cur
    return res


def merge_list(merges) -> list[tuple[int, int, int]]:
    """Merge table as a driver list; refuses anything beyond the symbol id space."""
    if isinstance(merges, DataFrame):
        rows = (merges.select("rank", "left", "right", "new_id").orderBy("rank")
                .limit(MAX_SYMBOL_ID + 2).collect())
        if len(rows) > MAX_SYMBOL_ID + 1:
            raise ValueError("merge table larger than the symbol id space")
        return [(r["left"], r["right"], r["new_id"]) for r in rows]
    return [tuple(m[:3]) for m in merges]


def vocabulary(spark: SparkSession, merges: DataFrame | list[tuple[int, int, int]],
               specials: dict[str, int] | None = None, first_byte: int = 0) -> DataFrame:
    """G1/H3: ``(id, bytes)`` = 256 single bytes + merged byte strings + specials.

    ``first_byte`` is the id of byte 0 (the byte-level variant has its specials first).

    The byte string of merge ``new = a + b`` is built by one ordered pass over
    the merge list on the driver: the merge table is model metadata bounded by
    the symbol id space, not corpus data.
    """
    ms = merge_list(merges)
    vocab = {first_byte + i: bytes([i]) for i in range(BASE_BYTES)}
    for a, b, new in ms:
        vocab[new] = vocab[a] + vocab[b]
    for tok, i in (specials or SPECIAL_TOKENS).items():
        vocab[i] = tok.encode("utf-8")
    schema = T.StructType([T.StructField("id", T.IntegerType()),
                           T.StructField("bytes", T.BinaryType())])
    return spark.createDataFrame(sorted(vocab.items()), schema)
