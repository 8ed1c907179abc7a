"""Next-token statistics re-aimed from the model's objective (M1-M7).

Bigram counts over the training pairs, add-alpha conditional probabilities,
cross-entropy / perplexity, temperature softmax, Gumbel-max sampling, prompt
templates, context crop and completion slicing -- all as table operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tokloom.functions.pattern import SPECIAL_TOKENS
from tokloom.session import stored

MODEL_VOCAB = 32003          # 32,000 + 3 specials: the model's output width


def bigram_counts(pairs: DataFrame) -> DataFrame:
    """M1 counts: ``(x, y, c)`` from rows of (x, y); map-side partial counts."""
    return pairs.groupBy("x", "y").agg(F.count(F.lit(1)).alias("c"))


def window_pairs(xy_df: DataFrame) -> DataFrame:
    """Training pairs of every example: ``(x_t, y_t)`` rows."""
    z = F.arrays_zip(F.col("x").alias("x"), F.col("y").alias("y"))
    return xy_df.select(F.explode(z).alias("p")).select("p.x", "p.y")


def context_totals(bigrams: DataFrame) -> DataFrame:
    """``(x, c_x)``; at most one row per vocabulary id."""
    return bigrams.groupBy("x").agg(F.sum("c").cast("bigint").alias("c_x"))


def bigram_probs(bigrams: DataFrame, alpha: float = 1.0, vocab: int = MODEL_VOCAB) -> DataFrame:
    """M1: ``p = (c + alpha) / (c_x + alpha * V)``.

    The context table is bounded by the vocabulary, so it is broadcast.
    """
    bigrams, _ = stored(bigrams, "bigrams")
    ctx = context_totals(bigrams)
    return (bigrams.join(F.broadcast(ctx), "x")
            .withColumn("p", (F.col("c") + alpha) / (F.col("c_x") + alpha * vocab)))


def cross_entropy(pairs: DataFrame, bigrams: DataFrame, key: str = "conv_id",
                  alpha: float = 1.0, vocab: int = MODEL_VOCAB) -> DataFrame:
    """M2: ``(key, n, ce, ppl)`` -- mean ``-ln p`` of each chat's next-token pairs.

    Pairs are first counted per (key, x, y), so repeated pairs travel once; an
    unseen pair or context falls back to the add-alpha floor. The bigram table
    is stored once and its size decides between a broadcast and a shuffle join,
    whose hot pairs AQE splits; the context table is bounded by the vocabulary.
    """
    per = pairs.groupBy(key, "x", "y").agg(F.count(F.lit(1)).alias("m"))
    bigrams, _ = stored(bigrams.select("x", "y", "c"), "bigrams")      # the M1 table, built once
    ctx = context_totals(bigrams)
    j = per.join(bigrams, ["x", "y"], "left")
    j = j.join(F.broadcast(ctx), "x", "left")
    p = (F.coalesce(F.col("c"), F.lit(0)) + alpha) / (F.coalesce(F.col("c_x"), F.lit(0)) + alpha * vocab)
    return (j.groupBy(key)
            .agg(F.sum("m").cast("bigint").alias("n"),
                 (F.sum(-F.col("m") * F.log(p)) / F.sum("m")).alias("ce"))
            .withColumn("ppl", F.exp("ce")))


def temperature_softmax(df: DataFrame, score: str, group: list[str], T: float = 0.8,
                        out: str = "w") -> DataFrame:
    """M3: ``exp((s - max) / T) / sum(exp((s - max) / T))`` within each group.

    Two grouped aggregates (max, then the sum of exponentials) instead of a
    window, so a group of any size is reduced by partial aggregation rather than
    gathered into one task. The per-group table is stored, so its size decides
    the joins: while it is small enough to broadcast, the rows never move.
    """
    mx, _ = stored(df.groupBy(*group).agg(F.max(score).alias("_mx")), "group-max")
    each = F.exp((F.col(score) - F.col("_mx")) / T)
    tot, _ = stored(df.join(mx, group).groupBy(*group).agg(
        F.max("_mx").alias("_mx"), F.sum(each).alias("_se")), "group-sum")
    return (df.join(tot, group).withColumn(out, each / F.col("_se")).drop("_mx", "_se"))


def uniform_from_hash(key: Column, seed: int) -> Column:
    """Deterministic u in (0, 1) from md5 of ``key:seed`` (first 32 bits)."""
    h = F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("double") + 0.5) / float(1 << 32)


def gumbel_sample(df: DataFrame, item: str, score: str, group: list[str], T: float,
                  seed: int) -> DataFrame:
    """M4: one categorical draw per group by the Gumbel-max trick.

    ``max_by(item, s / T - ln(-ln u))`` is an ordinary aggregate, so a huge
    group is reduced by partial aggregation instead of being collected.
    """
    u = uniform_from_hash(F.concat_ws(":", *[F.col(g).cast("string") for g in group],
                                      F.col(item).cast("string")), seed)
    g = F.col(score) / T - F.log(-F.log(u))
    return df.groupBy(*group).agg(F.max_by(item, g).alias(item))


def chat_prompt(text: Column) -> Column:
    """M5 chat template: ``<HUMAN> {text}\\n<GPT> ``."""
    return F.concat(F.lit("<HUMAN> "), text, F.lit("\n<GPT> "))


def train_prompt(text: Column) -> Column:
    """M5 training-text template: ``<HUMAN>\\n{text}\\n<GPT>\\n``."""
    return F.concat(F.lit("<HUMAN>\n"), text, F.lit("\n<GPT>\n"))


def crop(ids: Column, L: int) -> Column:
    """M6: the last ``L`` ids (all of them when shorter)."""
    return F.slice(ids, F.greatest(F.lit(1), F.size(ids) - L + 1), L)


def completion(out_ids: Column, prompt_ids: Column) -> Column:
    """M7: ids after the prompt."""
    return F.slice(out_ids, F.size(prompt_ids) + 1, F.greatest(F.size(out_ids), F.lit(1)))


SPECIAL_WORDS = list(SPECIAL_TOKENS)
