"""Chat flattening: turns -> tagged segments -> one text block per chat.

Block format: for each turn ``<ROLE>\\n{text}\\n`` in turn order, then the end
marker ``\\n<|endoftext|>\\n\\n``. Roles are mapped (``user``->``human``,
``assistant``->``gpt``) and upper-cased; an unmapped role keeps its name, so a
system turn becomes ``<SYSTEM>`` (not a special token).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tokloom.functions.pattern import END_MARKER

DEFAULT_ROLE_MAP = {"user": "human", "assistant": "gpt"}


def mapped_role(role: Column, role_map: dict[str, str] | None = None) -> Column:
    rm = DEFAULT_ROLE_MAP if role_map is None else role_map
    out = None
    for src, dst in rm.items():
        out = (F.when(role == F.lit(src), F.lit(dst)) if out is None
               else out.when(role == F.lit(src), F.lit(dst)))
    return role if out is None else out.otherwise(role)


def segment_expr(role: Column, text: Column, role_map: dict[str, str] | None = None) -> Column:
    """B1: ``<ROLE>\\n{text}\\n``; a null role or text counts as empty, so no turn is lost."""
    return F.concat(F.lit("<"), F.upper(F.coalesce(mapped_role(role, role_map), F.lit(""))),
                    F.lit(">\n"), F.coalesce(text, F.lit("")), F.lit("\n"))


def segments(turns: DataFrame, role_map: dict[str, str] | None = None) -> DataFrame:
    """B1 over a flat ``(conv_id, turn, role, text)`` table; narrow, no shuffle."""
    return turns.select("conv_id", "turn",
                        segment_expr(F.col("role"), F.col("text"), role_map).alias("seg"))


def blocks(turns: DataFrame, role_map: dict[str, str] | None = None) -> DataFrame:
    """One ``(conv_id, block)`` row per chat.

    A hash aggregate on ``conv_id``; the ordered concatenation runs inside the
    group (``listagg ... WITHIN GROUP``), so no global sort is needed. A chat is
    one output string, so its turns are necessarily one group.
    """
    return (segments(turns, role_map)
            .groupBy("conv_id")
            .agg(F.expr("listagg(seg, '') WITHIN GROUP (ORDER BY turn)").alias("body"))
            .select("conv_id", F.concat(F.col("body"), F.lit(END_MARKER)).alias("block")))


def blocks_in_order(turns: DataFrame, role_map: dict[str, str] | None = None) -> DataFrame:
    """D1 with the chats laid out in ``conv_id`` order (none first): the turns are shuffled by ranges of the key
    instead of its hash, which serves the grouping as well, so the order costs no further shuffle."""
    key = F.col("conv_id").asc_nulls_first()
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks(turns.repartitionByRange(n, key), role_map).sortWithinPartitions(key)


def blocks_from_nested(chats: DataFrame, role_map: dict[str, str] | None = None,
                       conv_col: str = "conversations") -> DataFrame:
    """D1 for nested records ``(conv_id, conversations array<struct<from,value>>)``.

    Pure projection: every chat already is one row, so nothing is shuffled.
    """
    body = F.array_join(
        F.transform(F.col(conv_col),
                    lambda t: segment_expr(t["from"], t["value"], role_map)), "")
    return chats.select("conv_id", F.concat(body, F.lit(END_MARKER)).alias("block"))


def fold_newlines(text: Column) -> Column:
    """Text-mode reading turns ``\\r\\n`` and lone ``\\r`` into ``\\n``."""
    return F.regexp_replace(text, "\r\n?", "\n")
