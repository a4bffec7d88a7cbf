"""Chat formatting of logged conversations, in DataFrame operations only.

A chat log often holds a conversation again at every turn: each snapshot prefixes the next.  Every turn gets the
rolling hash of the turns up to it; a conversation whose whole hash is some longer conversation's hash at that turn is
a prefix of it and goes (anti-join), and of equal conversations the one with the smallest id stays.  The others are
rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.common import ordinal_within
from .common import saved

# Turns in one part of a rendered conversation, and in one window of rolling hashes.
PART_TURNS = 256


def chatml(role: Column, text: Column) -> Column:
    """One turn in ChatML; a null role reads "unknown", a null text is empty."""
    return F.concat(F.lit("<|im_start|>"), F.coalesce(role, F.lit("unknown")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit("<|im_end|>\n"))


def _hashes(seed: int) -> Column:
    known = [F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit(""))]
    return F.xxhash64(F.lit(seed), "pos", *known)


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv, pos, role, text, h1, h2, total) with ``pos`` from 0 and the rolling hash of the turns up to each: an XOR
    of hashes that hold their places.  Windows cover at most PART_TURNS turns; longer conversations add the hashes of
    their earlier windows, so no conversation's turns meet in one task."""
    at = turns.withColumn("part", F.floor(F.col("pos") / PART_TURNS)).withColumn("x1", _hashes(1)).withColumn("x2", _hashes(2))
    parts = at.groupBy("conv", "part").agg(F.expr("bit_xor(x1)").alias("p1"), F.expr("bit_xor(x2)").alias("p2"), F.count(F.lit(1)).alias("n"))
    by_conv = Window.partitionBy("conv")
    before = by_conv.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv", "part", *[F.coalesce(F.expr(f"bit_xor({c})").over(before), F.lit(0)).alias(c) for c in ("p1", "p2")],
                         F.sum("n").over(by_conv).alias("total"))
    inside = Window.partitionBy("conv", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rolled = at.select("conv", "part", "pos", "role", "text", *[F.expr(f"bit_xor({c})").over(inside).alias(c) for c in ("x1", "x2")])
    return (rolled.join(parts, ["conv", "part"])
            .select("conv", "part", "pos", "role", "text", F.col("x1").bitwiseXOR(F.col("p1")).alias("h1"),
                    F.col("x2").bitwiseXOR(F.col("p2")).alias("h2"), "total"))


def format_chats(chats: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """(conv_id, part, n_turns, rendered): the maximal conversations in ChatML, in parts of PART_TURNS turns (part 0
    alone for shorter ones; the parts in order are the whole conversation).  ``n_turns`` counts the conversation's.

    Turns stand in order of (turn, role, text), nulls first; a row logged twice (equal in all four columns) counts
    once.  Rows with a null conversation id belong to no conversation and are left out.  Null roles and texts take
    part as such: they equal each other and nothing else.  An empty table gives an empty result; other columns are
    not carried."""
    rows = (chats.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"),
                         F.col(text_col).cast("string").alias("text")).where("conv is not null").distinct())
    turns = ordinal_within(rows, ["conv"], ["turn", "role", "text"], "ord").select("conv", (F.col("ord") - 1).alias("pos"), "role", "text")
    turns = saved(prefix_hashes(turns))
    length = F.col("total") - 1
    whole = turns.where(F.col("pos") == length).select("conv", "pos", "h1", "h2")
    inner = turns.where(F.col("pos") < length).select("pos", "h1", "h2").distinct()
    longest = whole.join(inner, ["pos", "h1", "h2"], "left_anti")
    kept = longest.groupBy("pos", "h1", "h2").agg(F.min("conv").alias("conv")).select("conv")
    turn = F.struct("pos", chatml(F.col("role"), F.col("text")).alias("s"))
    return (turns.join(kept, "conv", "left_semi").groupBy("conv", "part")
            .agg(F.max("total").alias("n_turns"), F.array_join(F.array_sort(F.collect_list(turn))["s"], "").alias("rendered"))
            .select(F.col("conv").alias(conv_col), F.col("part").cast("long").alias("part"), "n_turns", "rendered"))
