"""Collapse of logged conversation snapshots, and rendering.

A conversation that is logged after every turn leaves many snapshots, each a
prefix of the next. A rolling hash names every prefix of every conversation; a
conversation whose whole is a prefix of another is dropped by an anti-join,
and of equal conversations the one with the least id stays. What is left is
rendered as chat text.

Conversations are handled in stretches of turns, so that one of any length is
spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage

#: Turns of a stretch: hashed in one window, rendered as one part.
STRETCH = 256

# The marks around each turn.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"

_PRINT = ["n", "h1", "h2"]


def _turn_hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.sha2(F.concat_ws("\0", F.col("turn").cast("string"), "role", "text"), 256))


def clean_turns(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv_id, turn, role, text): distinct turns, roles trimmed and lower-cased, NULL texts empty, NULL roles ``unknown``.

    Rows without a conversation id belong to no conversation and are left out;
    a NULL turn stands before all others, as turn -1.
    """
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.coalesce(F.col(turn_col).cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce(F.lower(F.trim(F.col(role_col).cast("string"))), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    return rows.distinct()


def prefix_hashes(turns: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """(conv_id, turn, n, h1, h2, last): size and hash of each conversation up to each of its turns.

    The hash joins the hashes of all turns so far, each with its number, so it
    can be summed up stretch by stretch. Several rows of one turn count together.
    """
    hashed = turns.select(
        "conv_id", "turn", F.floor(F.col("turn") / stretch).alias("stretch"), _turn_hash(1).alias("h1"), _turn_hash(2).alias("h2")
    )
    # Several rows of one turn become one.
    steps = hashed.groupBy("conv_id", "stretch", "turn").agg(
        F.count("*").alias("n"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2")
    )
    steps = cut_lineage(steps)
    inside = Window.partitionBy("conv_id", "stretch").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    totals = steps.groupBy("conv_id", "stretch").agg(
        F.sum("n").alias("n"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"), F.max("turn").alias("end")
    )
    starts = totals.select(
        "conv_id",
        "stretch",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
        F.coalesce(F.bit_xor("h1").over(before), F.lit(0)).alias("g1"),
        F.coalesce(F.bit_xor("h2").over(before), F.lit(0)).alias("g2"),
        F.max("end").over(Window.partitionBy("conv_id")).alias("end"),
    )
    rolled = steps.select(
        "conv_id",
        "stretch",
        "turn",
        F.sum("n").over(inside).alias("n"),
        F.bit_xor("h1").over(inside).alias("h1"),
        F.bit_xor("h2").over(inside).alias("h2"),
    )
    return rolled.join(starts, ["conv_id", "stretch"]).select(
        "conv_id",
        "turn",
        (F.col("n") + F.col("n0")).alias("n"),
        F.col("h1").bitwiseXOR(F.col("g1")).alias("h1"),
        F.col("h2").bitwiseXOR(F.col("g2")).alias("h2"),
        (F.col("turn") == F.col("end")).alias("last"),
    )


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies): conversations that no other continues; the least id of equal ones."""
    # Equal conversations, and equal prefixes, are taken together before they meet.
    whole = prefixes.where("last").groupBy(*_PRINT).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    continued = prefixes.where(~F.col("last")).select(*_PRINT).distinct()
    return whole.join(continued, _PRINT, "left_anti").select("conv_id", F.col("n").alias("n_turns"), "copies")


def render(turns: DataFrame, kept: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """(conv_id, part, n_turns, n_rendered, copies, rendered): chat text of the kept conversations.

    A part holds the turns of one stretch; conversations of fewer turns have one
    part. ``n_turns`` counts the whole conversation, ``n_rendered`` the part.
    Turns of equal number follow each other by role and text.
    """
    text = F.concat(F.lit(OPEN), F.col("role"), F.lit(MIDDLE), F.col("text"), F.lit(CLOSE))
    part = F.floor(F.greatest(F.col("turn"), F.lit(0)) / stretch)
    rows = turns.join(kept, "conv_id").select("conv_id", "n_turns", "copies", part.alias("part"), "turn", "role", text.alias("line"))
    lines = F.array_sort(F.collect_list(F.struct("turn", "role", "line")))
    return (
        rows.groupBy("conv_id", "part", "n_turns", "copies")
        .agg(F.count("*").alias("n_rendered"), F.array_join(F.transform(lines, lambda x: x["line"]), "").alias("rendered"))
        .select("conv_id", "part", "n_turns", "n_rendered", "copies", "rendered")
    )


def collapse_and_render(conversations: DataFrame, stretch: int = STRETCH, **columns: str) -> DataFrame:
    """Maximal conversations of a log as chat text; see ``clean_turns``, ``maximal_conversations`` and ``render``.

    An empty log gives no rows; columns other than the four named ones take no part.
    """
    turns = cut_lineage(clean_turns(conversations, **columns))
    kept = cut_lineage(maximal_conversations(prefix_hashes(turns, stretch)))
    return render(turns, kept, stretch)
