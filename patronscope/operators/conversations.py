"""Instruction examples from the turns of conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TURNS_PER_BLOCK = 1_000


def with_next_turn(
    turns: DataFrame, block: int = TURNS_PER_BLOCK, facts: DataFrame | None = None
) -> DataFrame:
    """Adds ``next_role`` and ``next_text``, those of the conversation's next turn number.

    Numbers may have gaps. A conversation is cut into blocks of ``block`` numbers; within
    one, the next turn comes from a window, and a block's last turn takes the first turn
    of the next block from a table with one row per block. So no conversation, however
    long, is one task. ``facts``, at most one row per conversation, comes along by
    the same table: its columns are added, NULL for other conversations.
    """
    turns = turns.withColumn("__block", F.floor(F.col("turn") / block))
    own = Window.partitionBy("conv_id", "__block").orderBy("turn")
    here = turns.withColumn("__next", F.lead(F.struct("role", "text")).over(own))
    firsts = turns.groupBy("conv_id", "__block").agg(
        F.min_by(F.struct("role", "text"), "turn").alias("__first")
    )
    blocks = Window.partitionBy("conv_id").orderBy("__block")
    following = firsts.select(
        "conv_id", "__block", F.lead("__first").over(blocks).alias("__following")
    )
    if facts is not None:
        following = following.join(facts, "conv_id", "left")
    after = F.coalesce("__next", "__following")
    return (
        here.join(following, ["conv_id", "__block"])
        .withColumns({"next_role": after["role"], "next_text": after["text"]})
        .drop("__block", "__next", "__following")
    )


def conversation_prompts(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, instruction, input, output``: a user turn and the answer to it.

    The answer is the next turn, if the assistant has it. ``input`` is the text of the
    conversation's first system turn, wherever that stands, or ''.
    """
    system = (
        turns.where(F.col("role") == "system")
        .groupBy("conv_id")
        .agg(F.min_by("text", "turn").alias("system_text"))
    )
    answered = with_next_turn(turns, facts=system).where(
        (F.col("role") == "user") & (F.col("next_role") == "assistant")
    )
    return answered.select(
        "conv_id",
        "turn",
        F.col("text").alias("instruction"),
        F.coalesce("system_text", F.lit("")).alias("input"),
        F.col("next_text").alias("output"),
    )
