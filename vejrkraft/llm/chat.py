"""Chat formatting: multi-party perspective rotation, in DataFrame functions only.

Each participant of a conversation sees the dialogue from its own side: its turns are the
assistant's and are learnt from, the others are named users and are masked out. The result has one row per
conversation, perspective and turn, so a conversation of any length is never gathered in one row or task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN_START, TURN_END = "<|turn|>", "<|end|>"
UNNAMED = "unknown"


def _safe(text: Column) -> Column:
    """The markers of a turn cannot be forged by a text: their bars are doubled."""
    return F.replace(F.replace(text, F.lit("<|"), F.lit("<||")), F.lit("|>"), F.lit("||>"))


def rotate_perspectives(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    speaker_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation, participant and turn.

    conv_id, perspective (the participant), turn, speaker, chat_role (``assistant`` for the
    perspective's own turns, else ``user``), name (null for the assistant), rendered (the piece of the dialogue:
    header, text and end marker), mask_start and mask_length (code points of ``rendered`` that are learnt
    from: text and end marker of the assistant's turns, none of a user's).

    A perspective's dialogue is its ``rendered`` pieces in order of ``turn``; pieces of equal turns
    follow each other by speaker, then text. A null speaker is the participant ``unknown``, a null text
    is empty, rows without a conversation form one conversation, a null turn stands first. Repeated rows
    are turns of their own. Markers inside a text get a second bar. Other columns are not read.
    """
    speaker = F.coalesce(F.col(speaker_col).cast("string"), F.lit(UNNAMED))
    spoken = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        speaker.alias("speaker"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    # Participants are counted before the shuffle; a conversation that holds a third of all turns is one
    # key of a join whose turns Spark can split.
    people = spoken.groupBy(F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective")).agg(
        F.count(F.lit(1)).alias("own_turns")
    )
    own = F.col("speaker") == F.col("perspective")
    header = F.when(own, F.concat(F.lit(TURN_START), F.lit("assistant\n"))).otherwise(
        F.concat(F.lit(TURN_START), F.lit("user name="), _safe(F.col("speaker")), F.lit("\n"))
    )
    body = F.concat(_safe(F.col("text")), F.lit(TURN_END))
    return (
        spoken.join(people, F.col("conv_id").eqNullSafe(F.col("_conv")))
        .select(
            "conv_id",
            "perspective",
            "turn",
            "speaker",
            F.when(own, "assistant").otherwise("user").alias("chat_role"),
            F.when(~own, F.col("speaker")).alias("name"),
            F.concat(header, body, F.lit("\n")).alias("rendered"),
            F.when(own, F.length(header)).otherwise(0).cast("long").alias("mask_start"),
            F.when(own, F.length(body)).otherwise(0).cast("long").alias("mask_length"),
        )
    )
