"""Chat formatting by multi-party perspective rotation, in DataFrame functions only.

Every participant of a conversation gets a rendering of the whole dialogue in which that participant is
the assistant and all others are users with their name. The mask holds the spans to be trained on: what
the assistant says and the end mark after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Turns numbered within one stretch of this length are rendered as one row, so that a row stays bounded
#: however long a conversation grows.
PART_TURNS = 256
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SYSTEM = "system"


def rotate(conversations: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """(conv_id, perspective, part, cut, n_turns, n_chars, text, mask) from conversations(conv_id, turn, role, text).

    role names the speaker; the role `system` is nobody's perspective and always rendered as system.
    Turns go by turn, ties by role and text; repeated rows are turns of their own. Part k holds turns
    k * part_turns to (k+1) * part_turns - 1, and the parts of a conversation in a row are its whole
    rendering; turns without a number come first, in part -1. A part of more than part_turns turns, because many have
    no number or one number, is cut after every part_turns of them. A null role speaks as `unknown`, a null text is
    empty, and rows with a null conv_id are one conversation. A conversation in which only the system speaks
    has no participant and no row. mask is an array of (start, end) in code points of text.
    Columns beyond the four are not looked at.
    """
    turns = conversations.select(
        "conv_id",
        F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-1)).cast("long").alias("part"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("said"),
    )
    # the same exchange serves the window and the aggregation
    place = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("said"))
    cut = turns.withColumn("cut", F.floor((place - 1) / part_turns).cast("long"))
    parts = cut.groupBy("conv_id", "part", "cut").agg(F.array_sort(F.collect_list("said")).alias("turns"))
    # who speaks in any part; one row for each speaker, conversation and part before the shuffle
    speakers = (
        turns.where(F.col("said.role") != SYSTEM)
        .groupBy("conv_id", F.col("said.role").alias("perspective"))
        .agg(F.count(F.lit(1)).alias("spoken"))
    )
    both = parts.join(speakers, parts.conv_id.eqNullSafe(speakers.conv_id)).drop(speakers.conv_id)

    def name(t):
        own, system = t["role"] == F.col("perspective"), t["role"] == SYSTEM
        return F.when(system, F.lit("system")).when(own, F.lit("assistant")).otherwise(F.concat(F.lit("user name="), t["role"]))

    segments = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(OPEN), name(t), F.lit("\n")).alias("head"),
            F.concat(t["text"], F.lit(CLOSE + "\n")).alias("body"),
            ((t["role"] == F.col("perspective")) & (t["role"] != SYSTEM)).alias("own"),
        ),
    )
    lengths = F.transform("segments", lambda s: F.length(s["head"]) + F.length(s["body"]))
    sized = both.withColumn("segments", segments).withColumn("ends", lengths)
    spans = F.aggregate(
        "segments",
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans")),
        lambda acc, s: F.struct(
            (acc["at"] + F.length(s["head"]) + F.length(s["body"])).alias("at"),
            F.when(
                s["own"],
                F.concat(
                    acc["spans"],
                    F.array(F.struct((acc["at"] + F.length(s["head"])).alias("start"), (acc["at"] + F.length(s["head"]) + F.length(s["body"])).alias("end"))),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return sized.select(
        "conv_id",
        "perspective",
        "part",
        "cut",
        F.size("turns").cast("long").alias("n_turns"),
        F.aggregate("ends", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_chars"),
        F.array_join(F.transform("segments", lambda s: F.concat(s["head"], s["body"])), "").alias("text"),
        spans.alias("mask"),
    )
