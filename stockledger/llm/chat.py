"""Dialogues rendered once for each participant, who is the assistant there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockledger.llm.layout import PART, START, ordered

#: Fixed: the marks around a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Roles that give the setting and are no participants.
SETTING = ("system",)
#: Code points after which a rendered dialogue goes on in another part.
PART_CHARS = 1 << 20


def _segments(turns: DataFrame, setting: tuple[str, ...]) -> DataFrame:
    """One row for each turn and perspective with what it renders to and where its learned stretch lies."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit((1 << 63) - 1)).alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        # a mark inside a text would end its turn
        F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), r"<\|", "< |").alias("text"),
    )
    speakers = rows.where(~F.col("role").isin(*setting)).select("conv_id", F.col("role").alias("speaker")).distinct()
    own = F.col("role") == F.col("speaker")
    head = (
        F.when(F.col("role").isin(*setting), F.col("role"))
        .when(own, F.lit("assistant"))
        .otherwise(F.concat(F.lit("user name="), F.regexp_replace("role", r"\s", "_")))
    )
    return (
        rows.alias("t")
        .join(speakers.alias("s"), F.expr("t.conv_id <=> s.conv_id"))
        .select("t.conv_id", "t.turn", "t.role", "t.text", "s.speaker")
        .withColumn("head", F.concat(F.lit(OPEN), head, F.lit("\n")))
        .withColumn("learned", own)
        .withColumn("segment", F.concat("head", "text", F.lit(CLOSE + "\n")))
        .select(
            "conv_id",
            "speaker",
            "turn",
            "role",
            "segment",
            F.length("segment").cast("long").alias("size"),
            # the text and the mark that ends the turn are learned, the line feed is not
            F.when(F.col("learned"), F.length("head")).alias("from"),
            F.when(F.col("learned"), F.length("segment") - 1).alias("to"),
        )
    )


def rotate(turns: DataFrame, part_chars: int = PART_CHARS, setting: tuple[str, ...] = SETTING) -> DataFrame:
    """``conv_id, speaker, part, n_turns, text, spans``: every dialogue from the side of each participant.

    The speaker's turns are the assistant's, all others are a user's that is named by its role; the ``setting``
    roles stay what they are and have no perspective of their own. ``spans`` lists the learned stretches of
    ``text`` as ``(start, end)`` in code points: the speaker's words and the mark that ends them. Turns stand
    by number, then role, then text; a null turn comes last, a null role is ``unknown``, a null text empty, a
    null ``conv_id`` a dialogue of its own; repeated rows are repeated turns. A dialogue of setting roles only
    gives no row. Marks inside texts are broken up.

    A dialogue of more than ``part_chars`` goes on in another part, cut between turns, so that one with a
    third of all turns is not one row. Where each turn begins comes from running sums over a sorted table, not
    from a window over the dialogue.
    """
    line = ordered(_segments(turns, setting), ["conv_id", "speaker", "turn", "role", "segment"], "size", "turns")
    # one row for each partition
    earlier = W.orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    before = (
        line.groupBy(PART)
        .agg(F.sum("size").alias("n"))
        .select(PART, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    placed = line.join(F.broadcast(before), PART).withColumn("place", F.col("before") + F.col(START))
    begins = placed.groupBy("conv_id", "speaker").agg(F.min("place").alias("begin"))
    at = (
        placed.alias("p")
        .join(begins.alias("b"), F.expr("p.conv_id <=> b.conv_id and p.speaker = b.speaker"))
        .select("p.*", (F.col("place") - F.col("begin")).alias("offset"))
        .withColumn("part_no", F.floor(F.col("offset") / F.lit(part_chars)))
    )
    turn = F.struct("offset", F.col("segment"), F.col("from"), F.col("to"))
    grouped = at.groupBy("conv_id", "speaker", "part_no").agg(
        F.sort_array(F.collect_list(turn)).alias("turns"), F.min("offset").alias("begin")
    )
    return grouped.select(
        "conv_id",
        "speaker",
        F.col("part_no").cast("int").alias("part"),
        F.size("turns").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["segment"]), "").alias("text"),
        F.transform(F.filter("turns", lambda t: t["from"].isNotNull()), _span).alias("spans"),
    )


def _span(turn: Column) -> Column:
    begin = turn["offset"] - F.col("begin")
    return F.struct((begin + turn["from"]).alias("start"), (begin + turn["to"]).alias("end"))


def rendered(turns: DataFrame) -> DataFrame:
    """The rotated dialogues with their spans written as ``start-end,start-end``."""
    spans = F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string")))
    return rotate(turns).withColumn("mask", F.array_join(spans, ",")).drop("spans")
