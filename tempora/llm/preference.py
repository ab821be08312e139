"""Preference formatting: chosen and rejected conversations become one prompt and two masked completions.

A pair's conversations are compared turn by turn with joins and counts, so that no conversation is gathered into one
row or task: the result has one row per rendered turn. The longest common prefix of turns is rendered once, as
the prompt; what follows it is the completion of either side. Completions are to be learned from where an assistant speaks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tempora.llm.common import stored

#: The marks around a turn.
START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
#: Turn numbers of one part of a conversation, which is numbered in one task.
PART = 4096


def placed_turns(turns: DataFrame) -> DataFrame:
    """(conv, place, role, text): turns numbered from 0 by (turn, role, text), nulls first.

    Turn numbers are cut into parts, parts are counted, and turns are numbered inside their part: a conversation of any
    length is not ordered in one task unless its turns share their numbers.
    """
    kept = turns.select(F.col("conv_id").alias("conv"), F.col("turn").alias("__turn"), "role", "text").where(F.col("conv").isNotNull())
    kept = kept.withColumn("__part", F.coalesce(F.floor(F.col("__turn") / PART), F.lit(-(1 << 62))))
    sizes = kept.groupBy("conv", "__part").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("conv").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("conv").alias("__c"), F.col("__part").alias("__p"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("conv", "__part").orderBy("__turn", "role", "text")
    numbered = kept.withColumn("__row", F.row_number().over(inside) - 1)
    # Nearly all conversations have one part, which needs no offset.
    later = starts.where(F.col("__start") > 0)
    joined = numbered.join(later, (F.col("conv") == F.col("__c")) & (F.col("__part") == F.col("__p")), "left")
    return joined.select("conv", (F.col("__row") + F.coalesce("__start", F.lit(0))).cast("long").alias("place"), "role", "text")


def render(role: Column, text: Column) -> Column:
    """A turn between its marks; null roles and texts are empty."""
    return F.concat(F.lit(START), F.coalesce(role, F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit(END + "\n"))


def format_pairs(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """(pair_id, section, place, role, rendered, learn, n_prompt), one row per rendered turn.

    ``turns``: conv_id, turn, role, text. ``pairs``: pair_id, chosen_id, rejected_id, each pair_id once. Section is prompt,
    chosen or rejected, place the turn's place in its conversation from 0, n_prompt the turns of the pair's prompt. Two turns
    are equal if roles and texts are (null equals null). Prompt rows come from the chosen side and are never learned from;
    completion rows are where the role is assistant. Equal conversations give a prompt alone. A side that is null or
    has no turns gives no rows, and the other side is then all completion. Turns of a null conv_id or of no pair are left
    out; repeated turns are turns; turns that share a number are ordered by role and text. A conversation may be part
    of several pairs.
    """
    sides = [pairs.select("pair_id", F.lit(side).alias("side"), F.col(f"{side}_id").alias("of")) for side in ("chosen", "rejected")]
    asked = sides[0].unionByName(sides[1]).where(F.col("of").isNotNull())
    placed = stored(asked.join(placed_turns(turns), F.col("of") == F.col("conv")).select("pair_id", "side", "place", "role", "text"), "pair-turns")
    digest = F.sha2(F.concat_ws("|", F.coalesce(F.length("role"), F.lit(-1)), F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.length("text"), F.lit(-1)), F.coalesce(F.col("text"), F.lit(""))), 256)
    # A place differs unless both sides hold the same turn there; the prompt ends at the first that differs.
    places = placed.groupBy("pair_id", "place").agg(F.count("*").alias("n"), F.min(digest).alias("lo"), F.max(digest).alias("hi"))
    differs = (F.col("n") < 2) | (F.col("lo") != F.col("hi"))
    prompts = places.groupBy("pair_id").agg(F.coalesce(F.min(F.when(differs, F.col("place"))), F.max("place") + 1).alias("n_prompt"))
    cut = placed.join(stored(prompts, "pair-prompts"), "pair_id")
    shared = F.col("place") < F.col("n_prompt")
    return cut.where(~shared | (F.col("side") == "chosen")).select(
        "pair_id",
        F.when(shared, "prompt").otherwise(F.col("side")).alias("section"),
        "place",
        "role",
        render(F.col("role"), F.col("text")).alias("rendered"),
        (~shared & F.coalesce(F.col("role") == ASSISTANT, F.lit(False))).alias("learn"),
        "n_prompt",
    )


def neighbour_pairs(turns: DataFrame) -> DataFrame:
    """Pairs of conversations 2k (chosen) and 2k + 1 (rejected): stands in for a table of preferences."""
    ids = turns.select("conv_id").where(F.col("conv_id").isNotNull()).distinct()
    even = F.col("conv_id") % 2 == 0
    return ids.groupBy(F.floor(F.col("conv_id") / 2).alias("pair_id")).agg(
        F.max(F.when(even, F.col("conv_id"))).alias("chosen_id"), F.max(F.when(~even, F.col("conv_id"))).alias("rejected_id")
    )
