"""Chat formatting by rotating the perspective (operator 5).

Every participant of a dialogue gets a view of it in which that speaker is the assistant, the others are users with
their names, and system turns stay as they are. A view is a row per turn: the rendered segment, where it stands in the
view's text, and which part of it is trained on (the assistant's text and end mark; nothing of other turns). All of it
is DataFrame operations. Offsets are running sums in two levels, over blocks of turns and inside a block, so that one
endless dialogue is spread over its blocks; the segments of a view are never gathered.

Defined results: a null role is the speaker `unknown`; other characters than letters, digits, `_` and `-` in a name
become `_`; a null text is empty; turns are ordered by turn (null first), speaker and text, and repeated rows are
turns of their own; rows with a null conv_id form one dialogue; a dialogue without participants (system only, or
empty) has no view; further columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def views(turns: DataFrame, block_turns: int = 256, start: str = START, end: str = END) -> DataFrame:
    """turns(conv_id, turn, role, text) -> conv_id, perspective, position, turn, speaker, segment, start, end,
    train_start, train_end (offsets in characters of the view; the latter two null where nothing is trained on)."""
    speaker = F.regexp_replace(F.coalesce("role", F.lit("unknown")), r"[^\p{L}\p{N}_-]", "_")
    said = turns.select(F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), speaker.alias("speaker"), F.coalesce("text", F.lit("")).alias("text"))
    said = said.withColumn("block", F.coalesce(F.floor(F.col("turn") / block_turns), F.lit(-(2**62))))
    people = said.where("speaker != 'system'").groupBy("conv", "speaker").agg(F.lit(1).alias("one")).select(F.col("conv").alias("of"), F.col("speaker").alias("perspective"))
    own = F.col("speaker") == F.col("perspective")
    header = F.concat(F.lit(start), F.when(own, "assistant").when(F.col("speaker") == "system", "system").otherwise(F.concat(F.lit("user name="), "speaker")), F.lit("\n"))
    seen = said.join(people, F.col("conv").eqNullSafe(F.col("of"))).drop("of").select("*", F.concat(header, "text", F.lit(end)).alias("segment"), F.length(header).cast("long").alias("lead"))
    seen = seen.withColumn("size", F.length("segment").cast("long"))
    key = ["conv", "perspective"]
    before = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0)).cast("long")
    over_blocks = Window.partitionBy(*key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = seen.groupBy(*key, "block").agg(F.sum("size").alias("chars"), F.count("*").alias("turns"))
    blocks = blocks.select(*(F.col(c).alias(f"b_{c}") for c in (*key, "block")), before("chars", over_blocks).alias("chars_before"), before("turns", over_blocks).alias("turns_before"))
    inside = Window.partitionBy(*key, "block").orderBy(F.asc_nulls_first("turn"), "speaker", "text")
    placed = seen.withColumn("nth", F.row_number().over(inside)).withColumn("offset", before("size", inside.rowsBetween(Window.unboundedPreceding, -1)))
    placed = placed.join(blocks, F.col("conv").eqNullSafe(F.col("b_conv")) & (F.col("perspective") == F.col("b_perspective")) & (F.col("block") == F.col("b_block")))
    at = F.col("chars_before") + F.col("offset")
    return placed.select(
        F.col("conv").alias("conv_id"), "perspective", (F.col("turns_before") + F.col("nth") - 1).cast("long").alias("position"), "turn", "speaker", "segment",
        at.alias("start"), (at + F.col("size")).alias("end"), F.when(own, at + F.col("lead")).alias("train_start"), F.when(own, at + F.col("size")).alias("train_end"),
    )
