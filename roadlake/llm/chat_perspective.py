"""Chat formatting: multi-party perspective rotation, in DataFrame functions only.

For every participant of a conversation the dialogue is rendered once with that speaker as the assistant and the
others as named users. The result has one row per (conversation, speaker, turn), so a conversation of any length
is never gathered into one task; start/end give each message's place in the rendered dialogue, by sums over blocks of
turns and then within a block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Roles that give instructions to all speakers: rendered as system, never a perspective.
SYSTEM_ROLES = ("system",)
#: Turns in a block of the two-level sums.
BLOCK = 256


def rotate_perspectives(turns: DataFrame, system_roles: tuple[str, ...] = SYSTEM_ROLES, block: int = BLOCK) -> DataFrame:
    """conv_id, turn, role, text -> conv_id, speaker, turn, role, name, content, rendered, mask, start, end.

    mask is 1 on the speaker's own messages (content and closing mark carry loss), else 0.
    content_start is where the loss begins in the dialogue.

    Nulls: rows with a null conv_id or role belong to no dialogue and are left out; a null text is an empty message;
    a null turn comes first. Equal turns are ordered by role, then text; equal rows stay, one message each. A dialogue that
    has system messages alone has no participant and so no rows. Other columns are ignored.
    """
    said = turns.filter(F.col("conv_id").isNotNull() & F.col("role").isNotNull()).select("conv_id", "turn", F.col("role").alias("author"), F.coalesce("text", F.lit("")).alias("content"))
    is_system = F.col("author").isin(*system_roles)
    speakers = said.filter(~is_system).select("conv_id", F.col("author").alias("speaker")).distinct()
    seen = said.join(speakers, "conv_id")
    own = F.col("author") == F.col("speaker")
    role = F.when(is_system, F.lit("system")).when(own, F.lit("assistant")).otherwise(F.lit("user"))
    name = F.when(~is_system & ~own, F.col("author"))
    head = F.concat(F.lit("<|"), role, F.when(name.isNotNull(), F.concat(F.lit(" name="), name)).otherwise(F.lit("")), F.lit("|>\n"))
    made = seen.select(
        "conv_id", "speaker", "turn", "author", role.alias("role"), name.alias("name"), "content",
        F.concat(head, F.col("content"), F.lit("<|end|>\n")).alias("rendered"), F.length(head).alias("n_head"),
        (own & ~is_system).cast("int").alias("mask"), F.floor(F.col("turn") / block).alias("block"),
    )
    # Lengths of whole blocks come first: a small table with one row per block of a perspective.
    sums = made.groupBy("conv_id", "speaker", "block").agg(F.sum(F.length("rendered")).alias("block_chars"))
    before = sums.select("conv_id", "speaker", "block", (F.sum("block_chars").over(W.partitionBy("conv_id", "speaker").orderBy(F.col("block").asc_nulls_first())) - F.col("block_chars")).alias("before"))
    placed = made.alias("m").join(before.alias("b"), (F.col("m.conv_id") == F.col("b.conv_id")) & (F.col("m.speaker") == F.col("b.speaker")) & F.col("m.block").eqNullSafe(F.col("b.block"))).select("m.*", "b.before")
    inside = W.partitionBy("conv_id", "speaker", "block").orderBy(F.col("turn").asc_nulls_first(), "author", "content").rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.col("before") + F.sum(F.length("rendered")).over(inside)
    return placed.withColumn("end", end).select(
        "conv_id", "speaker", "turn", "role", "name", "content", "rendered", "mask",
        (F.col("end") - F.length("rendered")).alias("start"), (F.col("end") - F.length("rendered") + F.col("n_head")).alias("content_start"), "end",
    )
