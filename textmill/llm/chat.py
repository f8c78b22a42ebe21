"""Chat formatting with collapse of cumulative snapshots, in DataFrame functions only.

Loggers often store a conversation again after every turn. A running hash over (place, role, text) of the turns
identifies every prefix; a conversation whose whole hash is a proper prefix of another is dropped by an
anti-join, equal conversations keep the smallest id, and only what stays is rendered. Texts are not shuffled
until then. Two independent 64-bit hashes make a key, so that equal keys stand for equal prefixes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def format_chats(turns: DataFrame, start: str = "<|im_start|>", end: str = "<|im_end|>") -> DataFrame:
    """turns(conv_id, turn, role, text) -> conv_id, n_turns, n_copies, rendered.

    A null role or text counts as empty, a null turn comes first, rows of the same turn follow in hash order,
    repeated rows are turns of their own, rows without conv_id form one conversation. Markers inside a text
    lose their bar ("<|" becomes "< |"), so that a text can't end its own turn. One conversation is one output
    row and must fit into one. Other columns are ignored.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.withColumns({"h": F.xxhash64("role", "text"), "g": F.xxhash64(F.lit(7), "text", "role", F.lit(11))})

    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "h", "g")
    at = rows.select("conv_id", "turn", "h", "g").withColumn("i", F.row_number().over(order))
    run = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = at.select(
        "conv_id", "i", F.count("*").over(Window.partitionBy("conv_id")).alias("n"),
        F.bit_xor(F.xxhash64("i", "h")).over(run).alias("p"), F.bit_xor(F.xxhash64("g", "i", F.lit(13))).over(run).alias("q"),
    )
    whole = at.where("i = n").groupBy("i", "p", "q").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    kept = whole.join(at.where("i < n").select("i", "p", "q").distinct(), ["i", "p", "q"], "left_anti")

    kept = kept.select(F.col("conv_id").alias("kept_id"), "n_copies")
    rows = rows.join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id")))
    lines = F.array_sort(F.collect_list(F.struct(F.coalesce("turn", F.lit(-(2**63))).alias("turn"), "h", "g", "role", "text")))
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    shown = F.transform("lines", lambda x: F.concat(F.lit(start), safe(x["role"]), F.lit("\n"), safe(x["text"]), F.lit(end + "\n")))
    out = rows.groupBy("conv_id").agg(lines.alias("lines"), F.first("n_copies").alias("n_copies"))
    return out.select("conv_id", F.size("lines").cast("long").alias("n_turns"), "n_copies", F.concat_ws("", shown).alias("rendered"))
