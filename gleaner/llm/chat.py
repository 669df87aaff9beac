"""Chat formatting with cumulative-snapshot collapse.

Logs often hold every state of a growing conversation. A rolling hash of each turn prefix (128 bits:
four running sums of keyed turn hashes, so it is a plain window sum) finds the conversations that
are a prefix of a longer one; anti-joins drop them, equal conversations keep the smallest id, and
what is left is rendered.

Turns are ordered by (turn, content); repeated rows are turns of their own. Null role and text count
as empty; turns without a conversation id belong to none and are left out. A conversation is one
output string, so its turns fit a task by nature; conversations with common openings are never
gathered, as prefix keys are made distinct by partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.workspace import staged

_LANES = ["h1", "h2", "h3", "h4"]
KEY = ["n", *_LANES]


def _content(role: Column, text: Column) -> Column:
    """A digest of a turn; the role's length keeps role and text apart."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.md5(F.concat(F.length(role).cast("string"), F.lit("|"), role, text).cast("binary"))


def prefixes(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, n, h1..h4, n_turns): the hash of each conversation's first n turns."""
    slim = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), _content(F.col(role_col), F.col(text_col)).alias("content")
    )
    order = Window.partitionBy("conv").orderBy("turn", "content")
    slim = slim.withColumn("n", F.row_number().over(order))
    mixed = F.md5(F.concat(F.col("n").cast("string"), F.lit("|"), "content").cast("binary"))
    slim = slim.withColumn("mixed", mixed)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lane = lambda k: F.conv(F.substring("mixed", 8 * k + 1, 8), 16, 10).cast("long")
    slim = slim.withColumns({h: F.pmod(F.sum(lane(k)).over(upto), F.lit(1 << 32)) for k, h in enumerate(_LANES)})
    return slim.withColumn("n_turns", F.count("*").over(Window.partitionBy("conv"))).select("conv", *KEY, "n_turns")


def maximal(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, n_turns) of the conversations that no longer one begins with; equal ones once."""
    rows = staged(prefixes(turns, conv_col, turn_col, role_col, text_col), "prefixes")
    whole = rows.where("n = n_turns").groupBy(*KEY).agg(F.min("conv").alias("conv"))
    begun = rows.where("n < n_turns").select(*KEY).distinct()
    return whole.join(begun, KEY, "left_anti").select("conv", F.col("n").cast("long").alias("n_turns"))


def rendered(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, n_turns, rendered) of the maximal conversations, in the ``<|im_start|>`` chat format."""
    kept = staged(maximal(turns, conv_col, turn_col, role_col, text_col), "maximal")
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    piece = F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))
    pieces = turns.select(F.col(conv_col).alias("conv"), F.struct(F.col(turn_col), _content(F.col(role_col), F.col(text_col)), piece.alias("piece")).alias("turn"))
    met = pieces.join(kept, "conv")
    out = met.groupBy("conv", "n_turns").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return out.select(F.col("conv").alias(conv_col), "n_turns", F.array_join(F.col("turns.piece"), "").alias("rendered"))
