"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Sources, in order of code point with null last, get the weights in turn and share the words of all
documents by weight; no target exceeds ``repeats`` times its source's words, and what is cut off is
shared by weight among the others (water filling). Each source's documents, shuffled by a hash of
their ids, form a stream that is cut into blocks of equal words. The schedule maps the points of the
golden-ratio sequence through the sources' cumulative weights (their targets, in blocks) to sources
and ranks the slots of each source; slot j takes block j mod (blocks) in pass j div (blocks). So a
source's number of slots, and the order of all, come from the sequence: the slots differ from the
target by its discrepancy, a few blocks (a logarithm of the schedule's length). Slots beyond ``repeats``
passes are left empty. Blocks have ``block`` words, fewer in a corpus of less than ``least_slots`` of
them, so that a few blocks are little of any target.

Null text, and text without words, has size 0 and is never taken. Long texts span many blocks. Repeated
rows are documents of their own. An empty table gives an empty result. Columns of ``docs`` besides
the three named ones may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.workspace import alone, staged
from gleaner.operators.running import running_total

_GOLDEN = 2654435769  # odd, nearest 2^32 / golden ratio: points k * this mod 2^32
_SPAN = 1 << 32


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), repeats: int = 3) -> DataFrame:
    """(source, source_size, sid, weight, target) from (source, source_size), one row per source.

    One row per source meets in one task here; documents never do.
    """
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    out = sizes.withColumn("sid", (F.row_number().over(by_name) - 1).cast("long"))
    turn = F.array(*[F.lit(w) for w in weights])
    out = out.withColumn("weight", F.element_at(turn, (F.col("sid") % len(weights) + 1).cast("int")))
    out = out.withColumns({"cap": F.col("source_size") * repeats, "words": F.sum("source_size").over(every)})
    # In order of cap / weight, the first source whose share is within its cap ends the capped ones.
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("words") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    out = out.withColumns({"rate": left / weight_left, "rank": F.row_number().over(by_ratio)})
    fits = F.when(F.col("rate") * F.col("weight") <= F.col("cap"), F.struct("rank", "rate"))
    out = out.withColumn("first", F.min(fits).over(every))
    target = F.when(F.col("rank") < F.col("first.rank"), F.col("cap").cast("double")).otherwise(F.col("first.rate") * F.col("weight"))
    return out.select("source", "source_size", "sid", "weight", target.alias("target"))


def schedule(quotas: DataFrame, total: int) -> DataFrame:
    """(k, sid, j): the source of each schedule position and the slot's rank within the source.

    ``quotas`` has sid, slots and cum (slots of this and earlier sources); ``total`` is all slots.
    """
    spark = quotas.sparkSession
    cells = 1 << max(4, (4 * quotas.count()).bit_length())
    width = _SPAN // cells
    edge = lambda c: F.expr(f"CAST({c} AS DECIMAL(30, 0)) * {_SPAN} div {max(total, 1)}").cast("long")
    ranges = quotas.where("slots > 0").select("sid", edge("(cum - slots)").alias("low"), edge("cum").alias("high")).where("low < high")
    ranges = ranges.withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))))
    k = F.col("k")
    high = F.lit((_GOLDEN << 31) % _SPAN) * (F.floor(k / (1 << 31)).cast("long") % 2)
    point = (k % (1 << 31) * F.lit(_GOLDEN) + high) % _SPAN
    slots = spark.range(total).select(F.col("id").alias("k")).withColumn("x", point).withColumn("cell", F.floor(F.col("x") / width))
    slots = slots.join(ranges, "cell").where("x >= low AND x < high").select("k", "sid")
    slots = slots.withColumns({"piece": F.floor(k / 65536).cast("long"), "one": F.lit(1).cast("long")})
    return running_total(slots, ["sid"], "piece", ["k"], "one", "j").select("k", "sid", "j")


@dataclass(frozen=True)
class Mix:
    """A mix: ``docs`` (id, source, tie, size, source_size, target, taken, sid, start, blocks), ``slots`` (k, sid, j) and the words of a block."""

    docs: DataFrame
    slots: DataFrame
    block: int
    total: int


def planned(
    docs: DataFrame, block: int = 2048, weights: tuple[int, ...] = (5, 2, 1), repeats: int = 3, seed: int = 11, least_slots: int = 1 << 20,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> Mix:
    """The schedule, and what it takes of every document."""
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        n_words(F.col(text_col)).alias("size"),
        F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string")).cast("binary")).alias("key"),
        F.xxhash64(text_col).alias("tie"),
    )
    rows = staged(rows, "sizes")
    sizes = staged(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    block = max(1, min(block, (sizes.agg(F.sum("source_size")).first()[0] or 0) // least_slots))
    plan = targets(sizes, weights, repeats)
    goal = F.least(F.floor(F.col("target") + 0.5).cast("long"), F.col("source_size") * repeats)
    plan = plan.withColumns({"goal": goal, "blocks": F.ceil(F.col("source_size") / block)})
    share = F.floor(F.col("goal") / F.col("source_size") * F.col("blocks") + 0.5)
    plan = plan.withColumn("slots", F.when(F.col("goal") > 0, F.greatest(share, F.lit(1))).otherwise(0).cast("long"))
    plan = plan.withColumn("cum", F.sum("slots").over(Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)))
    plan = staged(plan.coalesce(1), "plan")  # a row per source
    total = int(plan.agg(F.sum("slots")).first()[0] or 0)
    slots = schedule(plan.select("sid", "slots", "cum"), total).join(plan.select("sid", "blocks"), "sid")
    slots = staged(slots.where(F.col("j") < F.col("blocks") * repeats).select("k", "sid", "j"), "slots")
    got = slots.groupBy("sid").agg(F.count("*").alias("got"))
    plan = plan.join(got, "sid", "left").withColumn("got", F.coalesce("got", F.lit(0)))

    # Each document's place in its source's shuffled stream, and how much of it the source's slots cover.
    plan = plan.select("source", "sid", "source_size", "target", "blocks", "got")
    named = rows.join(plan, rows["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    named = named.withColumn("piece", F.conv(F.substring("key", 1, 3), 16, 10).cast("long"))
    streamed = running_total(named, ["sid"], "piece", ["key", "size", "tie"], "size", "start")
    passes, rest = F.floor(F.col("got") / F.col("blocks")), F.col("got") % F.col("blocks")
    part = F.greatest(F.least(rest * block - F.col("start"), F.col("size")), F.lit(0))
    taken = F.when(F.col("size") > 0, passes * F.col("size") + part).otherwise(0).cast("long")
    held = streamed.withColumn("taken", taken).select("id", "source", "tie", "size", "source_size", "target", "taken", "sid", "start", "blocks")
    return Mix(held, slots, block, total)


def mixed(
    docs: DataFrame, block: int = 2048, weights: tuple[int, ...] = (5, 2, 1), repeats: int = 3, least_slots: int = 1 << 20,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """(id, source, size, source_size, target, taken, first_slot) of every row.

    ``taken`` counts repeats; ``first_slot`` is the schedule's position of the block that the document begins
    in, null if it is not taken.
    """
    mix = planned(docs, block, weights, repeats, least_slots=least_slots, id_col=id_col, text_col=text_col, source_col=source_col)
    rows = mix.docs.withColumn("j", F.when(F.col("taken") > 0, F.floor(F.col("start") / mix.block)))
    rows = rows.join(mix.slots.withColumnRenamed("k", "first_slot"), ["sid", "j"], "left")
    return rows.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "taken", "first_slot")


def mix(
    docs: DataFrame, block: int = 2048, weights: tuple[int, ...] = (5, 2, 1), repeats: int = 3, least_slots: int = 1 << 20, ordered: bool = True,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The mix itself: rows of ``docs`` repeated as often as they are taken (rounded), untaken ones left out.

    Rows come in the order of their slots, pass by pass; without ``ordered``, for a reader that orders
    them anew, one shuffle of the texts is saved. Of rows equal in id, source and text the most taken one counts.
    """
    def chosen() -> DataFrame:
        plan = planned(docs, block, weights, repeats, least_slots=least_slots, id_col=id_col, text_col=text_col, source_col=source_col)
        times = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
        share = plan.docs.where("taken > 0").withColumns({"times": times, "row": F.struct("id", "source", "tie")}).where("times > 0")
        most = F.max(F.struct("times", F.struct("sid", "start", "blocks").alias("at"))).alias("most")
        share = share.groupBy("row").agg(most).select("row", "most.times", "most.at.*")
        copies = share.withColumn("again", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
        if ordered:
            copies = copies.withColumn("j", F.floor(F.col("start") / plan.block) + F.col("again") * F.col("blocks"))
            copies = copies.join(plan.slots, ["sid", "j"], "left").withColumn("k", F.coalesce("k", F.col("j") + plan.total))
        return copies.select("row", "start", *(["k"] if ordered else []))

    copies = alone(chosen, "copies")
    row = F.struct(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.xxhash64(text_col).alias("tie"))
    whole = docs.select(F.struct("*").alias("doc"), row.alias("own"))
    # The copies have a row per document, so they are never broadcast, however few they are.
    met = whole.join(copies.hint("merge"), whole["own"].eqNullSafe(copies["row"]))
    if ordered:
        met = met.repartitionByRange("k", "start").sortWithinPartitions("k", "start")
    return met.select("doc.*")
