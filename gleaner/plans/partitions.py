"""The partition planner: disjoint partitions of a corpus, each within the source's result window.

A corpus has one row per record with a year and an institution (strings, nullable). Years over the
window are split by institution; what no exposed value covers goes to residual partitions, nulls
included, so the partitions always add up to the corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WINDOW = 1000
PAGE = 100


def facet(corpus: DataFrame, field: str) -> DataFrame:
    """(value, count) of a field's values, null left out, as a search facet counts them."""
    return corpus.where(F.col(field).isNotNull()).groupBy(F.col(field).alias("value")).agg(F.count("*").alias("count"))


def exposed(counts: DataFrame, n: int, by: str = "value") -> DataFrame:
    """The first n facet values: ``value`` descending as strings, or ``count`` descending then value."""
    order = [F.col("value").desc()] if by == "value" else [F.col("count").desc(), F.col("value")]
    return counts.orderBy(*order).limit(n)


def smallest(counts: DataFrame) -> DataFrame:
    """(value, count) of the smallest positive count, the smaller value on ties."""
    return counts.where("count > 0").agg(F.min(F.struct("count", "value")).alias("m")).select("m.value", "m.count")


def archived_facets(values: DataFrame, answers: DataFrame, field: str) -> DataFrame:
    """(value, count) of a field from stored facet values (field, value, count) and, where they lack a value, from cached answers (url, body)."""
    item = "array<struct<value: string, count: bigint>>"
    found = answers.select("url", F.explode(F.try_variant_get(F.try_parse_json("body"), f"$.facets.{field}", item)).alias("i"))
    found = found.where("i.value IS NOT NULL AND i.count IS NOT NULL").select("i.value", "i.count", F.col("url").alias("source"))
    held = values.where(F.col("field") == field).select("value", "count", F.lit("").alias("source"))  # before any URL
    return held.unionByName(found).groupBy("value").agg(F.min_by("count", "source").alias("count"))


def cover(corpus: DataFrame, years: DataFrame) -> DataFrame:
    """(label, kind, priority, total): exposed years, other years and no year, in this order."""
    order = Window.orderBy(F.col("value").desc())  # a row per exposed year
    listed = years.select(F.col("value").alias("label"), F.lit("year").alias("kind"), (F.row_number().over(order) - 1).alias("priority"), F.col("count").alias("total"))
    n = years.agg(F.count("*").cast("int").alias("n"))
    rest = corpus.join(F.broadcast(years.select(F.col("value").alias("year"))), "year", "left_anti")
    rest = rest.agg(F.count("year").alias("other"), (F.count("*") - F.count("year")).alias("none")).crossJoin(n)  # one row each
    rest = rest.select(F.inline(F.array(
        F.struct(F.lit("other years").alias("label"), F.lit("other").alias("kind"), F.col("n").alias("priority"), F.col("other").alias("total")),
        F.struct(F.lit("no year").alias("label"), F.lit("none").alias("kind"), (F.col("n") + 1).alias("priority"), F.col("none").alias("total")),
    )))
    return listed.unionByName(rest)


def split(corpus: DataFrame, parents: DataFrame, institutions: DataFrame) -> DataFrame:
    """Children of the year partitions over the window: one per exposed institution, and a residual.

    ``parents`` and ``institutions`` are facet-sized: their product is the list of requests to make.
    """
    order = Window.orderBy(F.col("count").desc(), F.col("value"))
    ranked = institutions.select(F.col("value").alias("institution"), F.row_number().over(order).alias("child"))
    large = parents.where((F.col("kind") == "year") & (F.col("total") > WINDOW)).select(F.col("label").alias("parent"), F.col("priority").alias("parent_priority"))
    named = corpus.join(F.broadcast(ranked), "institution", "left").select("year", "institution", "child")
    got = named.groupBy(F.col("year").alias("parent"), F.coalesce("child", F.lit(0)).alias("child")).agg(F.count("*").alias("total"))
    cells = ranked.unionByName(ranked.agg(F.lit("other institutions").alias("institution"), F.lit(0).alias("child")))
    wanted = large.join(F.broadcast(cells))  # oversized years x exposed institutions
    last = F.count("*").over(Window.partitionBy("parent"))
    return (
        wanted.join(got, ["parent", "child"], "left")
        .withColumn("child", F.when(F.col("child") == 0, last).otherwise(F.col("child")).cast("int"))
        .select(
            F.concat("parent", F.lit(" / "), "institution").alias("label"), F.when(F.col("institution") == "other institutions", "residual").otherwise("institution").alias("kind"),
            "parent", "parent_priority", "child", F.coalesce("total", F.lit(0)).alias("total"),
        )
    )


def plan(corpus: DataFrame, years: DataFrame, institutions: DataFrame) -> DataFrame:
    """(label, kind, parent, parent_priority, child, total, status, pages, inaccessible) of all partitions."""
    top = cover(corpus, years).select("label", "kind", F.lit(None).cast("string").alias("parent"), F.col("priority").alias("parent_priority"), F.lit(0).alias("child"), "total")
    children = split(corpus, top.withColumnRenamed("parent_priority", "priority"), institutions)
    return with_status(top.unionByName(children))


def with_status(parts: DataFrame) -> DataFrame:
    """What harvesting ends in: split, partial (rows beyond the window are out of reach) or complete."""
    over = F.col("total") > WINDOW
    status = F.when(over & (F.col("kind") == "year"), "split").when(over, "partial").otherwise("complete")
    return parts.withColumn("status", status).withColumns({
        "pages": F.when(F.col("status") == "split", 0).otherwise(F.ceil(F.least("total", F.lit(WINDOW)) / PAGE)).cast("int"),
        "inaccessible": F.when(F.col("status") == "partial", F.col("total") - WINDOW).otherwise(0).cast("long"),
    })


def split_coverage(parts: DataFrame) -> DataFrame:
    """(label, parent_total, children, children_with_total, children_total, matches) of each split partition.

    ``matches`` is null while a child's total is unknown.
    """
    kids = parts.where("parent IS NOT NULL").groupBy(F.col("parent").alias("label")).agg(
        F.count("*").alias("children"), F.count("total").alias("children_with_total"), F.coalesce(F.sum("total"), F.lit(0)).alias("children_total")
    )
    split_ones = parts.where("status = 'split'").select("label", F.col("total").alias("parent_total"))
    out = split_ones.join(kids, "label", "left").fillna(0, ["children", "children_with_total", "children_total"])
    known = (F.col("children") > 0) & (F.col("children") == F.col("children_with_total"))
    return out.withColumn("matches", F.when(known, F.col("children_total") == F.col("parent_total")))


def algebra(corpus: DataFrame, years: DataFrame, institutions: DataFrame) -> DataFrame:
    """One row that checks the partition algebra on the smallest year and the largest institution."""
    year = smallest(years).select(F.col("value").alias("year"), F.col("count").alias("year_expected"))
    inst = exposed(institutions, 1, "count").select(F.col("value").alias("institution"))
    probe = F.broadcast(year.crossJoin(inst))  # one row
    known = F.broadcast(years.select(F.col("value").alias("year"), F.lit(True).alias("listed")))
    rows = corpus.withColumnsRenamed({"year": "y", "institution": "i"}).join(known.withColumnRenamed("year", "y"), "y", "left").join(probe)
    here = F.col("y") == F.col("year")
    got = rows.groupBy("year", "year_expected", "institution").agg(
        F.count("*").alias("root"), F.count_if(here).alias("year_observed"), F.count_if(here & (F.col("i") == F.col("institution"))).alias("child"),
        F.count_if(here & ~F.col("i").eqNullSafe(F.col("institution"))).alias("residual"), F.count_if(F.col("y").isNull()).alias("no_year"),
        F.count_if(F.col("y").isNotNull() & F.col("listed").isNull()).alias("other_years"), F.count_if(F.col("listed")).alias("in_years"),
    )
    return got.select(
        "root", "year", "year_expected", "year_observed", "institution", "child", "residual", "no_year", "other_years",
        (F.col("year_observed") - F.col("child") == F.col("residual")).alias("residual_matches"),
        (F.col("root") - F.col("in_years") - F.col("no_year") == F.col("other_years")).alias("other_matches"),
    )


def next_partition(parts: DataFrame) -> DataFrame:
    """The partition to take next: planned or harvesting, least priority, then least id."""
    return parts.where(F.col("status").isin("planned", "harvesting")).orderBy("priority", "id").limit(1)


def transition(state: DataFrame) -> DataFrame:
    """The state machine's next state from (kind, has_children_facet, status, total, page, rows, repeated, retryable, total_changed).

    One explicit rule for the window: a partition whose total is over it ends ``partial``.
    """
    over = F.col("total") > WINDOW
    pages = F.ceil(F.least("total", F.lit(WINDOW)) / PAGE)
    nxt = (
        F.when(F.col("retryable"), F.col("status"))
        .when(F.col("total_changed"), "inaccessible")
        .when((F.col("status") == "planned") & over & (F.col("kind") == "year") & F.col("has_children_facet"), "split")
        .when(over & (F.col("repeated") | (F.col("page") > pages)), "partial")
        .when(F.col("repeated") | ((F.col("page") > pages) & (F.col("rows") > 0)), "inaccessible")
        .when((F.col("page") >= pages) & ~over, "complete")
        .otherwise("harvesting")
    )
    return state.withColumn("next_status", nxt).withColumn("next_page", F.when(nxt == "harvesting", F.col("page") + F.when(F.col("retryable"), 0).otherwise(1)))
