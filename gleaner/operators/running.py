"""Running totals over ordered groups of any size, without one task per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_total(df: DataFrame, group: list[str], bucket: str, order: list[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over earlier rows of the group, in order of (bucket, order).

    ``bucket`` cuts each group into ordered pieces that fit a task. Only one row per piece meets its
    group's other pieces; so a group that holds most rows is still spread. Keys must not be null.
    """
    keys = [*group, bucket]
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    pieces = df.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    pieces = pieces.withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(pieces, keys)
        .withColumn(out, F.col("_base") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_base")
    )


def hex_bucket(column: str, digits: int = 3):
    """The leading hex digits of a hash as an ordered bucket number."""
    return F.conv(F.substring(column, 1, digits), 16, 10).cast("long")
