"""Exactly-once commits of harvested pages: a micro-batch may come again and changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.operators import records
from gleaner.plans import schemas
from gleaner.sources.scans import stored

PAGE_INPUT = "partition_id STRING, page INT, url STRING, sha STRING, body STRING, harvest_ts TIMESTAMP"


class ChangedPage(ValueError):
    """A committed page came again with other content."""


def commit(pages: DataFrame, folder: str) -> int:
    """Commit raw pages (PAGE_INPUT) to the tables below ``folder``; returns how many are new.

    Page rows are written last: until then a repeated commit redoes the others, whose appends leave
    out what is there. Pages that are no valid answer go to ``invalid`` and are not committed.
    """
    spark = pages.sparkSession
    done = stored(spark, f"{folder}/pages", schemas.PAGES)
    key = ["partition_id", "page"]
    pages = pages.dropDuplicates([*key, "sha"])
    changed = pages.join(done.select(*key, F.col("sha").alias("_sha")), key).where("sha <> _sha")
    if changed.limit(1).count():
        raise ChangedPage("a committed page came again with other content")
    new = pages.join(done.select(*key), key, "left_anti").persist()
    try:
        rows = records.validated(new).persist()
        try:
            return _write(spark, rows, folder)
        finally:
            rows.unpersist()
    finally:
        new.unpersist()


def _write(spark: SparkSession, rows: DataFrame, folder: str) -> int:
    key = ["partition_id", "page"]
    bad = rows.where("page_error IS NOT NULL").select("url", "sha", F.col("harvest_ts").alias("observed_at"), F.col("page_error").alias("category"))
    _append(bad, f"{folder}/invalid", "url STRING, sha STRING, observed_at TIMESTAMP, category STRING", "url", "sha")
    good = rows.where("page_error IS NULL")
    rejected = good.where("reject_reason IS NOT NULL").select(
        *key, "position", "record_id", F.col("reject_reason").alias("reason"), F.to_json("record").alias("payload"), F.col("sha").alias("raw_sha"), F.col("harvest_ts").alias("detected_at")
    )
    _append(rejected, f"{folder}/rejections", schemas.REJECTIONS, *key, "position")
    kept = good.where("record_id IS NOT NULL AND reject_reason IS NULL").withColumn("payload", F.to_json("record"))
    known = stored(spark, f"{folder}/records", schemas.RECORDS)
    first = Window.partitionBy("record_id").orderBy(*key, "position")
    ranked = kept.withColumn("_first", F.first("payload").over(first)).join(known.select("record_id", F.col("payload").alias("_known")), "record_id", "left")
    stands = F.coalesce("_known", "_first")
    conflicts = ranked.where(F.col("payload") != stands).select("record_id", *key, "payload", F.col("harvest_ts").alias("detected_at"))
    _append(conflicts, f"{folder}/conflicts", schemas.CONFLICTS, "record_id", *key)
    _append(kept.select("record_id", *key), f"{folder}/record_partitions", schemas.RECORD_PARTITIONS, "record_id", "partition_id")
    new = records.first_wins(kept.select("record_id", *key, "position", "payload", F.col("harvest_ts").alias("discovered_at")), "record_id", [*key, "position"])
    _append(new.select("record_id", "payload", "discovered_at"), f"{folder}/records", schemas.RECORDS, "record_id")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("reject_reason").isNull(), F.struct("position", "record_id")))), lambda s: s["record_id"]), "\n")
    done = good.groupBy(*key, "total", "sha", "url", "harvest_ts").agg(F.count("record").alias("count"), F.sha2(ids, 256).alias("fingerprint"))
    done = done.select("partition_id", "page", "total", "count", "sha", "fingerprint", "url", "harvest_ts").persist()
    n = done.count()
    done.write.mode("append").parquet(f"{folder}/pages")
    done.unpersist()
    return n


def _append(rows: DataFrame, path: str, schema: str, *key: str) -> None:
    there = stored(rows.sparkSession, path, schema)
    rows.dropDuplicates(list(key)).join(there.select(*key), list(key), "left_anti").select(*there.columns).write.mode("append").parquet(path)


def stream(spark: SparkSession, inbox: str, folder: str, checkpoint: str, most_files: int = 50):
    """Commit what lies in ``inbox`` (JSON lines of pages) and has not been taken yet, then stop."""
    pages = spark.readStream.schema(PAGE_INPUT).option("maxFilesPerTrigger", most_files).json(inbox)
    writer = pages.writeStream.foreachBatch(lambda batch, _: commit(batch, folder) and None)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
