"""Scans: JSON lines (lenient, strict and tolerant), file trees and stored tables."""

from __future__ import annotations

import posixpath

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from gleaner.plans import schemas


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines without byte-order marks; blank ones are left out."""
    raw = spark.read.text(path).withColumn("value", F.ltrim("value", F.lit("﻿")))
    return raw.where(F.trim("value") != "")


def jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows of JSON lines; a missing path is an empty table, a malformed line an error."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    parsed = _lines(spark, path).select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r"))
    return parsed.select("r.*")


def log(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows of a log; malformed lines are skipped and a missing path is empty."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    good = _lines(spark, path).where(F.is_valid_json("value") if hasattr(F, "is_valid_json") else F.try_parse_json("value").isNotNull())
    return good.select(F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r")).select("r.*")


def download_input(spark: SparkSession, path: str) -> DataFrame:
    """Strict rows for downloads: each with an id and a list of URLs, and no id twice; errors when read."""
    rows = jsonl(spark, path, schemas.DOWNLOAD_INPUT)
    bad = F.col("record_id").isNull() | (F.col("record_id") == "") | F.col("urls").isNull() | F.exists("urls", lambda u: u.isNull())
    times = rows.groupBy(F.col("record_id").alias("_id")).agg(F.count("*").alias("_n"))
    rows = rows.join(times, F.col("record_id").eqNullSafe(F.col("_id"))).drop("_id")
    wrong = F.when(bad, F.raise_error(F.lit("each row needs record_id and a list of urls"))).when(F.col("_n") > 1, F.raise_error(F.lit("an id is repeated in the input")))
    return rows.where(wrong.cast("boolean").isNull()).drop("_n")


def files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, sha, bytes, modified) of the files below a folder."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "path string, sha string, bytes long, modified timestamp")
    tree = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return tree.select("path", F.sha2("content", 256).alias("sha"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def files_sha(spark: SparkSession, path: str) -> str | None:
    """One hash of the contents of a file, or of the parts of a folder in the order of their hashes; null if there is none."""
    shas = F.array_sort(F.collect_list("sha"))  # a row per part
    return files(spark, path, "[!_.]*").agg(F.when(F.size(shas) == 1, shas[0]).when(F.size(shas) > 1, F.sha2(F.array_join(shas, ""), 256)).alias("sha")).first()["sha"]


def contents(spark: SparkSession, folder: str) -> DataFrame:
    """(path, content): the PDFs of another harvest, from its archive table or the files below raw/pdf."""
    if _exists(spark, f"{folder}/archive"):
        rows = spark.read.parquet(f"{folder}/archive")
        return rows.select(F.concat(F.lit("raw/pdf/"), F.substring("sha", 1, 2), F.lit("/"), "sha", F.lit(".pdf")).alias("path"), F.col("content").cast("binary").alias("content"))
    if not _exists(spark, f"{folder}/raw/pdf"):
        return spark.createDataFrame([], "path string, content binary")
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    root = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()
    tree = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{folder}/raw/pdf")
    return tree.select(F.expr(f"substring(path, {len(root) + 2})").alias("path"), "content")


@F.pandas_udf(StringType())
def contained(path: pd.Series) -> pd.Series:
    """A relative path without its dots; null where it leaves its folder."""

    def one(raw: str | None) -> str | None:
        plain = posixpath.normpath((raw or "").replace("\\", "/"))
        return None if not raw or plain in (".", "..") or plain.startswith(("/", "../")) else plain

    return path.map(one).astype(object)


def stored(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A stored table, empty if it is not there yet; columns that an older one lacks are null."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
