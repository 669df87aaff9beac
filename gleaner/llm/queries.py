"""The registered queries of the operators, with production parameters, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import chat, decontam, mixing, oracle, quality, repeats, sharding, simhash, tokens, urls, warc
from gleaner.llm.workspace import new_path

URL_RULES = [
    urls.Rule("block", "com/en/"),
    urls.Rule("allow", "example.com/en/7"),
    urls.Rule("allow", "net/de/"),
    urls.Rule("block", "example.net/de/8"),
    urls.Rule("block", "org/es/"),
]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures, base verdict and final verdict of every document."""
    return quality.judged(_read(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, 24 shards under the law ``rows``."""
    rows = sharding.sharded(_read(spark, sf_dir, "documents"), 24)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number", "position"
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    rows = simhash.near_duplicates(_read(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, and its first slot in the schedule."""
    rows = mixing.mixed(_read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken", "source", "first_slot")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and its best window."""
    return decontam.matches(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maximal conversations, rendered."""
    return chat.rendered(_read(spark, sf_dir, "conversations"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to archives and read back from them."""
    path = new_path(spark, "warc")
    warc.write(_read(spark, sf_dir, "pages"), path, "page_id", "url", "html")
    rows = warc.read(spark, path)
    return rows.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without its repeated 200-byte strings."""
    return repeats.removed(_read(spark, sf_dir, "documents"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL; the trees learn from the URLs that a rule fits."""
    rows = urls.filtered(_read(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return rows.select("page_id", "host", "path", "rule", "verdict", "score")


def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place and checksum of every document's ids, written to token files and read back from them."""
    path = new_path(spark, "tokens")
    manifest = tokens.write(_read(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return tokens.read(spark, path, manifest)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality_rules, op2_sharding, op3_simhash, op4_mixing, op5_decontamination, op6_chat, op7_warc, op8_suffix_dedup, op9_url_filters, op10_tokens)}


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": oracle.QUALITY, "op4_mixing": oracle.MIXING, "op6_chat": oracle.CHAT, "op7_warc": oracle.WARC}
