"""A corpus pipeline in five stages: rules, near-duplicates, decontamination, mixing, token files.

Every stage takes what its predecessor kept, as written Parquet, and its decisions take effect: the
first three drop rows, the fourth repeats rows as often as the mix takes them, and the last writes
the rest to token files and returns what it reads back from them. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gleaner.llm import decontam, mixing, quality, simhash, tokens
from gleaner.llm.workspace import new_path, staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor their host's verdict rejects."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of texts alike in 0.8 of their five-word shingles."""
    return simhash.keep_one(docs, similarity=0.8, shingle=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, at most three times."""
    return mixing.mix(docs, ordered=False)  # the next stage orders by id


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place and checksum of each row's ids in the token files."""
    path = new_path(spark, "tokens")
    # The workers share their executors with a JVM that four stages have filled, so they keep fewer pieces.
    manifest = tokens.write(docs, path, public_tokenizers.path("byte_bpe_50k.json"), most_pieces=60_000)
    return tokens.read(spark, path, manifest, docs.schema["doc_id"].dataType)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

#: Fingerprints, window similarity and tokenization are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
