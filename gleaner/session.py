"""Session and table helpers shared by tests, the benchmark and command lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def local_session(cores: str = "*", app: str = "gleaner", **conf: str) -> SparkSession:
    """A local session with the settings the engine expects of a cluster: UTC, adaptive execution, Arrow."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One of the Parquet tables of a data directory."""
    return spark.read.parquet(f"{directory}/{name}.parquet")
