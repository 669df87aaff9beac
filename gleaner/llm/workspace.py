"""Staging of intermediate tables in the folder that all executors share.

A staged table cuts lineage: after an executor is lost, later jobs read the table again instead of
repeating what made it. The folder is ``spark.checkpoint.dir`` of the session; where that is unset,
as in tests, a temporary folder of the driver stands in for it.
"""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local: dict[str, str] = {}
_scratch: list[list[str]] = []  # paths of the tables staged within each open ``alone``, the innermost last
_codec = ["zstd"]  # of staged tables; the innermost ``alone`` last


def shared_folder(spark: SparkSession) -> str:
    """URI of this application's folder below ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if "base" not in _local:
            _local["base"] = "file://" + tempfile.mkdtemp(prefix="gleaner-")
        base = _local["base"]
    folder = f"{base.rstrip('/')}/gleaner/{spark.sparkContext.applicationId}"
    if folder not in _local:
        _local[folder] = folder
        atexit.register(_forget, spark, folder)
    return folder


def _forget(spark: SparkSession, folder: str) -> None:
    if spark.sparkContext._jsc is not None:
        remove(spark, folder)


def new_path(spark: SparkSession, name: str) -> str:
    """A path that nothing has been written to yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder through Hadoop's file system layer."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def small_batches(spark: SparkSession, most_rows: int = 1000) -> Iterator[None]:
    """While an action runs, Arrow batches hold at most that many rows: texts are wide, and each batch lies in both the JVM and Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), most_rows) if int(before) > 0 else most_rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return a reader of it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    if _scratch:
        _scratch[-1].append(path)
    with small_batches(spark):
        df.write.option("compression", _codec[-1]).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def alone(make: Callable[[], DataFrame], name: str, codec: str = "zstd") -> DataFrame:
    """Stage what ``make`` returns and delete the tables that it staged on its way, in ``codec``."""
    _scratch.append([])
    _codec.append(codec)
    try:
        made = make()
        passed = _scratch.pop()
    except BaseException:
        _scratch.pop()
        raise
    finally:
        _codec.pop()
    out = staged(made, name)
    for path in passed:
        remove(out.sparkSession, path)
    return out


def give_back() -> None:
    """Return free memory to the system: a worker process lives on beside its executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not of every C library
        pass


def joined_small(big: DataFrame, small: DataFrame, on, how: str, most_rows: int = 200_000) -> DataFrame:
    """Join with a staged ``small`` side: broadcast if it has at most ``most_rows`` rows, else shuffle both.

    The count is an action over a staged table, so the check costs a look at Parquet footers.
    """
    return big.join(F.broadcast(small) if small.count() <= most_rows else small, on, how)
